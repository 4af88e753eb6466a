"""Rule-weighted scoring of customers by their returns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

from tallyhouse.config import (
    FLAG_ROW,
    FLAG_THRESHOLD,
    FRAUD_RULES,
    FraudRule,
    HOT_SCORE,
    PRIORITY_BANDS,
    WARM_SCORE,
)
from tallyhouse.functions.clean import date_part_of, region
from tallyhouse.functions.numbers import count_if, ratio
from tallyhouse.sources.sinks import bucket_state, read_buckets, replace_buckets, with_bucket

DUPLICATE_REASON = "Duplicate Order"
SAME_DAY = "Same Day"


def active_rules(rules: Iterable[FraudRule] = FRAUD_RULES) -> list[FraudRule]:
    """Rules in use; the weights of the full set must add up to 100. The row of the threshold is no rule."""
    rules = [r for r in rules if r.rule_name != FLAG_ROW]
    total = sum(r.weight for r in rules)
    if abs(total - 100) > 1e-9:
        raise ValueError(f"weights add up to {total}, not 100")
    return [r for r in rules if r.is_active]


def flag_threshold(rules: Iterable[FraudRule]) -> float:
    """The score from which customers are flagged, as the rule table has it; the built-in one if it has no such row."""
    return next((r.threshold for r in rules if r.rule_name == FLAG_ROW), FLAG_THRESHOLD)


def returns_in_scope(returns: DataFrame, scored_at: DataFrame | None = None, stamp: str = "scored_at") -> DataFrame:
    """All returns of customers with a return later than the last run; all returns at first.

    ``scored_at`` is an earlier result with its time of scoring.
    """
    if scored_at is None:
        return returns
    mark = scored_at.agg(F.max(stamp).cast("date")).scalar()
    changed = returns.where(mark.isNull() | (F.col("return_date") > mark)).select("customer_id").distinct()
    return returns.join(changed, "customer_id", "left_semi")


def return_flags(returns: DataFrame, orders: DataFrame) -> DataFrame:
    """Per return: was it filed before delivery, from a same-day order, without any order.

    One left join on the order answers all three, including the missing order.
    """
    known = orders.select(
        "order_id", "ship_mode", date_part_of(F.col("order_delivered_customer_timestamp")).alias("delivered"), F.lit(1).alias("known"))
    gap = F.col("refund_amount") - F.col("original_sales")
    return returns.join(known, "order_id", "left").select(
        "customer_id", "order_id", "refund_amount", "return_reason",
        gap.alias("line_inflation"),
        F.coalesce(F.to_date("return_date") < F.col("delivered"), F.lit(False)).alias("before_delivery"),
        F.coalesce(F.col("ship_mode") == SAME_DAY, F.lit(False)).alias("same_day"),
        F.col("known").isNull().alias("no_order"),
    )


def signals(returns: DataFrame, orders: DataFrame) -> DataFrame:
    """What the returns alone say about each customer: sums, counts, a maximum and the reasons. Signals of two sets of returns can be merged."""
    return return_flags(returns, orders).groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("total_returns"),
        F.sum("refund_amount").cast("decimal(38,2)").alias("total_refund_value"),
        F.sort_array(F.collect_set("return_reason")).alias("return_reasons_list"),
        F.sum("line_inflation").cast("decimal(38,2)").alias("total_refund_inflation"),
        F.max("line_inflation").cast("decimal(20,2)").alias("max_single_inflation"),
        count_if(F.col("line_inflation") > 0).alias("inflated_refund_count"),
        count_if(F.col("return_reason") == DUPLICATE_REASON).alias("duplicate_order_count"),
        count_if(F.col("before_delivery")).alias("return_before_delivery_count"),
        count_if(F.col("same_day")).alias("same_day_ship_return_count"),
        count_if(F.col("no_order")).alias("no_matching_order_count"),
    )


def merged_signals(several: DataFrame) -> DataFrame:
    """Signals of all returns from signals of parts of them; ``_bucket`` stays, if there is one."""
    sums = [c for c in several.columns if c.startswith("total_") or c.endswith("_count")]
    same = [F.first(c).alias(c) for c in several.columns if c == "_bucket"]
    out = several.groupBy("customer_id").agg(
        *[F.sum(c).cast(several.schema[c].dataType).alias(c) for c in sums], F.max("max_single_inflation").alias("max_single_inflation"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("return_reasons_list")))).alias("return_reasons_list"), *same)
    return out.select(*several.columns)


def add_to_state(returns: DataFrame, orders: DataFrame, path: str, batch: str, buckets: int = 64) -> None:
    """Add the signals of a batch of returns to the stored ones.

    Only the batch's own returns are read, and of the state only the buckets of their customers, which are written again
    (``sinks.replace_buckets``). A batch that has been added before is left out, so a repeated run changes nothing.
    """
    spark = returns.sparkSession
    if batch in bucket_state(spark, path)[2]:
        return
    fresh = with_bucket(signals(returns, orders), "customer_id", buckets)
    touched = [r[0] for r in fresh.select("_bucket").distinct().collect()]  # at most ``buckets``
    old = read_buckets(spark, path, touched)
    replace_buckets(fresh if old is None else merged_signals(fresh.unionByName(old.select(*fresh.columns))), path, touched, batch)


def profile_from_state(path: str, orders: DataFrame, customers: DataFrame) -> DataFrame:
    """The profile of ``customer_profile`` from stored signals, without reading any return."""
    state = read_buckets(orders.sparkSession, path)
    if state is None:
        raise FileNotFoundError(f"no batch has been added to {path}")
    return _profile(state.drop("_bucket"), orders, customers)


def customer_profile(returns: DataFrame, orders: DataFrame, customers: DataFrame) -> DataFrame:
    """All signals per customer from one grouping of the flagged returns.

    Returns without a customer form one profile that has totals but no other signals, because
    those are looked up by customer.
    """
    return _profile(signals(returns, orders), orders, customers)


def _profile(grouped: DataFrame, orders: DataFrame, customers: DataFrame) -> DataFrame:
    money = lambda c: F.coalesce(c, F.lit(0)).cast("decimal(20,2)")
    placed = orders.groupBy("customer_id").agg(F.count(F.lit(1)).alias("total_orders"))
    known = F.col("customer_id").isNotNull()
    looked_up = lambda name: F.when(known, F.col(name))
    counts = ["inflated_refund_count", "duplicate_order_count", "return_before_delivery_count", "same_day_ship_return_count", "no_matching_order_count"]
    joined = (
        grouped.join(placed, "customer_id", "left")
        .join(customers.select("customer_id", "customer_name", "segment", "region"), "customer_id", "left")
    )
    return joined.select(
        "customer_id", "customer_name", "segment", "region", "total_returns",
        F.coalesce("total_orders", F.lit(0)).alias("total_orders"),
        F.when(F.col("total_orders") > 0, F.col("total_returns") / F.col("total_orders")).otherwise(F.lit(0.0)).alias("order_return_rate"),
        money(F.col("total_refund_value")).alias("total_refund_value"),
        money(looked_up("total_refund_inflation")).alias("total_refund_inflation"),
        money(looked_up("max_single_inflation")).alias("max_single_inflation"),
        *[F.coalesce(looked_up(c), F.lit(0)).alias(c) for c in counts],
        F.size("return_reasons_list").cast("bigint").alias("distinct_reasons"),
        "return_reasons_list",
    )


def score(profile: DataFrame, rules: Iterable[FraudRule] = FRAUD_RULES) -> DataFrame:
    """Weight of every rule that fires, and their sum."""
    rules = active_rules(rules)
    out = profile.withColumns(
        {f"score_{r.rule_name}": F.when(F.col(r.signal) >= r.threshold, F.lit(float(r.weight))).otherwise(F.lit(0.0)) for r in rules}
    )
    total = sum((F.col(f"score_{r.rule_name}") for r in rules), F.lit(0.0))
    fired = F.concat_ws("|", *[F.when(F.col(f"score_{r.rule_name}") > 0, r.rule_name) for r in rules])
    return out.withColumns({"anomaly_score": total, "rules_violated": fired})


def flagged(scored: DataFrame, threshold: float = FLAG_THRESHOLD) -> DataFrame:
    return scored.where(F.col("anomaly_score") >= threshold)


def priority(score_col: Column) -> Column:
    out = None
    for least, label in PRIORITY_BANDS:
        out = F.when(score_col >= least, label) if out is None else out.when(score_col >= least, label)
    return out.otherwise("BORDERLINE")


def latest_run(df: DataFrame, stamp: str = "scored_at") -> DataFrame:
    return df.where(F.col(stamp) == df.agg(F.max(stamp)).scalar())


def queue_kpis(queue: DataFrame) -> DataFrame:
    """Key figures of the investigation queue."""
    s = F.col("anomaly_score")
    return queue.agg(
        F.count(F.lit(1)).alias("flagged"),
        ratio(F.sum(s), F.count(s), 1).alias("avg_score"),
        F.max(s).alias("top_score"),
        F.round(F.sum("total_refund_inflation"), 2).alias("total_inflation"),
        count_if(s >= 80).alias("extreme"),
        count_if(s.between(65, 79)).alias("high_risk"),
    )


def queue_by_region(queue: DataFrame) -> DataFrame:
    return queue.groupBy(region(F.col("region")).alias("region")).agg(F.count(F.lit(1)).alias("flagged"))


def investigation_queue(queue: DataFrame, limit: int = 50) -> DataFrame:
    """The most suspicious customers; a top-k report."""
    return (
        queue.select(
            "customer_id", "customer_name", "segment", region(F.col("region")).alias("region"), "total_returns", "total_orders",
            F.coalesce(ratio(F.col("total_returns"), F.col("total_orders"), 1, 100), F.lit(0.0)).alias("return_rate_pct"),
            F.round("total_refund_inflation", 2).alias("refund_inflation"), "no_matching_order_count", "anomaly_score",
            priority(F.col("anomaly_score")).alias("priority"), "rules_violated",
        )
        .orderBy(F.col("anomaly_score").desc(), F.col("refund_inflation").desc(), F.col("customer_id").asc_nulls_first())
        .limit(limit)
    )


# one sentence per rule, with the value that made it fire
BRIEF = {
    "high_return_volume": ("%d returns in total", "total_returns"),
    "high_refund_value": ("refunds of $%.2f", "total_refund_value"),
    "high_order_return_rate": ("%.1f%% of orders returned", "order_return_rate"),
    "refund_inflation": ("$%.2f refunded beyond the value of the goods", "total_refund_inflation"),
    "return_before_delivery": ("%d returns filed before delivery", "return_before_delivery_count"),
    "duplicate_order_reason": ("%d claims of a duplicate order", "duplicate_order_count"),
    "same_day_ship_return": ("%d returns of same-day orders", "same_day_ship_return_count"),
    "no_matching_order": ("%d returns without any order", "no_matching_order_count"),
}


def investigation_brief(queue: DataFrame, rules: Iterable[FraudRule] = FRAUD_RULES) -> DataFrame:
    """A brief per flagged customer that cites the figures behind every fired rule."""
    facts = []
    for r in active_rules(rules):
        text, signal = BRIEF[r.rule_name]
        value = F.col(signal) * 100 if signal == "order_return_rate" else F.col(signal)
        value = value.cast("double") if "%." in text else value
        facts.append(F.when(F.col(f"score_{r.rule_name}") > 0, F.format_string(text, value)))
    who = F.coalesce(F.col("customer_name"), F.lit("An unidentified customer"))
    brief = F.concat(
        who, F.format_string(" scores %d of 100: ", F.col("anomaly_score").cast("int")), F.concat_ws("; ", *facts),
        F.lit(". Genuine defects, late parcels or a recording error may explain part of this. Check first: "),
        F.when(F.col("no_matching_order_count") > 0, "proof of purchase for the returns without an order")
        .when(F.col("return_before_delivery_count") > 0, "delivery records against the filing dates")
        .otherwise("the refunds that exceed the value of the goods"),
        F.lit("."),
    )
    return queue.withColumn("investigation_brief", brief)


def lead_scores(sales: DataFrame, returns: DataFrame, customers: DataFrame) -> DataFrame:
    """Lead score per buying customer from value, frequency, recency and a return penalty.

    Value and frequency count up to 40 and 30 points in proportion to the best customer,
    recency up to 30 points for a sale on the last day, fading to 0 over a year; up to 20
    points are taken off in proportion to the share of orders returned.
    """
    bought = sales.groupBy("customer_id").agg(
        F.sum("sales").alias("total_spent"), F.count_distinct("order_id").alias("total_orders"), F.max("order_date_key").alias("last_key"))
    sent_back = returns.groupBy("customer_id").agg(F.count_distinct("order_id").alias("returned_orders"))
    top = bought.agg(F.max("total_spent").alias("top_spent"), F.max("total_orders").alias("top_orders"), F.max("last_key").alias("top_key"))
    spent, orders, key = (top.select(c).scalar() for c in ("top_spent", "top_orders", "top_key"))
    day = lambda k: F.try_to_timestamp(k.cast("string"), F.lit("yyyyMMdd")).cast("date")
    idle = F.datediff(day(key), day(F.col("last_key")))
    sent = F.least(F.coalesce("returned_orders", F.lit(0)), "total_orders")
    scored = bought.join(sent_back, "customer_id", "left").select(
        "customer_id", "total_spent", "total_orders",
        ratio(sent, F.col("total_orders"), 1, 100).alias("return_rate_pct"),
        ratio(F.col("total_spent"), spent, 2, 40).alias("purchase_value_score"),
        ratio(F.col("total_orders"), orders, 2, 30).alias("frequency_score"),
        ratio(F.greatest(F.lit(365) - idle, F.lit(0)), F.lit(365), 2, 30).alias("recency_score"),
        ratio(sent, F.col("total_orders"), 2, 20).alias("return_penalty"),
    )
    points = [F.col(c).cast("decimal(8,2)") for c in ("purchase_value_score", "frequency_score", "recency_score", "return_penalty")]
    total = F.greatest(points[0] + points[1] + points[2] - points[3], F.lit(0).cast("decimal(8,2)"))
    s = F.col("lead_score")
    return (
        scored.withColumn("lead_score", F.round(total, 1).cast("decimal(8,1)"))
        .withColumn("lead_label", F.when(s >= HOT_SCORE, "HOT").when(s >= WARM_SCORE, "WARM").otherwise("COLD"))
        .join(customers.select("customer_id", "customer_name", "segment", "region"), "customer_id", "left")
        .withColumn("explanation", F.format_string(
            "value %.2f + frequency %.2f + recency %.2f - returns %.2f",
            "purchase_value_score", "frequency_score", "recency_score", "return_penalty"))
    )


def lead_kpis(leads: DataFrame) -> DataFrame:
    label = F.col("lead_label")
    return leads.agg(
        F.count(F.lit(1)).alias("total"), count_if(label == "HOT").alias("hot"), count_if(label == "WARM").alias("warm"),
        count_if(label == "COLD").alias("cold"), ratio(F.sum("lead_score"), F.count("lead_score"), 1).alias("avg"),
    )
