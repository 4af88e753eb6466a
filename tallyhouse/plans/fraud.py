"""Queries for customer scoring."""

from pyspark.sql import functions as F

from tallyhouse.config import FLAG_ROW, FRAUD_CONFIG, FRAUD_RULES
from tallyhouse.operators import fraud, setup
from tallyhouse.plans import common
from tallyhouse.plans.check_views import div, quote
from tallyhouse.plans.registry import query
from tallyhouse.session import work_dir
from tallyhouse.sources import sinks


@query(
    "frd_1_rule_hits",
    "SELECT * FROM (" + " UNION ALL ".join(
        [f"SELECT '{r.rule_name}' AS rule_name, {float(r.threshold)} AS threshold, {float(r.weight)} AS weight, count(CASE WHEN score_{r.rule_name} > 0 THEN 1 END) AS customers, {quote(r.description)} AS description, {quote(r.human_reasoning)} AS human_reasoning FROM f_points"
         for r in FRAUD_RULES] + [f"SELECT 'flag_threshold', 40.0, 0.0, count(*), {quote(FRAUD_CONFIG[-1].description)}, {quote(FRAUD_CONFIG[-1].human_reasoning)} FROM f_flagged"]) + ") t",
)
def rule_hits(t):
    """Configured rules, read from their table, with the customers each one fires for; the threshold with those it flags."""
    rules = setup.load(setup.config_table(t.spark, "fraud_rule_config"), fraud.FraudRule)[""]
    scored = fraud.score(_profile(t), rules)
    fires = lambda r: F.count(F.when(F.col(f"score_{r.rule_name}") > 0 if r.rule_name != FLAG_ROW else F.col("anomaly_score") >= fraud.flag_threshold(rules), 1))
    hits = scored.agg(*[fires(r).alias(r.rule_name) for r in rules])
    rows = [F.struct(*[F.lit(v).alias(c) for c, v in (("rule_name", r.rule_name), ("threshold", r.threshold), ("weight", r.weight))], F.col(r.rule_name).alias("customers"), F.lit(r.description).alias("description"), F.lit(r.human_reasoning).alias("human_reasoning"))
            for r in rules]
    return hits.select(F.inline(F.array(*rows)))


# the earlier run is taken to have happened on this day
LAST_RUN = "2001-06-01"


@query(
    "frd_2_returns_in_scope",
    f"""SELECT order_id, customer_id, return_date, refund_amount FROM g_returns
        WHERE customer_id IN (SELECT customer_id FROM g_returns WHERE return_date > (SELECT max(return_date) FROM g_returns WHERE return_date <= DATE '{LAST_RUN}'))""",
)
def returns_in_scope(t):
    rows = common.returns(t)
    earlier = t.returns.where(F.col("return_date") <= F.lit(LAST_RUN).cast("date")).select(F.col("return_date").alias("scored_at"))
    return fraud.returns_in_scope(rows, earlier).select("order_id", "customer_id", "return_date", "refund_amount")


@query(
    "frd_2_scores_from_state",
    "SELECT s.customer_id, p.total_returns, p.total_refund_value, p.distinct_reasons, p.return_reasons, s.anomaly_score FROM f_scored s JOIN f_profile p ON s.customer_id IS NOT DISTINCT FROM p.customer_id",
)
def scores_from_state(t):
    """Returns in three batches by day, the second one given twice; scores come from the stored signals."""
    path = work_dir(t.spark, "signals")
    common.returns(t).write.parquet(f"{path}/returns")
    rows = t.spark.read.parquet(f"{path}/returns")
    early, late = (F.lit(d).cast("date") for d in ("1999-01-01", LAST_RUN))
    day = F.coalesce("return_date", early)
    for name, part in (("1", day <= early), ("2", (day > early) & (day <= late)), ("2", day > early), ("3", day > late)):
        fraud.add_to_state(rows.where(part), t.orders, f"{path}/state", name)
    scored = fraud.score(fraud.profile_from_state(f"{path}/state", t.orders, t.customers))
    return scored.select("customer_id", "total_returns", "total_refund_value", "distinct_reasons", F.array_join("return_reasons_list", "|").alias("return_reasons"), "anomaly_score")


@query("frd_3_base_signals", "SELECT customer_id, total_returns, total_refund_value, distinct_reasons, return_reasons FROM f_profile")
def base_signals(t):
    return _profile(t).select("customer_id", "total_returns", "total_refund_value", "distinct_reasons", F.array_join("return_reasons_list", "|").alias("return_reasons"))


def _profile(t):
    return fraud.customer_profile(common.returns(t), t.orders, t.customers)


@query("frd_4_refund_inflation", "SELECT customer_id, total_refund_inflation, max_single_inflation, inflated_refund_count FROM f_profile")
def refund_inflation(t):
    return _profile(t).select("customer_id", "total_refund_inflation", "max_single_inflation", "inflated_refund_count")


@query("frd_5_duplicate_orders", "SELECT customer_id, duplicate_order_count FROM f_profile")
def duplicate_orders(t):
    return _profile(t).select("customer_id", "duplicate_order_count")


@query("frd_6_timing", "SELECT customer_id, return_before_delivery_count, same_day_ship_return_count FROM f_profile")
def timing(t):
    return _profile(t).select("customer_id", "return_before_delivery_count", "same_day_ship_return_count")


@query("frd_7_phantom_returns", "SELECT r.order_id, r.refund_amount, r.return_reason FROM s_returns r WHERE NOT EXISTS (SELECT 1 FROM s_orders o WHERE o.order_id = r.order_id)")
def phantom_returns(t):
    rows = t.returns.withColumns({"customer_id": F.lit(None).cast("bigint"), "original_sales": F.lit(None).cast("decimal(10,2)")})
    return fraud.return_flags(rows, t.orders).where("no_order").select("order_id", "refund_amount", "return_reason")


@query("frd_8_order_return_rate", "SELECT customer_id, total_returns, total_orders, order_return_rate FROM f_profile")
def order_return_rate(t):
    return _profile(t).select("customer_id", "total_returns", "total_orders", "order_return_rate")


@query("frd_9_profile", "SELECT * FROM f_profile")
def profile(t):
    return _profile(t).withColumn("return_reasons", F.array_join("return_reasons_list", "|")).drop("return_reasons_list")


@query("frd_10_scores", "SELECT customer_id, anomaly_score, " + ", ".join(f"score_{r.rule_name}" for r in FRAUD_RULES) + " FROM f_scored")
def scores(t):
    return common.scored(t).select("customer_id", "anomaly_score", *[f"score_{r.rule_name}" for r in FRAUD_RULES])


@query("frd_11_flagged", "SELECT customer_id, customer_name, segment, region, anomaly_score, rules_violated FROM f_flagged")
def flagged(t):
    return common.flagged(t).select("customer_id", "customer_name", "segment", "region", "anomaly_score", "rules_violated")


PRIORITY = "CASE WHEN anomaly_score >= 80 THEN 'EXTREME' WHEN anomaly_score >= 65 THEN 'HIGH' WHEN anomaly_score >= 50 THEN 'MODERATE' ELSE 'BORDERLINE' END"


@query("frd_12_priority_bands", f"SELECT {PRIORITY} AS priority, count(*) AS customers FROM f_flagged GROUP BY 1")
def priority_bands(t):
    return common.flagged(t).groupBy(fraud.priority(F.col("anomaly_score")).alias("priority")).agg(F.count(F.lit(1)).alias("customers"))


def _stamped(t):
    """The queue as stored: appended with the time of scoring, then the latest run read back."""
    path = work_dir(t.spark, "flagged")
    sinks.append(common.flagged(t).drop("return_reasons_list").withColumn("scored_at", F.current_timestamp()), path)
    return fraud.latest_run(sinks.read_merged(t.spark, path))


@query(
    "frd_13_queue_kpis",
    f"""SELECT count(*) AS flagged, {div('sum(anomaly_score)', 'count(*)', 1)} AS avg_score, max(anomaly_score) AS top_score, sum(total_refund_inflation) AS total_inflation,
               count(CASE WHEN anomaly_score >= 80 THEN 1 END) AS extreme, count(CASE WHEN anomaly_score BETWEEN 65 AND 79 THEN 1 END) AS high_risk FROM f_flagged""",
)
def queue_kpis(t):
    return fraud.queue_kpis(_stamped(t))


@query("frd_13_queue_by_region", "SELECT region, count(*) AS flagged FROM f_flagged GROUP BY 1")
def queue_by_region(t):
    return fraud.queue_by_region(_stamped(t))


@query(
    "frd_13_investigation_queue",
    f"""SELECT customer_id, customer_name, segment, region, total_returns, total_orders, {div('total_returns', 'total_orders', 1, 100)} AS return_rate_pct,
               total_refund_inflation AS refund_inflation, no_matching_order_count, anomaly_score, {PRIORITY} AS priority, rules_violated
        FROM f_flagged ORDER BY anomaly_score DESC, total_refund_inflation DESC, customer_id LIMIT 50""",
)
def investigation_queue(t):
    return fraud.investigation_queue(_stamped(t))


@query(
    "frd_14_investigation_briefs",
    """SELECT customer_id, rules_violated, coalesce(customer_name, 'An unidentified customer') || ' scores ' || CAST(CAST(anomaly_score AS INTEGER) AS VARCHAR) || ' of 100: ' AS opening FROM f_flagged""",
)
def investigation_briefs(t):
    briefs = fraud.investigation_brief(common.flagged(t))
    return briefs.select("customer_id", "rules_violated", F.concat(F.substring_index("investigation_brief", "of 100: ", 1), F.lit("of 100: ")).alias("opening"))


LEADS = ["customer_id", "customer_name", "segment", "region", "total_spent", "total_orders", "return_rate_pct", "purchase_value_score", "frequency_score", "recency_score",
         "return_penalty", "lead_score", "lead_label"]


def leads(t):
    return fraud.lead_scores(common.sales(t), common.returns(t), t.customers)


@query("frd_15_lead_scores", "SELECT l.*, c.customer_name, c.segment, c.region FROM f_leads l LEFT JOIN s_customers c ON l.customer_id = c.customer_id")
def lead_scores(t):
    return leads(t).select(*LEADS)
