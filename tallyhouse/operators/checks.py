"""Reconciliation and integrity checks between layers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tallyhouse.config import NO_RATIO, RATIO_BANDS
from tallyhouse.functions.numbers import count_if, mean, ratio


def union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def labelled(label: str, value: str, parts: dict[str, DataFrame]) -> DataFrame:
    """One-row frames stacked under a label column."""
    return union([d.select(F.lit(n).alias(label), *[F.col(c) for c in d.columns]) for n, d in parts.items()])


def row_counts(frames: dict[str, DataFrame], expected: dict[str, int] | None = None, name: str = "entity") -> DataFrame:
    """Rows per table, next to the expected number where one is known."""
    counted = union([d.agg(F.count(F.lit(1)).alias("row_count")).withColumn(name, F.lit(n)) for n, d in frames.items()])
    if expected is None:
        return counted
    known = F.create_map(*[x for n, v in expected.items() for x in (F.lit(n), F.lit(v).cast("bigint"))])
    want = F.try_element_at(known, F.col(name))
    return counted.withColumns({"expected": want, "status": F.when(F.col("row_count") == want, "OK").otherwise("DIFFERENT")})


def all_null_keys(frames: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    """Rows in which every variant of the key is missing."""
    return union([
        d.agg(count_if(F.coalesce(*[F.col(k).cast("string") for k in keys]).isNull()).alias("all_id_null"), F.count(F.lit(1)).alias("total"))
        .withColumns({"entity": F.lit(n), "check_col": F.lit(f"{keys[0]} variants" if len(keys) > 1 else keys[0])})
        for n, (d, keys) in frames.items()
    ])


def layer_counts(layers: dict[str, dict[str, DataFrame]]) -> DataFrame:
    """Rows per entity in every layer, one row per entity: ``layers[layer][entity]``."""
    parts = [d.agg(F.count(F.lit(1)).alias("n")).withColumns({"entity": F.lit(e), "layer": F.lit(layer)})
             for layer, frames in layers.items() for e, d in frames.items()]
    return union(parts).groupBy("entity").agg(
        *[F.coalesce(F.sum(F.when(F.col("layer") == layer, F.col("n"))), F.lit(0)).alias(f"{layer}_rows") for layer in layers])


def dedupe_flow(silver: DataFrame, golden: DataFrame, orders: DataFrame, key: str = "customer_id") -> DataFrame:
    one = lambda d, c, name: d.agg(c.alias("value")).withColumn("metric", F.lit(name))
    return union([
        one(silver, F.count(F.lit(1)), "silver rows"),
        one(silver, F.count_distinct(key), "silver distinct keys"),
        one(golden, F.count(F.lit(1)), "golden records"),
        one(orders, F.count_distinct(key), "keys with orders"),
        one(orders.join(golden.select(key), key, "left_semi"), F.count_distinct(key), "order keys found in golden"),
    ])


def active_by_region(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """Customers and customers with orders per region."""
    active = orders.select("customer_id").distinct().withColumn("active", F.lit(1))
    return customers.join(active, "customer_id", "left").groupBy("region").agg(
        F.count(F.lit(1)).alias("customers"), F.count("active").alias("customers_with_orders"))


def orders_without_lines(orders: DataFrame, lines: DataFrame) -> DataFrame:
    return orders.join(lines.select("order_id"), "order_id", "left_anti").groupBy("order_status").agg(
        F.count(F.lit(1)).alias("orders_without_transactions"))


def orphans(relations: dict[str, tuple[DataFrame, DataFrame, str]]) -> DataFrame:
    """Rows whose key is missing on the other side; a NULL key has no partner either."""
    return union([
        child.join(parent.select(key), key, "left_anti").agg(F.count(F.lit(1)).alias("orphan_count")).withColumn("fk_check", F.lit(n))
        for n, (child, parent, key) in relations.items()
    ])


def totals(frames: dict[str, DataFrame], aggs: dict[str, Column]) -> DataFrame:
    """The same aggregates over several tables, one row each."""
    return union([d.agg(*[c.alias(n) for n, c in aggs.items()]).withColumn("source", F.lit(s)) for s, d in frames.items()])


def compare_totals(frames: dict[str, DataFrame], aggs: dict[str, Column]) -> DataFrame:
    """As :func:`totals`, with the difference of every measure to the first table."""
    first = next(iter(frames))
    rows = totals(frames, aggs)
    return rows.withColumns({f"{n}_diff": F.col(n) - frames[first].agg(c).scalar() for n, c in aggs.items()})


def null_keys(fact: DataFrame, columns: list[str]) -> DataFrame:
    return fact.agg(F.count(F.lit(1)).alias("total_rows"), *[count_if(F.col(c).isNull()).alias(f"null_{c}") for c in columns])


def key_gaps(left: DataFrame, right: DataFrame, key: str, left_name: str, right_name: str) -> DataFrame:
    """Rows without partner in either direction, from one full join of the key counts."""
    side = lambda d, n: d.groupBy(key).agg(F.count(F.lit(1)).alias(n))
    both = side(left, "l").join(side(right, "r"), key, "full").agg(
        F.coalesce(F.sum(F.when(F.col("r").isNull(), F.col("l"))), F.lit(0)).alias("l"),
        F.coalesce(F.sum(F.when(F.col("l").isNull(), F.col("r"))), F.lit(0)).alias("r"))
    return both.select(F.inline(F.array(
        F.struct(F.lit(f"in_{left_name}_not_{right_name}").alias("gap"), F.col("l").alias("cnt")),
        F.struct(F.lit(f"in_{right_name}_not_{left_name}").alias("gap"), F.col("r").alias("cnt")))))


def customers_missing(orders: DataFrame, sales: DataFrame, customers: DataFrame) -> DataFrame:
    """Distinct customers of orders and of keyed sales that the dimension does not know."""
    gone = orders.join(customers.select("customer_id"), "customer_id", "left_anti").agg(F.count_distinct("customer_id").alias("cnt"))
    unkeyed = sales.where("customer_key IS NULL AND customer_id IS NOT NULL").agg(F.count_distinct("customer_id").alias("cnt"))
    return union([gone.withColumn("check_name", F.lit("orders_customer_not_in_dim")), unkeyed.withColumn("check_name", F.lit("fact_sales_customer_not_in_dim"))])


def mart_against_lines(revenue: DataFrame, lines: DataFrame) -> DataFrame:
    """Region totals of the mart next to the same totals from the lines.

    Order counts of the mart add up months, which is right because an order has one date.
    """
    mart = revenue.groupBy("region").agg(
        F.round(F.sum("total_sales"), 2).alias("sales"), F.round(F.sum("total_profit"), 2).alias("profit"), F.sum("order_count").alias("orders"))
    direct = lines.groupBy("region").agg(
        F.round(F.sum("sales"), 2).alias("sales"), F.round(F.sum("profit"), 2).alias("profit"), F.count_distinct("order_id").alias("orders"))
    return mart.withColumn("src", F.lit("mart")).unionByName(direct.withColumn("src", F.lit("direct")))


def null_region_leak(sales: DataFrame) -> DataFrame:
    return sales.groupBy(F.coalesce("region", F.lit("** NULL **")).alias("region")).agg(
        F.count(F.lit(1)).alias("row_count"), F.round(F.sum("sales"), 2).alias("sales"), F.round(F.sum("profit"), 2).alias("profit"))


def rate_check(rates: DataFrame) -> DataFrame:
    """Stored return rate against a recomputed one."""
    again = ratio(F.col("total_returns"), F.col("total_orders_sold"), 2, 100)
    return rates.select(
        "vendor_id", "vendor_name", "total_orders_sold", "total_returns", "return_rate_pct", again.alias("computed_rate_pct"),
        F.when(F.abs(F.col("return_rate_pct") - again) < 0.01, "OK").otherwise("MISMATCH").alias("check_result"),
        "total_sales", "total_refund_amount")


def ratio_buckets(returns: DataFrame) -> DataFrame:
    """How far refunds are from the matched sale."""
    r = F.col("return_to_sales_ratio")
    bucket = F.when(r.isNull(), NO_RATIO)
    for end, name in RATIO_BANDS:
        bucket = bucket.otherwise(name) if end is None else bucket.when(r <= end, name)
    return returns.groupBy(bucket.alias("ratio_bucket")).agg(
        F.count(F.lit(1)).alias("returns_count"), mean(F.sum(r), F.count(r)).alias("avg_ratio"),
        F.min("refund_amount").alias("min_refund"), F.max("refund_amount").alias("max_refund"),
        F.min("original_sales").alias("min_matched_sale"), F.max("original_sales").alias("max_matched_sale"))


def worst_matches(returns: DataFrame, k: int = 15) -> DataFrame:
    return (
        returns.where("return_to_sales_ratio IS NOT NULL")
        .orderBy(F.col("return_to_sales_ratio").desc(), F.col("refund_amount").desc(), "order_id", "product_id").limit(k)
        .select("return_to_sales_ratio", "refund_amount", "original_sales", "product_id", "order_id")
    )


def band_audit(history: DataFrame) -> DataFrame:
    """Range of the inputs inside every risk band."""
    return history.groupBy("fraud_risk_score").agg(
        F.count(F.lit(1)).alias("customers"), F.min("total_returns").alias("min_returns"), F.max("total_returns").alias("max_returns"),
        F.min("avg_return_to_sales_ratio").alias("min_ratio"), F.max("avg_return_to_sales_ratio").alias("max_ratio"),
        F.min("max_single_refund").alias("min_max_refund"), F.max("max_single_refund").alias("max_max_refund"),
        F.round(F.sum("total_refund_amount"), 2).alias("total_refunds"))


def region_coverage(customers: DataFrame, orders: DataFrame, lines: DataFrame) -> DataFrame:
    """Customers, orders and sales per region, including regions that sell nothing.

    Orders and sales are reduced to one row per customer before they meet the customers.
    """
    per_order = lines.groupBy("order_id").agg(F.sum("sales").alias("sales"))
    per_customer = orders.select("order_id", "customer_id").join(per_order, "order_id", "left").groupBy("customer_id").agg(
        F.count_distinct("order_id").alias("orders"), F.sum("sales").alias("sales"))
    return customers.join(per_customer, "customer_id", "left").groupBy("region").agg(
        F.count_distinct("customer_id").alias("total_customers"), F.coalesce(F.sum("orders"), F.lit(0)).alias("total_orders"),
        F.round(F.coalesce(F.sum("sales"), F.lit(0)), 2).alias("total_sales"))


def calendar_coverage(calendar: DataFrame, orders: DataFrame) -> DataFrame:
    day = F.to_date("order_purchase_timestamp")
    span = orders.agg(F.min(day).alias("lo"), F.max(day).alias("hi"))
    return calendar.agg(
        F.min("full_date").alias("calendar_start"), F.max("full_date").alias("calendar_end"), F.count(F.lit(1)).alias("calendar_days"),
        span.select("lo").scalar().alias("earliest_order"), span.select("hi").scalar().alias("latest_order"))


def distinct_products(frames: dict[str, DataFrame]) -> DataFrame:
    return totals(frames, {"distinct_products": F.count_distinct("product_id")})


def findings_by_severity(findings: DataFrame) -> DataFrame:
    return findings.where("_discovery_status <> 'error'").groupBy("entity", "severity", "issue_type").agg(F.count(F.lit(1)).alias("findings"))


def returns_without_sale(returns: DataFrame) -> DataFrame:
    gone = F.col("original_sales").isNull()
    return returns.agg(
        F.count(F.lit(1)).alias("total_returns"), count_if(gone).alias("returns_without_transactions"),
        F.sum(F.when(gone, F.col("refund_amount")).otherwise(0)).alias("lost_comparison_value"))


def orders_of_unmatched_returns(orders: DataFrame, returns: DataFrame, lines: DataFrame) -> DataFrame:
    unmatched = returns.select("order_id").distinct().join(lines.select("order_id"), "order_id", "left_anti")
    return orders.join(unmatched, "order_id", "left_semi").agg(F.count(F.lit(1)).alias("orders_count"))
