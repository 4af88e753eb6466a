"""Queries for dimensions, facts and golden records."""

from pyspark.sql import functions as F

from tallyhouse.config import CUSTOMER_SOURCES, SURVIVORSHIP
from tallyhouse.operators import mdm, star
from tallyhouse.plans import common
from tallyhouse.plans.registry import query


@query("mdm_1_source_rank", "SELECT _source_file, source_rank, count(*) AS row_count FROM m_ranked GROUP BY 1, 2")
def source_rank(t):
    ranked = common.clean(t, "customers").withColumn("source_rank", mdm.source_rank(F.col("_source_file"), CUSTOMER_SOURCES))
    return ranked.groupBy("_source_file", "source_rank").agg(F.count(F.lit(1)).alias("row_count"))


def _golden(t, strategy):
    rules = [r for r in SURVIVORSHIP if r.strategy == strategy]
    return mdm.golden_record(common.clean(t, "customers"), "customer_id", rules)


@query("mdm_2_source_priority", "SELECT customer_id, customer_name, segment, region, country FROM m_priority")
def source_priority(t):
    rules = [r for r in SURVIVORSHIP if r.strategy == "source_priority"]
    return mdm.golden_record(common.clean(t, "customers"), "customer_id", rules).drop("_load_timestamp")


@query("mdm_3_most_recent", "SELECT customer_id, city, state, postal_code, _load_timestamp FROM m_recent")
def most_recent(t):
    return _golden(t, "most_recent")


@query("mdm_4_most_complete", "SELECT customer_id, customer_email FROM m_complete")
def most_complete(t):
    return _golden(t, "most_complete").drop("_load_timestamp")


@query("mdm_5_golden_customers", "SELECT * FROM m_customers")
def golden_customers(t):
    return mdm.golden_customers(common.clean(t, "customers"))


@query(
    "mdm_6_latest_products",
    "SELECT * FROM c_products QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY _load_timestamp DESC) = 1",
)
def latest_products(t):
    return mdm.keep_latest(common.clean(t, "products"), "product_id")


@query(
    "mdm_6_latest_vendors",
    "SELECT vendor_id, vendor_name, _load_timestamp FROM c_vendors QUALIFY row_number() OVER (PARTITION BY vendor_id ORDER BY _load_timestamp DESC) = 1",
)
def latest_vendors(t):
    return mdm.keep_latest(common.clean(t, "vendors"), "vendor_id").select("vendor_id", "vendor_name", "_load_timestamp")


@query("dim_1_customers", "SELECT md5(CAST(customer_id AS VARCHAR)) AS customer_key, * FROM s_customers")
def dim_customers(t):
    return star.dim_customers(t.customers)


@query("dim_2_products", "SELECT md5(CAST(product_id AS VARCHAR)) AS product_key, * FROM s_products")
def dim_products(t):
    return star.dim_products(t.products)


@query("dim_3_vendors", "SELECT md5(CAST(vendor_id AS VARCHAR)) AS vendor_key, * FROM s_vendors")
def dim_vendors(t):
    return star.dim_vendors(t.vendors)


@query("dim_4_dates", "SELECT * FROM g_dates")
def dim_dates(t):
    return star.dim_dates(t.orders, t.returns)


@query("fct_1_orders", "SELECT md5(CAST(order_id AS VARCHAR)) AS order_key, * FROM s_orders")
def fact_orders(t):
    return star.fact_orders(t.orders)


@query("fct_2_sales", "SELECT * EXCLUDE (day, _source_file) FROM g_sales")
def fact_sales(t):
    return common.full_sales(t)


@query("fct_3_returns", "SELECT * FROM g_returns")
def fact_returns(t):
    return common.full_returns(t)


@query("fct_4_match_confidence", "SELECT match_confidence, count(*) AS returns_count, sum(refund_amount) AS refunds FROM g_returns GROUP BY 1")
def match_confidence(t):
    return star.match_returns(t.returns, t.lines).groupBy("match_confidence").agg(
        F.count(F.lit(1)).alias("returns_count"), F.sum("refund_amount").alias("refunds"))


@query(
    "fct_5_candidate_lines",
    """SELECT order_id, count(*) AS price_points, CAST(sum(n) AS BIGINT) AS lines, min(sales) AS lowest, max(sales) AS highest
       FROM (SELECT order_id, sales, count(*) AS n FROM s_lines GROUP BY 1, 2) points GROUP BY 1""",
)
def candidate_lines(t):
    points = star.price_points(t.lines)  # the form that holds for orders of any length
    return points.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("price_points"), F.sum("lines").alias("lines"), F.min("price").alias("lowest"), F.max("price").alias("highest"))
