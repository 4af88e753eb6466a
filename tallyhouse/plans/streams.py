"""Queries that run an operator as a stream and read back what it wrote.

The check is the batch result, so equality means that stream and batch agree.
"""

from tallyhouse.config import rules_for
from tallyhouse.plans.check_views import RUN_ID
from tallyhouse.plans.registry import query
from tallyhouse.session import work_dir
from tallyhouse.sources.testbed import Testbed
from tallyhouse.streaming import streams


class StreamingBed(Testbed):
    """Testbed in which one table arrives as a stream of files."""

    __test__ = False

    def __init__(self, t: Testbed, table: str):
        super().__init__(t.spark, t.dir)
        self._frames[table] = streams.file_stream(t.spark, t.dir, f"{table}.parquet")


@query("str_1_silver_orders", "SELECT order_id, ship_mode, order_status, order_purchase_timestamp, _source_file FROM c_orders")
def silver_orders(t):
    path = work_dir(t.spark, "str1")
    streams.silver_stream(StreamingBed(t, "orders").bronze("orders"), "orders", rules_for("orders"), f"{path}/out", f"{path}/checkpoint")
    return t.spark.read.parquet(f"{path}/out").select("order_id", "ship_mode", "order_status", "order_purchase_timestamp", "_source_file")


@query(
    "str_2_clean_and_quarantine",
    "SELECT 'clean' AS side, NULL AS _expectation_name, count(*) AS row_count FROM c_returns UNION ALL SELECT 'quarantine', _expectation_name, count(*) FROM q_returns GROUP BY 2",
)
def clean_and_quarantine(t):
    from pyspark.sql import functions as F

    path = work_dir(t.spark, "str2")
    streams.silver_with_quarantine(
        StreamingBed(t, "lineitem").bronze("returns"), "returns", rules_for("returns"), RUN_ID, f"{path}/clean", f"{path}/rejected", f"{path}/checkpoint")
    n = F.count(F.lit(1)).alias("row_count")
    clean = t.spark.read.parquet(f"{path}/clean").agg(n).select(F.lit("clean").alias("side"), F.lit(None).cast("string").alias("_expectation_name"), "row_count")
    rejected = t.spark.read.parquet(f"{path}/rejected").groupBy("_expectation_name").agg(n).withColumn("side", F.lit("quarantine"))
    return clean.unionByName(rejected)


@query("str_3_fact_orders", "SELECT md5(CAST(order_id AS VARCHAR)) AS order_key, order_id, customer_id, order_status FROM s_orders")
def fact_orders(t):
    path = work_dir(t.spark, "str3")
    streams.fact_orders_stream(StreamingBed(t, "orders").orders, f"{path}/out", f"{path}/checkpoint")
    return t.spark.read.parquet(f"{path}/out").select("order_key", "order_id", "customer_id", "order_status")


@query("str_4_fact_sales", "SELECT * EXCLUDE (day, _source_file) FROM g_sales")
def fact_sales(t):
    path = work_dir(t.spark, "str4")
    streams.fact_sales_stream(StreamingBed(t, "lineitem").lines, t.orders, t.customers, t.products, t.vendors, f"{path}/out", f"{path}/checkpoint")
    return t.spark.read.parquet(f"{path}/out").drop("batch")


@query("str_5_fact_returns", "SELECT * FROM g_returns")
def fact_returns(t):
    path = work_dir(t.spark, "str5")
    streams.fact_returns_stream(
        StreamingBed(t, "lineitem").returns, t.orders, t.lines, t.customers, t.products, t.vendors, f"{path}/out", f"{path}/checkpoint")
    return t.spark.read.parquet(f"{path}/out").drop("batch")
