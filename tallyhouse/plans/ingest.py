"""Queries that write the derived tables as raw files and load them again.

The files go to the shared working folder (on a local master without one, to a temporary folder).
"""

from pyspark.sql import DataFrame, functions as F

from tallyhouse.operators import setup
from tallyhouse.operators.harmonize import harmonize_entity
from tallyhouse.plans.files import COLUMNS, header
from tallyhouse.plans.registry import query
from tallyhouse.session import work_dir
from tallyhouse.sources import ingest, sinks

def write_return_files(t, root: str) -> None:
    """Line-delimited JSON with two sets of field names."""
    rows = t.bronze("returns")
    rows.where("source_file LIKE '%returns_1%'").select("order_id", "refund_amount", "return_date", "return_reason", "return_status").write.json(f"{root}/returns_1")
    rows.where("source_file LIKE '%returns_2%'").select(
        F.col("orderid").alias("OrderId"), "amount", "date_of_return", "reason", "status").write.json(f"{root}/returns_2")


# Region is lost in two of the layouts, as in the files themselves. Blank texts come back as NULL from CSV.
CUSTOMER_SQL = """SELECT customer_id, nullif(customer_email, '') AS customer_email, customer_name, segment, country, city, state,
    CASE WHEN _source_file LIKE '%customers_5%' THEN NULL ELSE postal_code END AS postal_code,
    CASE WHEN _source_file LIKE '%customers_5%' OR _source_file LIKE '%customers_6%' THEN NULL ELSE region END AS region,
    string_split(string_split(_source_file, '/')[2], '.')[1] AS source FROM h_customers"""


def customers_of(bronze: DataFrame) -> DataFrame:
    rows = harmonize_entity(bronze, "customers")
    return rows.select(
        "customer_id", "customer_email", "customer_name", "segment", "country", "city", "state", "postal_code", "region",
        F.regexp_extract("_source_file", r"(customers_\d)", 1).alias("source"))


@query("src_1_csv_stream", CUSTOMER_SQL)
def csv_stream(t):
    """Two incremental runs: the second one meets two files with new layouts."""
    root = work_dir(t.spark, "csv")
    rows = t.bronze("customers")
    for i, name in enumerate([n for n in COLUMNS if n.startswith("customers")], 1):
        part = rows.where(F.col("source_file").endswith(f"/{name}.csv")).select(*COLUMNS[name]).toDF(*header(name))
        part.write.option("header", "true").csv(f"{root}/raw/Region {i}/{name}")
        if name == "customers_4":
            ingest.ingest_csv_stream(t.spark, f"{root}/raw", f"{root}/bronze", f"{root}/checkpoint")
    ingest.ingest_csv_stream(t.spark, f"{root}/raw", f"{root}/bronze", f"{root}/checkpoint")
    return customers_of(ingest.read_bronze(t.spark, f"{root}/bronze"))


RETURN_SCHEMA = "order_id string, refund_amount string, return_date string, return_reason string, return_status string, OrderId string, amount string, date_of_return string, reason string, status string"


@query("src_2_json_stream", "SELECT order_id, refund_amount, return_date, return_reason, return_status FROM h_returns")
def json_stream(t):
    root = work_dir(t.spark, "json")
    write_return_files(t, f"{root}/raw")
    ingest.ingest_json_stream(t.spark, f"{root}/raw", f"{root}/bronze", f"{root}/checkpoint", RETURN_SCHEMA, multi_line=False)
    rows = harmonize_entity(ingest.read_bronze(t.spark, f"{root}/bronze"), "returns")
    return rows.select("order_id", "refund_amount", "return_date", "return_reason", "return_status")


@query("src_9_folder_load", "SELECT 'returns_1' AS table_name, count(*) AS row_count FROM b_returns WHERE source_file LIKE '%returns_1%' UNION ALL SELECT 'returns_2', count(*) FROM b_returns WHERE source_file LIKE '%returns_2%'")
def folder_load(t):
    root = work_dir(t.spark, "folder")
    write_return_files(t, root)
    parts = None
    for name, rows in ingest.load_folder(t.spark, root, multi_line=False).items():
        one = rows.agg(F.count(F.lit(1)).alias("row_count")).withColumn("table_name", F.lit(name))
        parts = one if parts is None else parts.unionByName(one)
    return parts


@query("src_10_table_reads", "SELECT o_orderstatus, count(*) AS row_count FROM orders GROUP BY 1")
def table_reads(t):
    """Batch read of a table that a stream has filled from the given file."""
    from tallyhouse.streaming.streams import file_stream, run_append

    root = work_dir(t.spark, "table")
    run_append(file_stream(t.spark, t.dir, "orders.parquet"), f"{root}/orders", f"{root}/checkpoint")
    t.spark.read.parquet(f"{root}/orders").createOrReplaceTempView("streamed_orders")
    return ingest.read_table(t.spark, "streamed_orders").groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("row_count"))


@query("src_11_config_seed", "SELECT e.entity, r.n AS rules, m.n AS mappings, e.row_count FROM (" + " UNION ALL ".join(
    f"SELECT '{e}' AS entity, (SELECT count(*) FROM b_{e}) AS row_count" for e in ("customers", "orders", "transactions", "returns", "products", "vendors"))
    + ") e JOIN (VALUES ('customers', 5), ('orders', 5), ('transactions', 8), ('returns', 4), ('products', 3), ('vendors', 2)) r(entity, n) ON e.entity = r.entity"
      " JOIN (VALUES ('customers', 15), ('orders', 10), ('transactions', 8), ('returns', 10), ('products', 13), ('vendors', 2)) m(entity, n) ON e.entity = m.entity")
def config_seed(t):
    """Rules and mappings per entity, next to the rows they apply to."""
    from tallyhouse.config import ENTITIES
    from tallyhouse.operators import checks

    n = lambda table, out: setup.config_table(t.spark, table).groupBy("entity").agg(F.count(F.lit(1)).cast("int").alias(out))
    return n("dq_rules", "rules").join(n("column_mapping", "mappings"), "entity").join(checks.row_counts({e: t.bronze(e) for e in ENTITIES}), "entity")


@query("snk_1_append_merge", "SELECT order_id, refund_amount, amount FROM b_returns")
def append_merge(t):
    """Two appends with different columns, read as one table."""
    path = work_dir(t.spark, "append")
    rows = t.bronze("returns")
    sinks.append(rows.where("source_file LIKE '%returns_1%'").select("order_id", "refund_amount"), path)
    sinks.append(rows.where("source_file LIKE '%returns_2%'").select("order_id", "amount"), path)
    return sinks.read_merged(t.spark, path).select("order_id", "refund_amount", "amount")


@query("snk_2_replace", "SELECT vendor_id, upper(vendor_name) AS name FROM b_vendors")
def replace(t):
    """Replace a table by a version of itself with other columns."""
    path = work_dir(t.spark, "replace")
    sinks.replace(t.bronze("vendors"), path)
    sinks.replace(sinks.read_current(t.spark, path).select("vendor_id", F.upper("vendor_name").alias("name")), path)
    return sinks.read_current(t.spark, path)


@query("snk_3_clustered", "SELECT product_id, vendor_id, sales, quantity FROM s_lines")
def clustered(t):
    path = work_dir(t.spark, "clustered")
    sinks.write_clustered(t.lines.select("product_id", "vendor_id", "sales", "quantity"), path, "product_id", "vendor_id")
    return t.spark.read.parquet(path)


@query("snk_3_zordered", "SELECT product_id, vendor_id, sales, quantity FROM s_lines")
def zordered(t):
    path = work_dir(t.spark, "zordered")
    sinks.write_zordered(t.lines.select("product_id", "vendor_id", "sales", "quantity"), path, "product_id", "vendor_id", partitions=16)
    return t.spark.read.parquet(path)


@query("snk_3_files_read")
def files_read(t):
    """Of 64 files, how many a filter on one vendor must read under either layout, on average over all vendors."""
    path = work_dir(t.spark, "layouts")
    rows = t.lines.select("product_id", "vendor_id", "sales")
    sinks.write_clustered(rows, f"{path}/linear", "product_id", "vendor_id", partitions=64)
    sinks.write_zordered(rows, f"{path}/zordered", "product_id", "vendor_id", partitions=64)
    vendors = rows.select("vendor_id").distinct()
    out = None
    for layout in ("linear", "zordered"):
        ranges = t.spark.read.parquet(f"{path}/{layout}").groupBy(F.col("_metadata.file_path").alias("file")).agg(F.min("vendor_id").alias("lo"), F.max("vendor_id").alias("hi"))
        bounds = ranges.agg(F.collect_list(F.struct("lo", "hi")).alias("r")).scalar()  # one entry per file of the layout
        hit = vendors.withColumn("r", bounds).select(F.size(F.filter("r", lambda x: (x["lo"] <= F.col("vendor_id")) & (F.col("vendor_id") <= x["hi"]))).alias("n"), F.size("r").alias("files"))
        one = hit.agg(F.lit(layout).alias("layout"), F.max("files").alias("files"), F.round(F.avg("n"), 2).alias("files_read"))
        out = one if out is None else out.unionByName(one)
    return out


@query("snk_4_run_log", "SELECT 'rejections' AS notebook, (SELECT count(*) FROM b_transactions) AS records_processed, (SELECT count(*) FROM q_transactions WHERE _expectation_name = 'valid_sales') AS records_flagged, 'SUCCESS' AS status")
def run_log(t):
    """Counts for the log are observed while the rows are written, not counted again."""
    from tallyhouse.config import rules_for
    from tallyhouse.operators.quality import expect
    from tallyhouse.plans import common

    path = work_dir(t.spark, "run")
    rows, seen = expect(common.harmonised(t, "transactions"), "transactions", [r for r in rules_for("transactions") if r.rule_name == "valid_sales"])
    rows.write.parquet(f"{path}/rows")
    sinks.log_run(t.spark, f"{path}/log", "rejections", seen.get["rows"], seen.get["valid_sales"])
    return sinks.read_merged(t.spark, f"{path}/log").select("notebook", "records_processed", "records_flagged", "status")
