"""Retail entities derived from the given star-schema tables.

Each view is a base relation plus a list of projections. The projections are written in the
common subset of Spark SQL and ANSI SQL, so that the check SQL can use the very same text
for the *inputs*; the operators themselves are written twice, once here in Spark and once in
the check SQL. ``{ts}`` stands for the literal keyword of a timestamp without time zone.

Prefix ``s_``: clean entities as they leave the cleaning layer. Prefix ``b_``: raw text as it
arrives from six regional systems, with the usual dirt put in by key.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

# through whole cents: a direct cast of a double to a decimal goes through its text
EXT = "CAST(CAST(floor(l_extendedprice * 100 + 0.5) AS BIGINT) * 0.01 AS DECIMAL(10,2))"
DISC = "CAST(CAST(floor(abs(l_discount) * 100 + 0.5) AS BIGINT) * 0.01 AS DECIMAL(4,2))"
PHANTOM = "CASE WHEN l_orderkey % 50 = 7 AND l_linenumber = 7 THEN -1 - l_orderkey ELSE l_orderkey END"
REFUND = (
    f"CAST(CASE l_linenumber % 4 WHEN 0 THEN {EXT} WHEN 1 THEN {EXT} * 2 "
    f"WHEN 2 THEN {EXT} - 100 ELSE {EXT} * 6 END AS DECIMAL(10,2))"
)
REASON = (
    "CASE l_linenumber WHEN 1 THEN 'Defective' WHEN 2 THEN 'Wrong Item' WHEN 3 THEN 'Duplicate Order' "
    "WHEN 4 THEN 'Not As Described' WHEN 5 THEN 'Changed Mind' WHEN 6 THEN 'Damaged' ELSE 'Late Delivery' END"
)
STATUS = "CASE WHEN l_linenumber = 6 THEN 'Rejected' WHEN l_linestatus = 'O' THEN 'Pending' ELSE 'Approved' END"
SHIP_MODE = (
    "CASE o_orderpriority WHEN '1-URGENT' THEN 'Same Day' WHEN '2-HIGH' THEN 'First Class' "
    "WHEN '3-MEDIUM' THEN 'Second Class' ELSE 'Standard Class' END"
)
ORDER_STATUS = "CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped' ELSE 'processing' END"

# name -> (base relation, projections)
VIEWS: dict[str, tuple[str, list[str]]] = {
    "s_customers": (
        "customer_geo",
        [
            "c_custkey AS customer_id",
            "CASE WHEN c_custkey % 10 = 3 THEN NULL ELSE lower(replace(c_name, '#', '.')) || '@example.com' END AS customer_email",
            "c_name AS customer_name",
            "CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Consumer' WHEN 'HOUSEHOLD' THEN 'Consumer' "
            "WHEN 'FURNITURE' THEN 'Home Office' ELSE 'Corporate' END AS segment",
            "'United States' AS country",
            "n_name AS city",
            "'S' || chr(65 + n_nationkey) AS state",
            "lpad(CAST(c_custkey % 100000 AS STRING), 5, '0') AS postal_code",
            "CASE n_regionkey WHEN 0 THEN 'South' WHEN 1 THEN 'Central' WHEN 2 THEN 'West' "
            "WHEN 3 THEN 'East' ELSE 'North' END AS region",
        ],
    ),
    "s_vendors": ("supplier", ["s_suppkey AS vendor_id", "s_name AS vendor_name"]),
    "s_products": (
        "part",
        [
            "p_partkey AS product_id",
            "p_name AS product_name",
            "p_brand AS brand",
            "p_type || ',size ' || CAST(p_size AS STRING) AS categories",
            "substr(p_name, 1, 4) AS colors",
            "'Maker ' || substr(p_brand, 7, 1) AS manufacturer",
            "CAST(NULL AS STRING) AS dimension",
            "CAST(p_size AS STRING) AS sizes",
            "lpad(CAST(p_partkey AS STRING), 12, '0') AS upc",
            "CAST(NULL AS STRING) AS weight",
            "CAST(p_size % 5 AS BIGINT) AS product_photos_qty",
            "{ts} '2014-01-01 00:00:00' + p_size * INTERVAL 1 DAY AS date_added",
            "{ts} '2015-01-01 00:00:00' + p_size * INTERVAL 1 DAY AS date_updated",
        ],
    ),
    "s_orders": (
        "orders",
        [
            "o_orderkey AS order_id",
            "o_custkey AS customer_id",
            f"{SHIP_MODE} AS ship_mode",
            f"{ORDER_STATUS} AS order_status",
            "o_orderdate AS order_purchase_timestamp",
            "o_orderdate + INTERVAL 1 HOUR AS order_approved_timestamp",
            "o_orderdate + INTERVAL 2 DAY AS order_delivered_carrier_timestamp",
            "CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderdate + INTERVAL 6 DAY END AS order_delivered_customer_timestamp",
            "o_orderdate + INTERVAL 10 DAY AS order_estimated_delivery_timestamp",
        ],
    ),
    "s_lines": (
        "lineitem",
        [
            "l_orderkey AS order_id",
            "l_partkey AS product_id",
            "l_suppkey AS vendor_id",
            f"{EXT} AS sales",
            "CAST(l_quantity AS INT) AS quantity",
            f"{DISC} AS discount",
            f"CAST({EXT} * (CAST(0.05 AS DECIMAL(4,2)) - {DISC}) AS DECIMAL(14,4)) AS profit",
            "CASE l_linenumber % 4 WHEN 0 THEN 'credit_card' WHEN 1 THEN 'debit_card' WHEN 2 THEN 'voucher' ELSE 'bank_transfer' END AS payment_type",
            "l_linenumber AS payment_installments",
            "'transactions_' || CAST(1 + l_linenumber % 3 AS STRING) || '.csv' AS _source_file",
        ],
    ),
    "s_returns": (
        "returned_lines",
        [
            f"{PHANTOM} AS order_id",
            f"{REFUND} AS refund_amount",
            "CAST(l_shipdate AS DATE) AS return_date",
            f"{REASON} AS return_reason",
            f"{STATUS} AS return_status",
        ],
    ),
    "b_customers": (
        "customer_files",
        [
            "CASE WHEN f IN (1, 4, 5) AND k % 89 <> 5 THEN CAST(k AS STRING) END AS customer_id",
            "CASE WHEN f = 2 AND k % 89 <> 5 THEN CAST(k AS STRING) END AS customerid",
            "CASE WHEN f = 3 AND k % 89 <> 5 THEN CAST(k AS STRING) END AS cust_id",
            "CASE WHEN f = 6 AND k % 89 <> 5 THEN CAST(k AS STRING) END AS customer_identifier",
            "CASE WHEN f IN (1, 2, 4) THEN customer_email WHEN f = 3 THEN CASE WHEN k % 5 = 0 THEN '' ELSE customer_email END END AS customer_email",
            "CASE WHEN f = 6 AND k % 9 <> 0 THEN 'alt.' || customer_email END AS email_address",
            "CASE WHEN f < 6 AND k % 67 <> 0 THEN customer_name END AS customer_name",
            "CASE WHEN f = 6 THEN upper(customer_name) END AS full_name",
            "CASE WHEN f < 6 THEN dirty_segment END AS segment",
            "CASE WHEN f = 6 THEN dirty_segment END AS customer_segment",
            "country",
            "CASE WHEN f = 4 THEN state ELSE city END AS city",
            "CASE WHEN f = 4 THEN city ELSE state END AS state",
            "postal_code",
            "CASE WHEN f = 6 THEN region WHEN k % 4 = 0 THEN ' ' || lower(substr(region, 1, 1)) ELSE substr(region, 1, 1) END AS region",
            "'Region ' || CAST(f AS STRING) || '/customers_' || CAST(f AS STRING) || '.csv' AS source_file",
            "CASE WHEN k % 4 = 0 THEN {ts} '2024-01-10 00:00:00' ELSE {ts} '2024-01-01 00:00:00' + f * INTERVAL 1 DAY END AS load_timestamp",
        ],
    ),
    "b_orders": (
        "order_texts",
        [
            "CASE WHEN o_orderkey % 211 <> 0 THEN CAST(o_orderkey AS STRING) END AS order_id",
            "CAST(o_custkey AS STRING) AS customer_id",
            f"CASE WHEN o_orderkey % 9 <> 0 THEN {SHIP_MODE} END AS ship_mode",
            f"{ORDER_STATUS} AS order_status",
            "CASE WHEN o_orderkey % 101 = 0 THEN 'n/a' ELSE day_text || ' ' || hour_text || ':15' END AS order_purchase_date",
            "day_text || ' ' || hour_text || ':30' AS order_approved_at",
            "CASE WHEN o_orderstatus <> 'P' THEN day_text || ' ' || hour_text || ':45' END AS order_delivered_carrier_date",
            "CASE WHEN o_orderstatus = 'F' THEN day_text || ' ' || hour_text || ':50' END AS order_delivered_customer_date",
            "CASE WHEN o_orderkey % 3 <> 2 THEN day_text || ' ' || hour_text || ':55' END AS order_estimated_delivery_date",
            "'Region ' || CAST(1 + o_orderkey % 6 AS STRING) || '/orders_' || CAST(1 + o_orderkey % 3 AS STRING) || '.csv' AS source_file",
            "{ts} '2024-01-01 00:00:00' + CAST(o_orderkey % 3 AS INT) * INTERVAL 1 DAY AS load_timestamp",
        ],
    ),
    "b_transactions": (
        "lineitem",
        [
            "CASE WHEN l_orderkey % 313 <> 0 THEN CAST(l_orderkey AS STRING) END AS order_id",
            "CASE WHEN l_partkey % 197 <> 0 THEN CAST(l_partkey AS STRING) END AS product_id",
            f"CASE WHEN l_partkey % 83 = 1 THEN 'abc' WHEN l_orderkey % 5 = 0 THEN '$' || CAST({EXT} AS STRING) ELSE CAST({EXT} AS STRING) END AS sales",
            "CASE WHEN l_suppkey % 50 = 9 THEN 'many' ELSE CAST(CAST(l_quantity AS INT) AS STRING) END AS quantity",
            f"CASE l_linenumber % 3 WHEN 0 THEN CAST({DISC} AS STRING) WHEN 1 THEN CAST(CAST({DISC} * 100 AS INT) AS STRING) "
            f"ELSE CAST(CAST({DISC} * 100 AS INT) AS STRING) || '%' END AS discount",
            f"CASE WHEN l_linenumber % 3 = 1 THEN NULL WHEN l_orderkey % 7 = 0 THEN '$' || CAST(CAST({EXT} * 0.25 AS DECIMAL(10,2)) AS STRING) "
            f"ELSE CAST(CAST({EXT} * (CAST(0.05 AS DECIMAL(4,2)) - {DISC}) AS DECIMAL(10,2)) AS STRING) END AS profit",
            "CASE l_linenumber % 4 WHEN 0 THEN 'credit_card' WHEN 1 THEN 'debit_card' WHEN 2 THEN 'voucher' ELSE '?' END AS payment_type",
            "CAST(l_linenumber AS STRING) AS payment_installments",
            "'Region ' || CAST(1 + l_linenumber % 6 AS STRING) || '/transactions_' || CAST(1 + l_linenumber % 3 AS STRING) || '.csv' AS source_file",
            "{ts} '2024-01-01 00:00:00' + CAST(l_linenumber % 3 AS INT) * INTERVAL 1 DAY AS load_timestamp",
        ],
    ),
    "b_returns": (
        "returned_lines",
        [
            "CASE WHEN l_linenumber % 3 <> 0 AND l_orderkey % 311 <> 0 THEN CAST(l_orderkey AS STRING) END AS order_id",
            "CASE WHEN l_linenumber % 3 = 0 AND l_orderkey % 311 <> 0 THEN CAST(l_orderkey AS STRING) END AS orderid",
            f"CASE WHEN l_linenumber % 3 <> 0 THEN CASE WHEN l_partkey % 6 = 0 THEN '$' ELSE '' END || CAST({REFUND} AS STRING) END AS refund_amount",
            f"CASE WHEN l_linenumber % 3 = 0 THEN CASE WHEN l_partkey % 41 = 0 THEN '?' WHEN l_partkey % 43 = 0 THEN '0.00' ELSE CAST({REFUND} AS STRING) END END AS amount",
            "CASE WHEN l_linenumber % 3 <> 0 THEN substr(CAST(l_shipdate AS STRING), 1, 10) END AS return_date",
            "CASE WHEN l_linenumber % 3 = 0 THEN CASE WHEN l_partkey % 37 = 0 THEN 'NULL' ELSE "
            "substr(CAST(l_shipdate AS STRING), 6, 2) || '-' || substr(CAST(l_shipdate AS STRING), 9, 2) || '-' || substr(CAST(l_shipdate AS STRING), 1, 4) END END AS date_of_return",
            f"CASE WHEN l_linenumber % 3 <> 0 THEN {REASON} END AS return_reason",
            f"CASE WHEN l_linenumber % 3 = 0 THEN CASE WHEN l_partkey % 9 = 0 THEN '?' ELSE {REASON} END END AS reason",
            "CASE WHEN l_linenumber % 3 <> 0 THEN CASE l_linenumber % 4 WHEN 0 THEN 'PENDG' WHEN 1 THEN 'APPRVD' ELSE 'RJCTD' END END AS return_status",
            f"CASE WHEN l_linenumber % 3 = 0 THEN CASE WHEN l_partkey % 71 = 0 THEN 'Lost' ELSE {STATUS} END END AS status",
            "'Region ' || CAST(1 + l_linenumber % 6 AS STRING) || '/returns_' || CASE WHEN l_linenumber % 3 = 0 THEN '2' ELSE '1' END || '.json' AS source_file",
            "{ts} '2024-01-01 00:00:00' + CAST(l_linenumber % 3 AS INT) * INTERVAL 1 DAY AS load_timestamp",
        ],
    ),
    "b_products": (
        "part_files",
        [
            "CASE WHEN p_partkey % 149 <> 3 THEN CAST(p_partkey AS STRING) END AS product_id",
            "CASE WHEN p_partkey % 31 <> 0 THEN p_name END AS product_name",
            "CASE WHEN p_partkey % 17 <> 0 THEN CASE WHEN f = 2 THEN p_brand || ' (new)' ELSE p_brand END END AS brand",
            "p_type || ',size ' || CAST(p_size AS STRING) AS categories",
            "substr(p_name, 1, 4) AS colors",
            "'Maker ' || substr(p_brand, 7, 1) AS manufacturer",
            "CAST(p_size AS STRING) AS sizes",
            "lpad(CAST(p_partkey AS STRING), 12, '0') AS upc",
            "CAST(p_size % 5 AS BIGINT) AS product_photos_qty",
            "'2014-03-' || lpad(CAST(1 + p_size % 28 AS STRING), 2, '0') || 'T05:07:09' AS dateadded",
            "CASE WHEN p_partkey % 19 = 0 THEN 'soon' ELSE '2015-04-' || lpad(CAST(1 + p_size % 28 AS STRING), 2, '0') || 'T15:17:19' END AS dateupdated",
            "'products_' || CAST(f AS STRING) || '.json' AS source_file",
            "{ts} '2024-01-01 00:00:00' + f * INTERVAL 1 DAY AS load_timestamp",
        ],
    ),
    "b_vendors": (
        "supplier",
        [
            "CASE WHEN s_suppkey % 40 <> 39 THEN CAST(s_suppkey AS STRING) END AS vendor_id",
            "CASE WHEN s_suppkey % 13 <> 4 THEN s_name END AS vendor_name",
            "'vendors.csv' AS source_file",
            "{ts} '2024-01-01 00:00:00' AS load_timestamp",
        ],
    ),
}

SEGMENT_DIRT = (
    "CASE WHEN k % 23 = 0 THEN 'Other' WHEN k % 29 = 0 THEN NULL "
    "WHEN segment = 'Consumer' AND k % 3 = 0 THEN 'CONS' WHEN segment = 'Consumer' AND k % 3 = 1 THEN 'Cosumer' "
    "WHEN segment = 'Corporate' AND k % 2 = 0 THEN 'CORP' WHEN segment = 'Home Office' AND k % 2 = 0 THEN 'HO' "
    "ELSE segment END AS dirty_segment"
)
YEAR, MONTH, DAY = (f"lpad(CAST({p}(o_orderdate) AS STRING), {n}, '0')" for p, n in (("year", 4), ("month", 2), ("day", 2)))
DAY_TEXT = (
    f"CASE WHEN o_orderkey % 3 = 0 THEN {MONTH} || '/' || {DAY} || '/' || {YEAR} "
    f"ELSE {YEAR} || '-' || {MONTH} || '-' || {DAY} END AS day_text"
)
HOUR_TEXT = "CASE WHEN o_orderkey % 3 = 2 THEN CAST(o_orderkey % 24 AS STRING) ELSE lpad(CAST(o_orderkey % 24 AS STRING), 2, '0') END AS hour_text"


class Testbed:
    """Lazily built entities over one folder of Parquet tables."""

    __test__ = False

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.dir = sf_dir.rstrip("/")
        self._frames: dict[str, DataFrame] = {}

    def _once(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        if name not in self._frames:
            self._frames[name] = build()
        return self._frames[name]

    def raw(self, table: str) -> DataFrame:
        # reading a schema opens a file, so every table is looked up once
        return self._once(table, lambda: self.spark.read.parquet(f"{self.dir}/{table}.parquet"))

    def view(self, name: str) -> DataFrame:
        base, exprs = VIEWS[name]
        return self._once(f"view {name}", lambda: self._base(base).selectExpr(*[e.replace("{ts}", "TIMESTAMP_NTZ") for e in exprs]))

    def _base(self, name: str) -> DataFrame:
        if name == "customer_geo":
            # nation has 25 rows by definition, so Spark broadcasts it from its file size
            return self.raw("customer").join(self.raw("nation"), F.expr("c_nationkey = n_nationkey"))
        if name == "customer_files":
            return (
                self.view("s_customers")
                .withColumn("f", F.explode(F.expr(
                    "array(CASE region WHEN 'South' THEN 1 WHEN 'Central' THEN 2 WHEN 'West' THEN 3 WHEN 'East' THEN 4 ELSE 5 END, 6)")))
                .withColumnRenamed("customer_id", "k")
                .selectExpr("*", SEGMENT_DIRT)
            )
        if name == "order_texts":
            return self.raw("orders").selectExpr("*", DAY_TEXT, HOUR_TEXT)
        if name == "returned_lines":
            return self.raw("lineitem").where("l_returnflag = 'R'")
        if name == "part_files":
            return self.raw("part").withColumn(
                "f", F.explode(F.expr("CASE WHEN p_partkey % 10 = 0 THEN array(1, 2) ELSE array(1) END")))
        return self.raw(name)

    customers = cached_property(lambda self: self.view("s_customers"))
    orders = cached_property(lambda self: self.view("s_orders"))
    lines = cached_property(lambda self: self.view("s_lines"))
    returns = cached_property(lambda self: self.view("s_returns"))
    products = cached_property(lambda self: self.view("s_products"))
    vendors = cached_property(lambda self: self.view("s_vendors"))

    def bronze(self, entity: str) -> DataFrame:
        return self.view(f"b_{entity}")

    def silver(self, entity: str) -> DataFrame:
        return {
            "customers": self.customers, "orders": self.orders, "transactions": self.lines,
            "returns": self.returns, "products": self.products, "vendors": self.vendors,
        }[entity]


def check_bases() -> dict[str, str]:
    """The same base relations and views as SQL text, for the check SQL."""
    out = {
        "customer_geo": "SELECT * FROM customer JOIN nation ON c_nationkey = n_nationkey",
        "customer_files": (
            f"SELECT *, {SEGMENT_DIRT} FROM (SELECT * EXCLUDE (customer_id), customer_id AS k, unnest([CASE region WHEN 'South' THEN 1 "
            "WHEN 'Central' THEN 2 WHEN 'West' THEN 3 WHEN 'East' THEN 4 ELSE 5 END, 6]) AS f FROM s_customers) t"
        ),
        "order_texts": f"SELECT *, {DAY_TEXT}, {HOUR_TEXT} FROM orders",
        "returned_lines": "SELECT * FROM lineitem WHERE l_returnflag = 'R'",
        "part_files": "SELECT *, unnest(CASE WHEN p_partkey % 10 = 0 THEN [1, 2] ELSE [1] END) AS f FROM part",
    }
    for name, (base, exprs) in VIEWS.items():
        out[name] = "SELECT " + ", ".join(e.replace("{ts}", "TIMESTAMP") for e in exprs) + f" FROM {base}"
    return out
