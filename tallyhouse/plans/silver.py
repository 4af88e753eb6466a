"""Queries for cleaning and harmonisation."""

from pyspark.sql import functions as F

from tallyhouse.functions import clean as cl
from tallyhouse.operators import harmonize as hz, quality as dq
from tallyhouse.plans import common
from tallyhouse.plans.check_views import _DISCOUNT_RAW, _day, _money, _refund, _segment, _stamp, _status
from tallyhouse.plans.registry import query


def counted(df, *columns):
    """Distinct results with their number of rows, so that the whole table is compared."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("row_count"))


def counted_sql(inner: str) -> str:
    return f"SELECT *, count(*) AS row_count FROM ({inner}) t GROUP BY ALL"


@query("cln_1_currency", counted_sql(f"SELECT sales, {_money('sales', 'DECIMAL(10,3)')} AS sales_value FROM b_transactions"))
def currency(t):
    return counted(t.bronze("transactions").select("sales", cl.currency(F.col("sales")).alias("sales_value")), "sales", "sales_value")


@query("cln_1_refund", counted_sql(f"SELECT amount, {_refund('amount')} AS amount_value FROM b_returns"))
def refund(t):
    return counted(t.bronze("returns").select("amount", cl.refund(F.col("amount")).alias("amount_value")), "amount", "amount_value")


@query(
    "cln_2_discount_scale",
    counted_sql(
        f"SELECT discount, CAST(CASE WHEN {_DISCOUNT_RAW} >= 1 THEN CAST({_DISCOUNT_RAW} AS DECIMAL(12,5)) * CAST(0.01 AS DECIMAL(3,2)) ELSE {_DISCOUNT_RAW} END AS DECIMAL(12,5)) AS discount_fraction FROM b_transactions"
    ),
)
def discount_scale(t):
    df = t.bronze("transactions").select("discount", cl.discount_fraction(F.col("discount")).alias("discount_fraction"))
    return counted(df, "discount", "discount_fraction")


@query("cln_3_categories", counted_sql(f"SELECT segment, {_segment('segment')} AS clean_segment FROM b_customers"))
def categories(t):
    return counted(t.bronze("customers").select("segment", cl.segment(F.col("segment")).alias("clean_segment")), "segment", "clean_segment")


@query("cln_3_return_status", counted_sql(f"SELECT return_status, {_status('return_status')} AS clean_status FROM b_returns"))
def return_status(t):
    df = t.bronze("returns").select("return_status", cl.return_status(F.col("return_status")).alias("clean_status"))
    return counted(df, "return_status", "clean_status")


@query(
    "cln_4_region_names",
    counted_sql(
        "SELECT b.region, CASE upper(trim(b.region)) WHEN 'S' THEN 'South' WHEN 'C' THEN 'Central' WHEN 'W' THEN 'West' WHEN 'E' THEN 'East' WHEN 'N' THEN 'North' ELSE b.region END AS region_name FROM b_customers b"
    ),
)
def region_names(t):
    return counted(t.bronze("customers").select("region", cl.region(F.col("region")).alias("region_name")), "region", "region_name")


@query("cln_5_placeholders", counted_sql("SELECT payment_type, CASE WHEN payment_type <> '?' THEN payment_type END AS payment FROM b_transactions"))
def placeholders(t):
    df = t.bronze("transactions").select("payment_type", cl.placeholder(F.col("payment_type")).alias("payment"))
    return counted(df, "payment_type", "payment")


@query("cln_6_timestamps", counted_sql(f"SELECT order_purchase_date, {_stamp('order_purchase_date')} AS purchased FROM b_orders"))
def timestamps(t):
    df = t.bronze("orders").select("order_purchase_date", cl.timestamp(F.col("order_purchase_date")).alias("purchased"))
    return counted(df, "order_purchase_date", "purchased")


@query("cln_7_dates", counted_sql(f"SELECT date_of_return, {_day('date_of_return')} AS returned FROM b_returns"))
def dates(t):
    return counted(t.bronze("returns").select("date_of_return", cl.date(F.col("date_of_return")).alias("returned")), "date_of_return", "returned")


@query("cln_8_iso_timestamps", counted_sql("SELECT dateupdated, TRY_CAST(dateupdated AS TIMESTAMP) AS updated FROM b_products"))
def iso_timestamps(t):
    return counted(t.bronze("products").select("dateupdated", cl.iso_timestamp(F.col("dateupdated")).alias("updated")), "dateupdated", "updated")


@query("cln_9_integers", counted_sql("SELECT quantity, TRY_CAST(quantity AS INTEGER) AS units FROM b_transactions"))
def integers(t):
    return counted(t.bronze("transactions").select("quantity", cl.integer(F.col("quantity")).alias("units")), "quantity", "units")


@query("cln_10_date_part", counted_sql("SELECT dateadded, CAST(split_part(dateadded, 'T', 1) AS DATE) AS added FROM b_products"))
def date_part(t):
    return counted(t.bronze("products").select("dateadded", cl.date_part_of(F.col("dateadded")).alias("added")), "dateadded", "added")


# --- harmonisation ------------------------------------------------------------------------------

# A table whose columns carry blanks, capitals and two spellings of one name.
MESSY = ["o_orderkey AS ` Order ID `", "CASE WHEN o_orderkey % 2 = 0 THEN o_custkey END AS `Customer-Id`",
         "CASE WHEN o_orderkey % 2 = 1 THEN o_custkey END AS `customer__ID_`", "o_orderstatus AS `Order Status!`", "o_totalprice AS `__Total$$Price__`"]


@query("src_4_sanitized_columns", "SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus AS order_status, o_totalprice AS total_price FROM orders")
def sanitized_columns(t):
    return hz.sanitize_columns(t.raw("orders").selectExpr(*MESSY))


@query("har_1_harmonize", "SELECT _mapping_source, count(*) AS row_count, count(order_id) AS orders, count(refund_amount) AS refunds, count(return_date) AS dated, min(return_date) AS first_day, max(return_date) AS last_day, sum(refund_amount) AS refund_total FROM h_returns GROUP BY 1")
def harmonize_any(t):
    from tallyhouse.config import Mapping

    # the same operator driven by SQL templates, as a configuration table would hold them
    strip = "try_cast(regexp_replace(nullif({col}, '?'), '[^0-9.]', '') AS decimal(10,2))"
    day = "coalesce(try_to_date(nullif({col}, 'NULL'), 'yyyy-MM-dd'), try_to_date(nullif({col}, 'NULL'), 'MM-dd-yyyy'))"
    mappings = [Mapping("returns", "order_id", "order_id"), Mapping("returns", "orderid", "order_id"),
                Mapping("returns", "refund_amount", "refund_amount", strip), Mapping("returns", "amount", "refund_amount", strip),
                Mapping("returns", "return_date", "return_date", day), Mapping("returns", "date_of_return", "return_date", day)]
    df = hz.harmonize(t.bronze("returns"), mappings)
    return df.groupBy("_mapping_source").agg(
        F.count(F.lit(1)).alias("row_count"), F.count("order_id").alias("orders"), F.count("refund_amount").alias("refunds"), F.count("return_date").alias("dated"),
        F.min("return_date").alias("first_day"), F.max("return_date").alias("last_day"), F.sum("refund_amount").alias("refund_total"))


for number, entity in enumerate(("customers", "orders", "transactions", "returns", "products", "vendors"), 2):
    query(f"har_{number}_{entity}", f"SELECT * FROM h_{entity}")(lambda t, entity=entity: common.harmonised(t, entity))


@query(
    "har_8_location_swap",
    """SELECT customer_id, _source_file, CASE WHEN swapped THEN city ELSE state END AS state, CASE WHEN swapped THEN state ELSE city END AS city, swapped AS _location_swapped
       FROM (SELECT *, NOT (regexp_matches(state, '^[A-Z]{2}$') OR regexp_matches(state, '^[A-Z][a-z]{2,}$')) AND regexp_matches(city, '^[A-Z]{2}$') AS swapped FROM h_customers) t""",
)
def location_swap(t):
    return hz.repair_location_swap(common.harmonised(t, "customers")).select("customer_id", "_source_file", "state", "city", "_location_swapped")


@query("har_9_mapping_suggestions")
def mapping_suggestions(t):
    return dq.stack_entities({e: hz.suggest_mappings(t.bronze(e), e) for e in ("customers", "orders", "transactions", "returns", "products", "vendors")})


@query(
    "har_9_value_classes",
    """SELECT 'sales' AS source_column, count(sales) AS n, count(CASE WHEN regexp_matches(sales, '^\\$?-?[0-9]+(\\.[0-9]+)?$') THEN 1 END) / count(sales) AS money FROM b_transactions
       UNION ALL SELECT 'payment_type', count(payment_type), 0.0 FROM b_transactions
       UNION ALL SELECT 'quantity', count(quantity), count(TRY_CAST(quantity AS INTEGER)) / count(quantity) FROM b_transactions""",
)
def value_classes(t):
    return hz.value_profile(t.bronze("transactions").select("sales", "payment_type", "quantity")).select("source_column", "n", "money")


@query(
    "har_10_mapping_provenance",
    " UNION ALL ".join(f"SELECT '{e}' AS entity, _mapping_source, count(*) AS cnt FROM c_{e} GROUP BY 2" for e in ("customers", "orders", "transactions", "returns", "products", "vendors")),
)
def mapping_provenance(t):
    entities = ("customers", "orders", "transactions", "returns", "products", "vendors")
    return dq.stack_entities({e: common.clean(t, e) for e in entities}, ["_mapping_source"]).groupBy("entity", "_mapping_source").agg(F.count(F.lit(1)).alias("cnt"))
