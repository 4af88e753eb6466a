"""Queries that explore the raw tables."""

from pyspark.sql import functions as F

from tallyhouse.config import ENTITIES
from tallyhouse.operators import profile as ex
from tallyhouse.plans.check_views import div
from tallyhouse.plans.registry import query

COLUMNS = {
    "customers": ["customer_id", "customerid", "cust_id", "customer_identifier", "customer_email", "email_address", "customer_name", "full_name", "segment",
                  "customer_segment", "country", "city", "state", "postal_code", "region", "source_file"],
    "returns": ["order_id", "orderid", "refund_amount", "amount", "return_date", "date_of_return", "return_reason", "reason", "return_status", "status", "source_file"],
    "vendors": ["vendor_id", "vendor_name", "source_file"],
}


@query(
    "eda_1_missing_values",
    "SELECT * FROM (" + " UNION ALL ".join(
        f"SELECT '{e}' AS table_name, '{c}' AS column_name, count(CASE WHEN {c} IS NULL OR trim({c}) = '' THEN 1 END) AS null_or_empty_count, count(*) AS total_rows, "
        f"{div(f'''count(CASE WHEN {c} IS NULL OR trim({c}) = '' THEN 1 END)''', 'count(*)', 2, 100)} AS pct_missing FROM b_{e}" for e, cs in COLUMNS.items() for c in cs)
    + ") t WHERE null_or_empty_count > 0",
)
def missing_values(t):
    return ex.missing_values({e: t.bronze(e).select(*cs) for e, cs in COLUMNS.items()})


KEYS = {"customers": "customer_identifier", "orders": "order_id", "transactions": "order_id", "returns": "order_id", "products": "product_id", "vendors": "vendor_id"}


@query(
    "eda_2_duplicate_keys",
    f"SELECT *, total_rows - distinct_keys AS duplicate_rows, {div('total_rows - distinct_keys', 'total_rows', 2, 100)} AS pct_duplicates FROM (" + " UNION ALL ".join(
        f"SELECT '{e}' AS table_name, '{k}' AS key_column, (SELECT count(*) FROM b_{e}) AS total_rows, (SELECT count(*) FROM (SELECT DISTINCT {k} FROM b_{e}) d) AS distinct_keys" for e, k in KEYS.items()) + ") t",
)
def duplicate_keys(t):
    return ex.duplicate_keys({e: (t.bronze(e), k) for e, k in KEYS.items()})


MONEY = [("transactions", "sales"), ("transactions", "profit"), ("returns", "refund_amount"), ("returns", "amount")]


@query(
    "eda_3_prefix_share",
    f"SELECT *, total_rows - with_prefix AS without_prefix, {div('with_prefix', 'total_rows', 1, 100)} AS pct_with_prefix, CASE WHEN with_prefix > 0 THEN 'MIXED' ELSE 'CLEAN' END AS status FROM ("
    + " UNION ALL ".join(f"SELECT '{e}' AS table_name, '{c}' AS column_name, count(*) AS total_rows, count(CASE WHEN {c} LIKE '$%' THEN 1 END) AS with_prefix FROM b_{e}" for e, c in MONEY) + ") t",
)
def prefix_share(t):
    return ex.prefix_share([(e, t.bronze(e), c) for e, c in MONEY])


KINDS = [("returns", "return_status"), ("returns", "status"), ("returns", "return_reason"), ("returns", "reason"), ("orders", "order_status"), ("orders", "ship_mode"),
         ("customers", "segment"), ("customers", "region"), ("transactions", "payment_type")]


@query("eda_4_distributions", " UNION ALL ".join(f"SELECT '{e}' AS table_name, '{c}' AS column_name, {c} AS value, count(*) AS cnt FROM b_{e} GROUP BY 3" for e, c in KINDS))
def distributions(t):
    return ex.distributions([(e, t.bronze(e), c) for e, c in KINDS])


_CUSTOMER = "coalesce(customer_id, customerid, cust_id, customer_identifier)"
OVERLAPS = [("orders.customer_id in customers", "orders", "customer_id", "customers", _CUSTOMER), ("transactions.order_id in orders", "transactions", "order_id", "orders", "order_id"),
            ("returns.order_id in orders", "returns", "coalesce(order_id, orderid)", "orders", "order_id"), ("transactions.product_id in products", "transactions", "product_id", "products", "product_id")]


@query(
    "eda_5_key_overlap",
    "SELECT *, source_distinct_keys - matched_in_target AS orphaned_keys FROM (" + " UNION ALL ".join(
        f"SELECT '{n}' AS relationship, count(*) AS source_distinct_keys, count(CASE WHEN id IN (SELECT {tk} FROM b_{target} WHERE {tk} IS NOT NULL) THEN 1 END) AS matched_in_target "
        f"FROM (SELECT DISTINCT {sk} AS id FROM b_{source}) s" for n, source, sk, target, tk in OVERLAPS) + ") t",
)
def key_overlap(t):
    return ex.key_overlap({n: (t.bronze(source), F.expr(sk), t.bronze(target), F.expr(tk)) for n, source, sk, target, tk in OVERLAPS})


@query("snk_5_overview", " UNION ALL ".join(f"SELECT '{e}' AS table_name, count(*) AS row_count FROM b_{e}" for e in ENTITIES))
def overview(t):
    return ex.overview({e: t.bronze(e) for e in ENTITIES}).select("table_name", "row_count")
