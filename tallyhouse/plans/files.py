"""Raw files of the regional systems, written from the bronze entities, and queries over their headers and broken parts.

Headers are read from the files; the layouts below only say what is written.
"""

from pyspark.sql import DataFrame, functions as F

from tallyhouse.config import CONTRACTS
from tallyhouse.operators import profile as ex
from tallyhouse.plans.check_views import RUN_AT, RUN_ID
from tallyhouse.plans.common import run_at
from tallyhouse.plans.registry import query
from tallyhouse.session import work_dir
from tallyhouse.sources import ingest

_ORDER = ["order_id", "customer_id", "ship_mode", "order_status", "order_purchase_date", "order_approved_at", "order_delivered_carrier_date", "order_delivered_customer_date", "order_estimated_delivery_date"]
_LINE = ["order_id", "product_id", "sales", "quantity", "discount", "profit", "payment_type", "payment_installments"]
_PLACE = ["segment", "country", "city", "state", "postal_code", "region"]
_PART = ["product_id", "product_name", "brand", "categories", "colors", "manufacturer", "sizes", "upc", "product_photos_qty", "dateadded", "dateupdated"]
#: File name -> columns of the bronze entity, in the order of the file.
COLUMNS = {
    "customers_1": ["customer_id", "customer_email", "customer_name", *_PLACE],
    "customers_2": ["customerid", "customer_email", "customer_name", *_PLACE],
    "customers_3": ["cust_id", "customer_email", "customer_name", *_PLACE],
    "customers_4": ["customer_id", "customer_email", "customer_name", "segment", "country", "state", "city", "postal_code", "region"],
    "customers_5": ["customer_id", "customer_name", "segment", "country", "city", "state"],
    "customers_6": ["customer_identifier", "email_address", "full_name", "customer_segment", "country", "city", "state", "postal_code"],
    "orders_1": _ORDER, "orders_2": _ORDER, "orders_3": _ORDER[:-1],
    "transactions_1": _LINE, "transactions_2": [c for c in _LINE if c != "profit"], "transactions_3": _LINE[::-1],
    "vendors": ["vendor_id", "vendor_name"],
    "returns_1": ["order_id", "refund_amount", "return_date", "return_reason", "return_status"],
    "returns_2": ["orderid", "amount", "date_of_return", "reason", "status"],
    "products_1": _PART, "products_2": _PART,
}
#: Spellings in the files that differ from the bronze names.
SPELLED = {"customers_2": {"customerid": "CustomerID"}, "returns_2": {"orderid": "OrderId"}}
JSON = ("returns_1", "returns_2", "products_1", "products_2")


def entity_of(name: str) -> str:
    return name.split("_")[0]


def header(name: str) -> list[str]:
    return [SPELLED.get(name, {}).get(c, c) for c in COLUMNS[name]]


def layout(path) -> F.Column:
    """The name of the layout that a written file belongs to: the folder it lies in."""
    return F.element_at(F.split(path, "/"), -2)


def write_files(t, root: str, names=tuple(COLUMNS)) -> None:
    for name in names:
        rows = t.bronze(entity_of(name)).where(F.regexp_extract("source_file", r"([a-z]+(_[0-9])?)\.", 1) == name)
        part = rows.select(*COLUMNS[name]).toDF(*header(name)).write
        if name in JSON:
            part.option("ignoreNullFields", "false").json(f"{root}/json/{name}")
        else:
            part.option("header", "true").csv(f"{root}/csv/{name}")


def headers(t, kind: str = "all") -> DataFrame:
    """The distinct headers of the written files, under the names of their layouts."""
    root = work_dir(t.spark, "raw")
    write_files(t, root, [n for n in COLUMNS if kind in ("all", entity_of(n))])
    found = ingest.csv_headers(t.spark, f"{root}/csv")
    if kind == "all":
        found = found.unionByName(ingest.json_headers(t.spark, f"{root}/json"))
    return found.select(layout(F.col("path")).alias("file_name"), "columns").distinct().withColumn("path", F.concat(F.lit("raw/"), "file_name"))


def _values(rows: list[tuple]) -> str:
    return ", ".join("(" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in row) + ")" for row in rows)


_BY_ENTITY = {c.entity: c for c in CONTRACTS}
_EXPECTED = _values([
    (n, entity_of(n), ",".join(header(n)).lower(), ", ".join(_BY_ENTITY[entity_of(n)].key_variants), ",".join(_BY_ENTITY[entity_of(n)].required), _BY_ENTITY[entity_of(n)].min_cols) for n in COLUMNS])
_SEEN = " UNION ".join(f"SELECT DISTINCT regexp_extract(source_file, '([a-z]+(_[0-9])?)[.]', 1) AS f FROM b_{c.entity}" for c in CONTRACTS)
CONTRACT_SQL = f"""
    SELECT file_name, entity, CASE WHEN min_ok AND key_ok AND req_ok THEN 'PASS' ELSE 'WARN' END AS status, n AS data_columns,
           array_to_string(list_sort(string_split(cols, ',')), ', ') AS columns_found, CASE WHEN key_ok THEN 'PASS' ELSE 'WARN' END AS key_check,
           CASE WHEN req_ok THEN 'PASS' ELSE 'WARN' END AS required_check, CASE WHEN min_ok THEN 'PASS' ELSE 'WARN' END AS min_columns_check,
           CASE WHEN min_ok AND key_ok AND req_ok THEN 'None' ELSE concat_ws('; ', CASE WHEN NOT min_ok THEN 'too narrow: ' || CAST(n AS VARCHAR) || ' of at least ' || CAST(least_n AS VARCHAR) || ' columns' END,
             CASE WHEN NOT key_ok THEN 'no key among ' || keys END, CASE WHEN NOT req_ok THEN 'absent: ' || gone END) END AS issues, '{RUN_ID}' AS run_id, {RUN_AT} AS checked_at
    FROM (SELECT *, n >= least_n AS min_ok, list_has_any(string_split(cols, ','), string_split(keys, ', ')) AS key_ok, gone = '' AS req_ok
          FROM (SELECT *, CAST(len(string_split(cols, ',')) AS INTEGER) AS n, array_to_string(list_filter(CASE WHEN req = '' THEN CAST([] AS VARCHAR[]) ELSE string_split(req, ',') END,
                          lambda r: NOT list_contains(string_split(cols, ','), r)), ', ') AS gone
                FROM (VALUES {_EXPECTED}) v(file_name, entity, cols, keys, req, least_n) WHERE file_name IN (SELECT f FROM ({_SEEN}) s)) b) c"""


@query("src_8_contract_check", CONTRACT_SQL)
def contract_check(t):
    """Written CSV and JSON files of all entities against their contracts."""
    return ingest.contract_check(headers(t), run_id=RUN_ID, run_at=run_at()).drop("file_path")


@query("chk_3_contract_results", f"SELECT entity, file_name, status, key_check, required_check, min_columns_check, issues, run_id, checked_at FROM ({CONTRACT_SQL}) r")
def contract_results(t):
    found = ingest.contract_check(headers(t), run_id=RUN_ID, run_at=run_at())
    return found.select("entity", "file_name", "status", "key_check", "required_check", "min_columns_check", "issues", "run_id", "checked_at").orderBy("entity", "file_name")


_CUSTOMERS = [n for n in COLUMNS if n.startswith("customers")]
_CUSTOMER_LAYOUTS = _values([(n, ",".join(header(n)).lower()) for n in _CUSTOMERS])


@query(
    "src_6_drift_report",
    f"""SELECT file_name, array_to_string(list_sort(more), ', ') AS added_columns, array_to_string(list_sort(less), ', ') AS missing_columns, CASE WHEN len(more) + len(less) = 0 THEN 'SAME' ELSE 'DRIFT' END AS status
        FROM (SELECT v.file_name, list_filter(string_split(v.cols, ','), lambda c: NOT list_contains(string_split(first.cols, ','), c)) AS more,
                     list_filter(string_split(first.cols, ','), lambda c: NOT list_contains(string_split(v.cols, ','), c)) AS less
              FROM (VALUES {_CUSTOMER_LAYOUTS}) v(file_name, cols), (VALUES ('{",".join(header("customers_1"))}')) first(cols)
              WHERE v.file_name IN (SELECT DISTINCT regexp_extract(source_file, '([a-z]+(_[0-9])?)[.]', 1) FROM b_customers)) d""",
)
def drift_report(t):
    """Customer files against the layout of the first of them."""
    return ingest.drift_report(headers(t, "customers"), header("customers_1"))


def _matrix_sql() -> str:
    rows = []
    for column in dict.fromkeys(c.lower() for n in _CUSTOMERS for c in header(n)):
        spelled = [next((c for c in header(n) if c.lower() == column), "MISSING") for n in _CUSTOMERS]
        rows.append((column, *spelled))
    return f"SELECT * FROM (VALUES {_values(rows)}) v(column_name, {', '.join(_CUSTOMERS)}) WHERE (SELECT count(*) FROM b_customers) > 0"


@query("eda_6_schema_matrix", _matrix_sql())
def schema_matrix(t):
    """Headers of the customer files side by side."""
    return ex.schema_matrix(headers(t, "customers"), _CUSTOMERS)


_CSV_ENTITIES = ("customers", "orders", "transactions", "vendors")
_ROWS_BY_FILE = " UNION ALL ".join(f"SELECT regexp_extract(source_file, '([a-z]+(_[0-9])?)[.]', 1) AS source, count(*) AS row_count FROM b_{e} GROUP BY 1" for e in _CSV_ENTITIES)


def _csv_root(t, name: str) -> str:
    root = work_dir(t.spark, name)
    write_files(t, root, [n for n in COLUMNS if n not in JSON])
    return f"{root}/csv"


@query("src_3_lineage", _ROWS_BY_FILE)
def lineage(t):
    """Rows of all CSV entities by the file they came from."""
    rows = ingest.ingest_csv(t.spark, _csv_root(t, "lineage"))
    return rows.where("load_timestamp IS NOT NULL").groupBy(layout(F.col("source_file")).alias("source")).agg(F.count(F.lit(1)).alias("row_count"))


@query("src_7_discovered_files", f"SELECT source, row_count FROM ({_ROWS_BY_FILE}) r")
def discovered_files(t):
    """Files found by listing, with the rows that a load takes from them; a file without rows or a row without a listed file would show as NULL."""
    root = _csv_root(t, "listed")
    listed = ingest.discover(t.spark, root, "*.csv").select(F.col("file_name").alias("name"), layout(F.col("path")).alias("source"))
    loaded = ingest.ingest_csv(t.spark, root).groupBy(layout(F.col("source_file")).alias("from"), F.element_at(F.split("source_file", "/"), -1).alias("name")).agg(F.count(F.lit(1)).alias("n"))
    both = listed.join(loaded, (listed["name"] == loaded["name"]) & (listed["source"] == loaded["from"]), "full")
    # a part that holds nothing but a header gives no rows
    return both.groupBy("source").agg(F.sum(F.coalesce("n", F.lit(0))).cast("bigint").alias("row_count"))


def write_lines(lines: DataFrame, path: str, first: str | None = None) -> None:
    """Lines of text as they are; each file begins with ``first``."""
    text = F.col("line")
    if first:
        text = F.when(F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0, F.concat(F.lit(first + "\n"), text)).otherwise(text)
    lines.select(text.alias("value")).write.text(path)


_RETURN_LINE = """'{' || CASE WHEN order_id IS NULL THEN '' ELSE '"order_id":"' || order_id || '",' END || '"refund_amount":"' || refund_amount || '","return_status":"' || return_status || '","return_reason":"' || return_reason || '"}'"""


@query(
    "src_5_rescued_json",
    f"""SELECT CASE WHEN bad THEN NULL ELSE CAST(CAST(order_id AS BIGINT) AS VARCHAR) END AS order_id, CASE WHEN bad THEN NULL ELSE TRY_CAST(refund_amount AS DOUBLE) END AS refund_amount,
               CASE WHEN bad THEN NULL ELSE return_status END AS return_status, CASE WHEN bad OR TRY_CAST(refund_amount AS DOUBLE) IS NOT NULL THEN NULL ELSE refund_amount END AS lost_amount,
               CASE WHEN bad THEN NULL ELSE return_reason END AS unknown_reason, CASE WHEN bad THEN substr(line, 1, length(line) - 2) END AS broken_line
        FROM (SELECT *, {_RETURN_LINE} AS line, coalesce(CAST(order_id AS BIGINT) % 17 = 3, FALSE) AS bad FROM b_returns WHERE source_file LIKE '%returns_1%') r""",
)
def rescued_json(t):
    """JSON lines with broken lines, an unknown field and amounts that are no numbers."""
    path = work_dir(t.spark, "rescue_json")
    rows = t.bronze("returns").where("source_file LIKE '%returns_1%'").withColumn("line", F.to_json(F.struct("order_id", "refund_amount", "return_status", "return_reason")))
    write_lines(rows.selectExpr("CASE WHEN CAST(order_id AS BIGINT) % 17 = 3 THEN substr(line, 1, length(line) - 2) ELSE line END AS line"), path)
    found = ingest.read_json_rescued(t.spark, path, "order_id bigint, refund_amount double, return_status string", glob="*.txt")
    kept = lambda name: F.get_json_object("_rescued_data", f"$.{name}")
    return found.select(F.col("order_id").cast("string"), "refund_amount", "return_status", kept("refund_amount").alias("lost_amount"), kept("return_reason").alias("unknown_reason"), kept("_line").alias("broken_line"))


_SALE_LINE = "order_id || ',' || coalesce(product_id, '') || ',' || sales || ',' || quantity"


@query(
    "src_5_rescued_csv",
    f"""SELECT CASE WHEN bad THEN NULL ELSE CAST(CAST(order_id AS BIGINT) AS VARCHAR) END AS order_id, CASE WHEN bad THEN NULL ELSE TRY_CAST(sales AS DOUBLE) END AS sales,
               CASE WHEN bad OR TRY_CAST(sales AS DOUBLE) IS NOT NULL THEN NULL ELSE sales END AS lost_sales, CASE WHEN bad THEN NULL ELSE product_id END AS unknown_product,
               CASE WHEN bad THEN NULL ELSE CAST(TRY_CAST(quantity AS INTEGER) AS VARCHAR) END AS quantity, CASE WHEN bad OR TRY_CAST(quantity AS INTEGER) IS NOT NULL THEN NULL ELSE quantity END AS lost_quantity,
               CASE WHEN bad THEN {_SALE_LINE} || ',more' END AS broken_line
        FROM (SELECT *, CAST(order_id AS BIGINT) % 19 = 4 AS bad FROM b_transactions WHERE order_id IS NOT NULL) r""",
)
def rescued_csv(t):
    """CSV lines with a cell too many, an unknown column and texts where numbers belong."""
    path = work_dir(t.spark, "rescue_csv")
    rows = t.bronze("transactions").where("order_id IS NOT NULL")
    write_lines(rows.selectExpr(f"{_SALE_LINE} || CASE WHEN CAST(order_id AS BIGINT) % 19 = 4 THEN ',more' ELSE '' END AS line"), path, "order_id,product_id,sales,quantity")
    found = ingest.read_csv_rescued(t.spark, path, "order_id bigint, sales double, quantity int", glob="*.txt")
    kept = lambda name: F.get_json_object("_rescued_data", f"$.{name}")
    return found.select(F.col("order_id").cast("string"), "sales", kept("sales").alias("lost_sales"), kept("product_id").alias("unknown_product"), F.col("quantity").cast("string"), kept("quantity").alias("lost_quantity"), kept("_line").alias("broken_line"))
