"""Queries for rules, quarantine, scorecards, findings and audit reports."""

from pyspark.sql import functions as F

from tallyhouse.config import ENTITIES, ENTITY_REPORTS, IMPACT, JARGON_PHRASES, REFUSAL_PHRASES, REPORT_SECTIONS, RULES, rules_for
from tallyhouse.operators import kpis, marts, narrative, quality as dq, setup
from tallyhouse.plans import common
from tallyhouse.plans.check_views import div, quote, rule_sql
from tallyhouse.plans.registry import query
from tallyhouse.session import work_dir
from tallyhouse.sources.testbed import VIEWS


def _violations(entity: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{r.rule_id}' AS rule_id, '{r.rule_name}' AS rule_name, count(CASE WHEN ({rule_sql(r)}) THEN NULL ELSE 1 END) AS violations FROM h_{entity}" for r in rules_for(entity))


@query("dq_1_expect_counts", " UNION ALL ".join(_violations(e) for e in ENTITIES))
def expect_counts(t):
    parts = [dq.violation_counts(common.harmonised(t, e), rules_for(e)) for e in ENTITIES]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("dq_2_drop_violations", "SELECT order_id, product_id, sales, quantity, profit, payment_type FROM c_transactions")
def drop_violations(t):
    return common.clean(t, "transactions").select("order_id", "product_id", "sales", "quantity", "profit", "payment_type")


@query("dq_3_quarantine_transactions", "SELECT * FROM q_transactions")
def quarantine_transactions(t):
    return common.rejected(t, "transactions").drop("_run_timestamp")


@query("dq_4_rule_catalogue", "SELECT rule_name, entity, severity, row_count FROM (" + " UNION ALL ".join(
    f"SELECT '{r.rule_name}' AS rule_name, '{r.entity}' AS entity, '{r.severity}' AS severity, (SELECT count(*) FROM h_{r.entity}) AS row_count" for r in RULES) + ") t")
def rule_catalogue(t):
    sizes = dq.stack_entities({e: common.harmonised(t, e).agg(F.count(F.lit(1)).alias("row_count")) for e in ENTITIES})
    return setup.config_table(t.spark, "dq_rules").join(sizes, "entity").select("rule_name", "entity", "severity", "row_count")


for entity in ENTITIES:
    query(f"dq_5_silver_{entity}", f"SELECT * FROM c_{entity}")(lambda t, entity=entity: common.clean(t, entity))
    if entity != "transactions":
        query(f"dq_5_quarantine_{entity}", f"SELECT * FROM q_{entity}")(lambda t, entity=entity: common.rejected(t, entity).drop("_run_timestamp"))


def _score(entity: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{r.rule_id}' AS rule_id, {quote(r.rule_name)} AS rule_name, {quote(r.rule_expression)} AS expression, '{r.consequence}' AS consequence, "
        f"count(CASE WHEN ({rule_sql(r)}) THEN 1 END) AS passed, count(*) - count(CASE WHEN ({rule_sql(r)}) THEN 1 END) AS failed, "
        f"{div(f'count(CASE WHEN ({rule_sql(r)}) THEN 1 END)', 'count(*)', 1, 100)} AS pass_rate_pct FROM c_{entity}" for r in rules_for(entity))


@query("dq_6_scorecard", " UNION ALL ".join(_score(e) for e in ENTITIES))
def scorecard(t):
    out = None
    for e in ENTITIES:
        part = dq.scorecard(common.clean(t, e), rules_for(e))
        out = part if out is None else out.unionByName(part)
    return out


@query("dq_7_quarantine_breakdown", "SELECT entity, _expectation_name, _severity, _issue_type, _failure_reason, count(*) AS cnt FROM q_all GROUP BY 1, 2, 3, 4, 5")
def quarantine_breakdown(t):
    return dq.quarantine_breakdown({e: common.rejected(t, e) for e in ENTITIES})


@query(
    "dq_8_clean_vs_quarantined",
    f"SELECT *, {div('quarantined_rows', 'total_bronze_rows', 1, 100)} AS quarantine_rate_pct FROM (" + " UNION ALL ".join(
        f"SELECT '{e}' AS entity, (SELECT count(*) FROM c_{e}) + (SELECT count(*) FROM q_{e}) AS total_bronze_rows, "
        f"(SELECT count(*) FROM c_{e}) AS silver_clean_rows, (SELECT count(*) FROM q_{e}) AS quarantined_rows" for e in ENTITIES) + ") t",
)
def clean_vs_quarantined(t):
    return dq.clean_vs_quarantined({e: common.clean(t, e) for e in ENTITIES}, {e: common.rejected(t, e) for e in ENTITIES})


@query(
    "dq_9_before_after_segment",
    """SELECT coalesce(b.value, a.value) AS value, coalesce(b.n, 0) AS before_count, coalesce(a.n, 0) AS after_count
       FROM (SELECT coalesce(segment, customer_segment) AS value, count(*) AS n FROM b_customers GROUP BY 1) b
       FULL JOIN (SELECT segment AS value, count(*) AS n FROM c_customers GROUP BY 1) a ON b.value IS NOT DISTINCT FROM a.value""",
)
def before_after_segment(t):
    return dq.before_after(t.bronze("customers"), common.clean(t, "customers"), F.coalesce("segment", "customer_segment"), F.col("segment"))


@query(
    "dq_10_residual_dirt",
    """SELECT check_name, residual, CASE WHEN residual = 0 THEN 'OK' ELSE 'DIRTY' END AS status FROM (
       SELECT 'currency sign in sales' AS check_name, count(CASE WHEN sales LIKE '$%' THEN 1 END) AS residual FROM b_transactions
       UNION ALL SELECT 'unreadable quantity', count(CASE WHEN TRY_CAST(quantity AS INTEGER) IS NULL THEN 1 END) FROM b_transactions
       UNION ALL SELECT 'abbreviated segment', count(CASE WHEN segment IN ('CONS', 'CORP', 'HO', 'Cosumer') THEN 1 END) FROM c_customers
       UNION ALL SELECT 'abbreviated status', count(CASE WHEN return_status IN ('PENDG', 'APPRVD', 'RJCTD') THEN 1 END) FROM c_returns) t""",
)
def residual_dirt(t):
    raw = dq.assert_clean(t.bronze("transactions"), {
        "currency sign in sales": F.col("sales").startswith("$"), "unreadable quantity": F.col("quantity").try_cast("int").isNull()})
    segment = dq.assert_clean(common.clean(t, "customers"), {"abbreviated segment": F.col("segment").isin("CONS", "CORP", "HO", "Cosumer")})
    status = dq.assert_clean(common.clean(t, "returns"), {"abbreviated status": F.col("return_status").isin("PENDG", "APPRVD", "RJCTD")})
    return raw.unionByName(segment).unionByName(status)


# --- gold expectations -------------------------------------------------------------------------


@query("dq_11_orphan_sales", "SELECT sales_key, order_id, product_id, 'no_orphan_customers' AS _expectation FROM g_sales WHERE customer_id IS NULL")
def orphan_sales(t):
    return dq.orphan_sales(common.full_sales(t)).select("sales_key", "order_id", "product_id", "_expectation")


@query(
    "dq_11_doubtful_returns",
    """SELECT order_id, product_id, refund_amount, original_sales, match_confidence,
              CASE WHEN match_confidence = 'EXACT' THEN 'refund_not_exceeding_5x_sales' ELSE 'low_confidence_match: ' || match_confidence END AS _expectation, 'WARNING' AS _severity
       FROM g_returns WHERE refund_amount > original_sales * 5 OR match_confidence <> 'EXACT'""",
)
def doubtful_returns(t):
    return dq.doubtful_returns(common.returns(t)).select("order_id", "product_id", "refund_amount", "original_sales", "match_confidence", "_expectation", "_severity")


@query("dq_11_revenue_without_region", "SELECT year, month, total_sales, 'region_not_null' AS _expectation FROM g_revenue WHERE region IS NULL")
def revenue_without_region(t):
    return dq.revenue_without_region(common.revenue(t)).select("year", "month", "total_sales", "_expectation")


@query("dq_11_impossible_rates", "SELECT vendor_id, return_rate_pct, 'return_rate_in_range' AS _expectation FROM g_rates WHERE return_rate_pct < 0 OR return_rate_pct > 100")
def impossible_rates(t):
    return dq.impossible_return_rates(common.rates(t)).select("vendor_id", "return_rate_pct", "_expectation")


@query("dq_11_invalid_idle_days", "SELECT product_id, region, days_since_last_sale FROM g_slow WHERE days_since_last_sale IS NULL OR days_since_last_sale < 0")
def invalid_idle_days(t):
    return dq.invalid_idle_days(common.slow(t)).select("product_id", "region", "days_since_last_sale")


# --- profile and findings -------------------------------------------------------------------------

PROFILED = {e: [x.rsplit(" AS ", 1)[-1] for x in VIEWS[f"b_{e}"][1] if not x.endswith((" AS source_file", " AS load_timestamp"))] for e in ENTITIES}
CELLS_SQL = " UNION ALL ".join(f"SELECT '{e}' AS entity, '{c}' AS column_name, CAST({c} AS VARCHAR) AS v FROM b_{e}" for e, cs in PROFILED.items() for c in cs)


@query(
    "dq_12_column_profile",
    f"""SELECT entity, column_name, count(*) AS "rows", {div("count(CASE WHEN v IS NULL OR trim(v) = '' THEN 1 END)", 'count(*)', 1, 100)} AS null_pct,
               count(DISTINCT CASE WHEN NOT (v IS NULL OR trim(v) = '') THEN v END) AS distinct_values, coalesce(array_to_string(list_slice(list_sort(list(DISTINCT v)), 1, 5), ', '), '') AS samples
        FROM ({CELLS_SQL}) cells GROUP BY 1, 2""",
)
def column_profile(t):
    """All columns of all six entities."""
    return dq.column_profile({e: t.bronze(e) for e in ENTITIES})


DISCOVERY_SQL = f"""
    WITH cells AS (SELECT entity, column_name, v, count(*) AS n FROM ({CELLS_SQL}) u WHERE v IS NOT NULL GROUP BY 1, 2, 3),
    stats AS (SELECT entity, column_name, sum(n) AS total, count(*) AS kinds,
        sum(CASE WHEN trim(v) IN ('?', 'NULL', 'n/a', 'N/A', '') THEN n ELSE 0 END) AS ph,
        sum(CASE WHEN regexp_matches(v, '^\\$-?[0-9]') THEN n ELSE 0 END) AS money, sum(CASE WHEN regexp_matches(v, '^-?[0-9]+(\\.[0-9]+)?$') THEN n ELSE 0 END) AS num,
        sum(CASE WHEN regexp_matches(v, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') THEN n ELSE 0 END) AS iso,
        sum(CASE WHEN regexp_matches(v, '^([0-9]{{2}}/[0-9]{{2}}/[0-9]{{4}}|[0-9]{{2}}-[0-9]{{2}}-[0-9]{{4}})') THEN n ELSE 0 END) AS us,
        sum(CASE WHEN v <> trim(v) THEN n ELSE 0 END) AS blank FROM cells GROUP BY 1, 2),
    numbers AS (SELECT entity, column_name, CAST(regexp_replace(v, '[$%]', '', 'g') AS DOUBLE) AS x, n FROM cells WHERE regexp_matches(v, '^\\$?-?[0-9]+(\\.[0-9]+)?%?$')),
    placed AS (SELECT *, sum(n) OVER (PARTITION BY entity, column_name ORDER BY x) AS upto, sum(n) OVER (PARTITION BY entity, column_name) AS every_n FROM numbers),
    quartiles AS (SELECT p.entity, p.column_name, min(CASE WHEN upto >= (every_n + 3) // 4 THEN x END) AS q1, min(CASE WHEN upto >= (3 * every_n + 3) // 4 THEN x END) AS q3
        FROM placed p JOIN stats s ON p.entity = s.entity AND p.column_name = s.column_name WHERE p.every_n * 10 >= (s.total - s.ph) * 9 GROUP BY 1, 2),
    fences AS (SELECT entity, column_name, q1 - CAST(1.5 AS DOUBLE) * (q3 - q1) AS lo, q3 + CAST(1.5 AS DOUBLE) * (q3 - q1) AS hi FROM quartiles),
    found AS (
    SELECT entity, column_name, 'unexpected_values' AS issue_type, 'WARNING' AS severity, CAST(ph AS BIGINT) AS hits, column_name || ' NOT IN (''?'', ''NULL'', ''n/a'', ''N/A'', '''')' AS suggested_rule FROM stats WHERE ph > 0
    UNION ALL SELECT entity, column_name, 'format_inconsistency', 'WARNING', CAST(least(money, num) AS BIGINT), column_name || ' NOT LIKE ''$%''' FROM stats WHERE money > 0 AND num > 0
    UNION ALL SELECT entity, column_name, 'format_inconsistency', 'CRITICAL', CAST(least(iso, us) AS BIGINT), 'one date layout in ' || column_name FROM stats WHERE iso > 0 AND us > 0
    UNION ALL SELECT entity, column_name, 'encoding_issue', 'WARNING', CAST(blank AS BIGINT), column_name || ' = TRIM(' || column_name || ')' FROM stats WHERE blank > 0
    UNION ALL SELECT * FROM (SELECT c.entity, c.column_name, 'suspicious_distribution', 'WARNING', CAST(sum(CASE WHEN c.n < CAST(0.02 AS DOUBLE) * s.total THEN c.n ELSE 0 END) AS BIGINT) AS rare, c.column_name || ' within its frequent values'
        FROM cells c JOIN stats s ON c.entity = s.entity AND c.column_name = s.column_name GROUP BY 1, 2, s.total HAVING rare > 0 AND rare * 4 <= s.total) r
    UNION ALL SELECT n.entity, n.column_name, 'outlier', 'WARNING', CAST(sum(n.n) AS BIGINT), n.column_name || ' BETWEEN ' || CAST(CAST(floor(lo) AS BIGINT) AS VARCHAR) || ' AND ' || CAST(CAST(ceil(hi) AS BIGINT) AS VARCHAR)
        FROM numbers n JOIN fences f ON n.entity = f.entity AND n.column_name = f.column_name WHERE x < lo OR x > hi GROUP BY n.entity, n.column_name, lo, hi)
    SELECT *, entity || '.' || column_name || ': ' || issue_type || ' in ' || CAST(hits AS VARCHAR) || ' rows' AS description FROM found"""


@query("dq_13_discovered_issues", DISCOVERY_SQL)
def discovered_issues(t):
    """All columns of all six entities; none of them has dates out of order, which ``dq_13_date_order`` tries."""
    return dq.discover_issues({e: t.bronze(e) for e in ENTITIES}).drop("discovery_source", "_discovery_status")


_DATED = "SELECT strftime(o_orderdate, '%m/%d/%Y %H:%M') AS order_date, CASE WHEN l_linenumber = 5 THEN 'soon' ELSE strftime(l_shipdate, '%Y-%m-%d') END AS ship_date, l_shipdate + l_linenumber * INTERVAL 1 DAY AS arrived_at FROM lineitem JOIN orders ON l_orderkey = o_orderkey"


@query(
    "dq_13_date_order",
    f"""WITH d AS (SELECT try_strptime(order_date, '%m/%d/%Y %H:%M') AS a, try_strptime(ship_date, '%Y-%m-%d') AS b, arrived_at AS c FROM ({_DATED}) x),
        n AS (SELECT 'order_date' AS x, 'ship_date' AS y, count(CASE WHEN a > b THEN 1 END) AS more, count(CASE WHEN a < b THEN 1 END) AS less FROM d
              UNION ALL SELECT 'order_date', 'arrived_at', count(CASE WHEN a > c THEN 1 END), count(CASE WHEN a < c THEN 1 END) FROM d
              UNION ALL SELECT 'ship_date', 'arrived_at', count(CASE WHEN b > c THEN 1 END), count(CASE WHEN b < c THEN 1 END) FROM d)
        SELECT 'shipments' AS entity, CASE WHEN more <= less THEN x ELSE y END AS column_name, 'date_order' AS issue_type, 'CRITICAL' AS severity, least(more, less) AS hits,
               CASE WHEN more <= less THEN x || ' <= ' || y ELSE y || ' <= ' || x END AS suggested_rule FROM n WHERE least(more, less) > 0""",
)
def date_order(t):
    """Order day against two days of shipping, which the given tables draw independently; one column is text in two layouts."""
    rows = t.raw("lineitem").join(t.raw("orders"), F.expr("l_orderkey = o_orderkey")).selectExpr(
        "date_format(o_orderdate, 'MM/dd/yyyy HH:mm') AS order_date", "CASE WHEN l_linenumber = 5 THEN 'soon' ELSE date_format(l_shipdate, 'yyyy-MM-dd') END AS ship_date",
        "l_shipdate + l_linenumber * INTERVAL 1 DAY AS arrived_at")
    return dq.date_order({"shipments": rows})


@query(
    "dq_14_parsed_findings",
    """SELECT doc_id, 'lang' AS column_name, 'unexpected_values' AS issue_type, 'WARNING' AS severity, source AS suggested_rule, lang AS description FROM documents
       UNION ALL SELECT doc_id, 'n_chars', 'outlier', 'CRITICAL', source, CAST(n_chars AS VARCHAR) FROM documents""",
)
def parsed_findings(t):
    one = lambda c, i, s, d: F.struct(
        F.lit(c).alias("column_name"), F.lit(i).alias("issue_type"), s.alias("severity"), F.col("source").alias("suggested_rule"), d.alias("description"))
    listed = F.to_json(F.array(one("lang", "unexpected_values", F.lit(None).cast("string"), F.col("lang")),
                               one("n_chars", "outlier", F.lit("CRITICAL"), F.col("n_chars").cast("string"))))
    fenced = F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("```json\n"), listed, F.lit("\n```"))).otherwise(listed)
    return dq.parse_findings(t.raw("documents").select("doc_id", "source", "lang", "n_chars", fenced.alias("answer")).select(
        "doc_id", "answer"), "answer")


# --- audit report -----------------------------------------------------------------------------------

# The earlier report covers what was loaded up to this day.
EARLIER = "2024-01-02 00:00:00"


@query(
    "dq_15_increment",
    f"SELECT order_id, refund_amount, _load_timestamp FROM c_returns WHERE _load_timestamp > (SELECT max(_load_timestamp) FROM c_returns WHERE _load_timestamp <= TIMESTAMP '{EARLIER}')",
)
def increment(t):
    rows = common.clean(t, "returns")
    earlier = rows.where(F.col("_load_timestamp") <= F.lit(EARLIER).cast("timestamp_ntz"))
    return dq.newer_than(rows, "_load_timestamp", earlier, "_load_timestamp").select("order_id", "refund_amount", "_load_timestamp")


GROUPS = """SELECT entity, _issue_type AS issue_type, _expectation_name AS field_affected, count(*) AS rejected_count, min(_quarantine_timestamp) AS earliest_failure,
                   max(_quarantine_timestamp) AS latest_failure, list_slice(list_sort(list(DISTINCT _failure_reason)), 1, 3) AS reasons,
                   list_slice(list_sort(list(DISTINCT _source_file)), 1, 5) AS files FROM q_all GROUP BY 1, 2, 3"""
SEVERITY = """CASE WHEN issue_type IN ('missing_value', 'null_primary_key', 'missing_customer_id', 'missing_order_id', 'invalid_category') OR rejected_count > 100 THEN 'CRITICAL'
                   WHEN issue_type IN ('invalid_reference', 'negative_amount', 'orphaned_record', 'duplicate_primary_key', 'format_error') OR rejected_count > 30 THEN 'HIGH' ELSE 'MEDIUM' END"""
IMPACT_SQL = (
    "CASE " + " ".join(f"WHEN entity = '{e}' AND issue_type = '{i}' THEN {quote(text)}" for (e, i), text in IMPACT.items())
    + " " + " ".join(f"WHEN entity = '{e}' THEN 'These records are missing from ' || {quote(r)} || '.'" for e, r in ENTITY_REPORTS.items()) + " END"
)
PRETTY = (
    "array_to_string(list_transform(list_slice(files, 1, 4), lambda p: list_extract(string_split(p, '/'), -1) || "
    "CASE WHEN position('/' IN p) > 0 THEN ' (' || split_part(p, '/', 1) || ')' ELSE '' END), ' | ')"
)


def _groups(t):
    return dq.issue_groups({e: common.rejected(t, e) for e in ENTITIES})


@query("dq_16_issue_groups", f"SELECT * EXCLUDE (reasons, files), array_to_string(reasons, ' | ') AS sample_reasons, array_to_string(files, ' | ') AS source_files FROM ({GROUPS}) g")
def issue_groups(t):
    return _groups(t).withColumns({"sample_reasons": F.array_join("sample_reasons", " | "), "source_files": F.array_join("source_files", " | ")})


@query("dq_17_severity", f"SELECT entity, field_affected, rejected_count, {SEVERITY} AS severity FROM ({GROUPS}) g")
def severity(t):
    return _groups(t).select("entity", "field_affected", "rejected_count", dq.severity_class(F.col("issue_type"), F.col("rejected_count")).alias("severity"))


@query("dq_18_business_impact", f"SELECT entity, field_affected, issue_type, {IMPACT_SQL} AS business_impact FROM ({GROUPS}) g")
def business_impact(t):
    return dq.with_business_impact(_groups(t)).select("entity", "field_affected", "issue_type", "business_impact")


@query("dq_19_pretty_sources", f"SELECT entity, field_affected, {PRETTY} AS sources FROM ({GROUPS}) g")
def pretty_sources(t):
    return _groups(t).select("entity", "field_affected", dq.pretty_sources(F.col("source_files")).alias("sources"))


AUDIT = f"""SELECT entity, field_affected, issue_type, rejected_count, {SEVERITY} AS severity, 'silver.' || entity || '_quarantine' AS source_table, {PRETTY} AS source_files,
                   earliest_failure, latest_failure, array_to_string(reasons, ' | ') AS sample_evidence, 'PASS' AS llm_check, 'none' AS llm_check_detail FROM ({GROUPS}) g"""


@query("dq_20_audit_report", AUDIT)
def audit_report(t):
    return dq.by_severity(dq.audit_report(_groups(t)).drop("explanation", "text"), "entity", "field_affected")


GOLD_RULES = [
    ("no_orphan_customers", "fact_sales", "customer_id", "Revenue Audit", "customer_id IS NULL"),
    ("refund_not_exceeding_5x_sales", "fact_returns", "refund_amount", "Returns Fraud", "refund_amount > original_sales * 5 or uncertain match"),
    ("region_not_null", "mv_revenue_by_region", "region", "Revenue Audit", "region IS NULL"),
    ("return_rate_in_range", "mv_return_rate_by_vendor", "return_rate_pct", "Vendor Quality", "return_rate_pct outside 0 to 100"),
    ("valid_days_since_sale", "mv_slow_moving_products", "days_since_last_sale", "Inventory Blindspot", "days_since_last_sale missing or negative"),
]
GOLD_COLUMNS = "rule_name string, table_checked string, field_checked string, business_failure string, trigger_condition string"


@query(
    "dq_21_gold_rule_report",
    "SELECT rule_name, table_checked, failing_count FROM (VALUES "
    + ", ".join(f"('{r}', '{table}', {sql})" for (r, table, *_), sql in zip(GOLD_RULES, [
        "(SELECT count(*) FROM g_sales WHERE customer_id IS NULL)",
        "(SELECT count(*) FROM g_returns WHERE refund_amount > original_sales * 5 OR match_confidence <> 'EXACT')",
        "(SELECT count(*) FROM g_revenue WHERE region IS NULL)",
        "(SELECT count(*) FROM g_rates WHERE return_rate_pct < 0 OR return_rate_pct > 100)",
        "(SELECT count(*) FROM g_slow WHERE days_since_last_sale < 0)"]))
    + ") v(rule_name, table_checked, failing_count)",
)
def gold_rule_report(t):
    """Matched returns serve two rules, so they are written once."""
    rules = t.spark.createDataFrame(GOLD_RULES, GOLD_COLUMNS)
    returns = common.staged(t, "returns", common.returns(t).select("vendor_id", "refund_amount", "original_sales", "match_confidence"))
    found = {
        "no_orphan_customers": dq.orphan_sales(common.sales(t)),
        "refund_not_exceeding_5x_sales": dq.doubtful_returns(returns),
        "region_not_null": dq.revenue_without_region(common.revenue(t)),
        "return_rate_in_range": dq.impossible_return_rates(marts.return_rate_by_vendor(common.sales(t), returns, t.vendors)),
        "valid_days_since_sale": dq.invalid_idle_days(common.slow(t)),
    }
    return dq.gold_rule_report(found, rules).select("rule_name", "table_checked", "failing_count")


def _check_sql(text: str, words: int, sections=(), jargon=()) -> str:
    any_of = lambda phrases: " OR ".join(f"contains(lower({text}), {quote(p)})" for p in phrases)
    parts = [
        f"CASE WHEN len(list_filter(regexp_split_to_array({text}, '[ \\t\\n\\x0B\\f\\r]+'), lambda w: w <> '')) < {words} THEN 'too_short' END",
        f"CASE WHEN starts_with({text}, 'LLM_UNAVAILABLE') THEN 'llm_call_failed' END",
        f"CASE WHEN {any_of(REFUSAL_PHRASES)} THEN 'refusal_detected' END",
    ]
    if jargon:
        parts.append(f"CASE WHEN {any_of(jargon)} THEN 'technical_jargon_detected' END")
    if sections:
        parts.append("CASE WHEN NOT (" + " AND ".join(f"contains({text}, {quote(s)})" for s in sections) + ") THEN 'missing_section' END")
    return "concat_ws(', ', " + ", ".join(parts) + ")"


@query(
    "dq_22_text_check_documents",
    f"SELECT doc_id, CASE WHEN found = '' THEN 'PASS' ELSE 'REVIEW' END AS llm_check, CASE WHEN found = '' THEN 'none' ELSE found END AS llm_check_detail FROM (SELECT doc_id, {_check_sql('text', 30)} AS found FROM documents) t",
)
def text_check_documents(t):
    return narrative.checked(t.raw("documents"), "text").select("doc_id", "llm_check", "llm_check_detail")


@query(
    "dq_22_text_check_conversations",
    f"""SELECT conv_id, turn, CASE WHEN found = '' THEN 'PASS' ELSE 'REVIEW' END AS llm_check, CASE WHEN found = '' THEN 'none' ELSE found END AS llm_check_detail
        FROM (SELECT conv_id, turn, {_check_sql('text', 30, REPORT_SECTIONS, JARGON_PHRASES)} AS found FROM conversations) t""",
)
def text_check_conversations(t):
    return narrative.checked(t.raw("conversations"), "text", sections=REPORT_SECTIONS, jargon=JARGON_PHRASES).select("conv_id", "turn", "llm_check", "llm_check_detail")


RUNS = "SELECT entity, CAST(_load_timestamp AS DATE) AS run_at, count(*) AS rejected_count FROM (" + " UNION ALL ".join(
    f"SELECT '{e}' AS entity, _load_timestamp FROM q_{e}" for e in ENTITIES) + ") u GROUP BY 1, 2"


@query(
    "dq_23_anomaly_alerts",
    f"""SELECT *, CASE WHEN delta_pct >= 100 THEN 'CRITICAL' WHEN delta_pct >= 50 THEN 'HIGH' ELSE 'MEDIUM' END AS severity_tag
        FROM (SELECT entity, run_at AS detected_at, rejected_count AS current_count, previous_count, {div('rejected_count - previous_count', 'previous_count', 1, 100)} AS delta_pct
              FROM (SELECT *, lag(rejected_count) OVER (PARTITION BY entity ORDER BY run_at) AS previous_count FROM ({RUNS}) r) l) d
        WHERE delta_pct >= 5""",
)
def anomaly_alerts(t):
    rows = dq.stack_entities({e: common.rejected(t, e) for e in ENTITIES}, ["_load_timestamp"])
    runs = rows.groupBy("entity", F.to_date("_load_timestamp").alias("run_at")).agg(F.count(F.lit(1)).alias("rejected_count"))
    return dq.anomaly_alerts(runs, min_delta_pct=5.0)


# --- texts ---------------------------------------------------------------------------------------------


def _sentence(columns: str) -> str:
    return columns


@query(
    "nar_1_rendered_text",
    """SELECT vendor_id, 'Vendor ' || vendor_name || ' sold ' || CAST(total_orders_sold AS VARCHAR) || ' orders and took back ' || CAST(total_returns AS VARCHAR) || ' returns.' AS text FROM g_rates""",
)
def rendered_text(t):
    text = F.format_string("Vendor %s sold %d orders and took back %d returns.", "vendor_name", "total_orders_sold", "total_returns")
    return narrative.render(common.rates(t), text).select("vendor_id", "text")


@query(
    "nar_2_generated_text",
    """SELECT entity, field_affected, rejected_count, 'PASS' AS llm_check FROM (
         SELECT entity, _expectation_name AS field_affected, count(*) AS rejected_count FROM q_all GROUP BY 1, 2) g""",
)
def generated_text(t):
    """The first generator answers tersely for half of the prompts, the second one in full."""
    filler = " This text spells out what happened, why it matters and who has to act on it" * 3

    def terse(prompts):
        return [p + filler if len(p) % 2 else p for p in prompts]

    def full(prompts):
        return [p + filler for p in prompts]

    short = _groups(t).select("entity", "field_affected", "rejected_count", F.concat_ws(" ", "entity", "field_affected", "issue_type").alias("prompt"))
    done = narrative.generate_with_retry(short, "prompt", terse, full, work_dir(t.spark, "texts"))
    return done.select("entity", "field_affected", "rejected_count", "llm_check")


def _insights(t):
    from tallyhouse.plans.kpis import insight_bundles

    return narrative.insight_rows([insight_bundles(t)], lambda c: F.concat(F.lit("Key figures as computed from the marts of the latest month available: "), F.col(c)))


@query(
    "nar_3_insight_rows",
    """SELECT insight_type, TIMESTAMP '2024-02-01 00:00:00' AS generated_at, 'PASS' AS llm_check, CAST(headline AS DOUBLE) AS headline FROM (
         SELECT 'revenue_performance' AS insight_type, (SELECT sum(order_count) FROM g_revenue WHERE year * 12 + month = (SELECT max(year * 12 + month) FROM g_revenue WHERE region IS NOT NULL)) AS headline
         UNION ALL SELECT 'vendor_return_rate', (SELECT count(*) FROM s_vendors) UNION ALL SELECT 'slow_moving_inventory', (SELECT count(*) FROM g_slow WHERE region IS NOT NULL)) v""",
)
def insight_rows(t):
    """One row per domain; the headline is read from the figures in the summary's own text."""
    rows = _insights(t)
    figure = lambda name: F.get_json_object(F.regexp_extract("ai_summary", r"(\{.*)$", 1), f"$.totals.{name}")
    return rows.select("insight_type", "generated_at", "llm_check", F.coalesce(figure("order_count"), figure("vendors"), figure("total_slow_products")).cast("double").alias("headline"))


@query("nar_4_latest_batch", "SELECT order_id, refund_amount, _load_timestamp FROM c_returns WHERE _load_timestamp = (SELECT max(_load_timestamp) FROM c_returns)")
def latest_batch(t):
    return narrative.latest_batch(common.clean(t, "returns"), "_load_timestamp").select("order_id", "refund_amount", "_load_timestamp")
