"""Queries for executive key figures and the dashboard."""

from pyspark.sql import functions as F

from tallyhouse.operators import checks as ck, fraud, kpis, quality as dq, star
from tallyhouse.plans import common
from tallyhouse.plans.check_views import div
from tallyhouse.plans.fraud import leads
from tallyhouse.plans.quality import AUDIT, _groups
from tallyhouse.plans.registry import query
from tallyhouse.session import work_dir
from tallyhouse.sources import sinks

LAST = "(SELECT max(year * 12 + month - 1) FROM g_revenue WHERE region IS NOT NULL)"


@query(
    "kpi_1_periods",
    f"SELECT CAST(i // 12 AS INTEGER) AS latest_year, CAST(i % 12 + 1 AS INTEGER) AS latest_month, CAST((i - 1) // 12 AS INTEGER) AS prior_year, CAST((i - 1) % 12 + 1 AS INTEGER) AS prior_month FROM (SELECT {LAST} AS i) t",
)
def periods(t):
    return kpis.periods(common.revenue(t))


REGION_SQL = f"""SELECT n.region, n.total_sales, n.total_profit, CASE WHEN n.total_sales > 0 THEN {div('n.total_profit', 'n.total_sales', 1, 100)} ELSE 0.0 END AS profit_margin_pct, n.order_count,
    CASE WHEN coalesce(p.total_sales, n.total_sales) > 0 THEN {div('n.total_sales - coalesce(p.total_sales, n.total_sales)', 'coalesce(p.total_sales, n.total_sales)', 1, 100)} ELSE 0.0 END AS mom_delta_pct
    FROM (SELECT * FROM g_revenue WHERE year * 12 + month - 1 = {LAST}) n LEFT JOIN (SELECT * FROM g_revenue WHERE year * 12 + month - 1 = {LAST} - 1) p ON n.region = p.region"""


@query("kpi_2_region_kpis", REGION_SQL)
def region_kpis(t):
    return kpis.region_kpis(common.revenue(t))


@query(
    "kpi_2_revenue_summary",
    f"""SELECT sum(total_sales) AS total_revenue, arg_max(region, total_sales) AS top_region, arg_min(region, total_sales) AS bottom_region,
               coalesce(string_agg(CASE WHEN mom_delta_pct > 5 THEN region END, ', ' ORDER BY region), '') AS growing_regions,
               coalesce(string_agg(CASE WHEN mom_delta_pct < -5 THEN region END, ', ' ORDER BY region), '') AS declining_regions FROM ({REGION_SQL}) k""",
)
def revenue_summary(t):
    return kpis.revenue_summary(kpis.region_kpis(common.revenue(t)))


VENDOR_SQL = f"""SELECT *, CASE WHEN return_rate > 20 THEN 'HIGH RISK' WHEN total_orders = 0 THEN 'no_return_data' ELSE 'within threshold' END AS status,
               (SELECT {div('sum(total_returns)', 'sum(total_orders_sold)', 1, 100)} FROM g_rates) AS fleet_avg_return_rate
        FROM (SELECT v.vendor_id, v.vendor_name, coalesce(r.total_returns, 0) AS total_returns, coalesce(r.total_orders_sold, 0) AS total_orders, coalesce(r.total_refund_amount, 0) AS total_refund_amount,
                     coalesce({div('r.total_returns', 'r.total_orders_sold', 1, 100)}, 0.0) AS return_rate FROM s_vendors v LEFT JOIN g_rates r ON v.vendor_id = r.vendor_id) t"""


@query("kpi_3_vendor_kpis", VENDOR_SQL)
def vendor_kpis(t):
    return kpis.vendor_kpis(common.rates(t), t.vendors)


STOCK_SQL = f"""SELECT region, count(*) AS slow_product_count, sum(total_sales) AS estimated_exposure, {div('sum(idle)', 'count(idle)', 0)} AS avg_days_stagnant
    FROM (SELECT *, date_diff('day', last_sale_date, (SELECT max(last_sale_date) FROM g_slow)) AS idle FROM g_slow WHERE region IS NOT NULL) s GROUP BY 1"""


@query("kpi_4_slow_stock", STOCK_SQL)
def slow_stock(t):
    return kpis.slow_stock_kpis(common.slow(t))


@query(
    "kpi_4_slow_stock_summary",
    f"""SELECT CAST(sum(slow_product_count) AS BIGINT) AS total_slow_products, sum(estimated_exposure) AS total_exposure,
               (SELECT region FROM ({STOCK_SQL}) w ORDER BY slow_product_count DESC, region DESC LIMIT 1) AS worst_region FROM ({STOCK_SQL}) k""",
)
def slow_stock_summary(t):
    return kpis.slow_stock_summary(kpis.slow_stock_kpis(common.slow(t)))


def insight_bundles(t):
    """Each mart is read for its totals and for its rows, so it is written once."""
    revenue, rates = common.staged(t, "revenue", common.revenue(t)), common.staged(t, "rates", common.rates(t))
    slow = common.staged(t, "slow", common.slow(t).select("region", "total_sales", "last_sale_date"))
    return kpis.insight_bundles(kpis.region_kpis(revenue), kpis.vendor_kpis(rates, t.vendors), kpis.slow_stock_kpis(slow), common.run_at())


BUNDLE = "insight string, generated_at string, totals map<string,double>, by_row array<map<string,string>>"
_TOTALS = {
    "revenue_performance": (REGION_SQL, {"total_sales": "sum(total_sales)", "total_profit": "sum(total_profit)", "order_count": "sum(order_count)"}, "region", "total_sales"),
    "vendor_return_rate": (VENDOR_SQL, {"vendors": "count(*)", "high_risk_vendors": "count(CASE WHEN status = 'HIGH RISK' THEN 1 END)", "total_returns": "sum(total_returns)", "total_refund_amount": "sum(total_refund_amount)"}, "vendor_id", "return_rate"),
    "slow_moving_inventory": (STOCK_SQL, {"total_slow_products": "sum(slow_product_count)", "total_exposure": "sum(estimated_exposure)"}, "region", "slow_product_count"),
}


@query("kpi_5_bundles", " UNION ALL ".join(
    f"SELECT '{kind}' AS insight, '2024-02-01 00:00:00' AS generated_at, '{name}' AS name, CAST({total} AS DOUBLE) AS value, least(count(*), 50) AS rows_listed FROM ({sql}) k{i}"
    for i, (kind, (sql, totals, *_)) in enumerate(_TOTALS.items()) for name, total in totals.items()))
def bundles(t):
    """Totals of the bundles, parsed back from their text."""
    parsed = insight_bundles(t).select(F.from_json("kpi_json", BUNDLE).alias("b"))
    return parsed.select("b.insight", "b.generated_at", F.size("b.by_row").cast("bigint").alias("rows_listed"), F.explode("b.totals").alias("name", "value"))


@query("kpi_5_bundle_rows", " UNION ALL ".join(
    f"SELECT * FROM (SELECT '{kind}' AS insight, CAST({by} AS VARCHAR) AS row_name, CAST({measure} AS DOUBLE) AS headline FROM ({sql}) k ORDER BY {'return_rate DESC, ' if by == 'vendor_id' else ''}{by} LIMIT 50) r{by}"
    for kind, (sql, _, by, measure) in _TOTALS.items()))
def bundle_rows(t):
    """Rows that the bundles list, with their main figure, parsed back from the text."""
    parsed = insight_bundles(t).select(F.from_json("kpi_json", BUNDLE).alias("b")).select("b.insight", F.explode("b.by_row").alias("row"))
    name = F.coalesce(F.try_element_at("row", F.lit("vendor_id")), F.try_element_at("row", F.lit("region")))
    figures = [F.when(F.col("insight") == kind, F.try_element_at("row", F.lit(measure))) for kind, (*_, measure) in _TOTALS.items()]
    return parsed.select("insight", name.alias("row_name"), F.coalesce(*figures).cast("double").alias("headline"))


@query(
    "kpi_6_vendor_assessment",
    """SELECT vendor_id, vendor_name, r AS return_rate_pct, total_returns, CASE WHEN r < 15 THEN 'ACCEPTABLE' WHEN r <= 20 THEN 'CONCERNING' ELSE 'CRITICAL' END AS risk_label
       FROM (SELECT *, CAST(round(CAST(return_rate_pct AS DECIMAL(12,2)), 1) AS DOUBLE) AS r FROM g_rates) t""",
)
def vendor_assessment(t):
    return kpis.vendor_assessment(common.rates(t)).drop("risk_assessment")


@query("kpi_6_revenue_assessment", f"SELECT region, total_sales, total_profit, order_count, CASE WHEN mom_delta_pct < -5 THEN 'ALARMING' WHEN mom_delta_pct > 5 THEN 'OPPORTUNITY' ELSE 'EXPECTED' END AS revenue_label FROM ({REGION_SQL}) k")
def revenue_assessment(t):
    return kpis.revenue_assessment(kpis.region_kpis(common.revenue(t))).drop("revenue_commentary")


# --- dashboard ----------------------------------------------------------------------------------


@query(
    "app_1_platform_stats",
    """SELECT (SELECT count(DISTINCT customer_id) FROM s_customers) AS customers, (SELECT count(*) FROM s_orders) AS orders, (SELECT count(*) FROM g_returns) AS returns,
              (SELECT count(DISTINCT product_id) FROM s_products) AS products, (SELECT count(DISTINCT vendor_id) FROM s_vendors) AS vendors, (SELECT count(*) FROM g_sales) AS transactions""",
)
def platform_stats(t):
    n, rows = (lambda d, c: d.agg(F.count_distinct(c)).scalar()), (lambda d: d.agg(F.count(F.lit(1))).scalar())
    return t.spark.range(1).select(
        n(t.customers, "customer_id").alias("customers"), rows(t.orders).alias("orders"), rows(t.returns).alias("returns"), n(t.products, "product_id").alias("products"),
        n(t.vendors, "vendor_id").alias("vendors"), rows(common.sales(t)).alias("transactions"))


@query(
    "app_2_last_runs",
    """SELECT 'load ' || source_file AS notebook, count(*) AS records_processed, 'SUCCESS' AS status, max(load_timestamp) AS run_timestamp FROM b_orders GROUP BY 1
       ORDER BY run_timestamp DESC, notebook LIMIT 8""",
)
def last_runs(t):
    """Run log with one line per loaded order file."""
    per_file = t.bronze("orders").groupBy("source_file").agg(F.count(F.lit(1)).alias("records_processed"), F.max("load_timestamp").alias("run_timestamp"))
    path = work_dir(t.spark, "log")
    sinks.append(per_file.select(F.concat(F.lit("load "), "source_file").alias("notebook"), "run_timestamp", "records_processed", F.lit("SUCCESS").alias("status")), path)
    return sinks.last_runs(sinks.read_merged(t.spark, path))


@query(
    "app_3_dq_kpis",
    f"""SELECT count(DISTINCT entity) AS entities, CAST(sum(rejected_count) AS BIGINT) AS total_rejected, CAST(sum(CASE WHEN severity = 'CRITICAL' THEN rejected_count END) AS BIGINT) AS critical,
               CAST(sum(CASE WHEN severity = 'HIGH' THEN rejected_count END) AS BIGINT) AS high, count(CASE WHEN llm_check = 'PASS' THEN 1 END) AS passed FROM ({AUDIT}) a""",
)
def dq_kpis(t):
    severity, n = F.col("severity"), F.col("rejected_count")
    return dq.audit_report(_groups(t)).agg(
        F.count_distinct("entity").alias("entities"), F.sum(n).alias("total_rejected"), F.sum(F.when(severity == "CRITICAL", n)).alias("critical"),
        F.sum(F.when(severity == "HIGH", n)).alias("high"), F.count(F.when(F.col("llm_check") == "PASS", 1)).alias("passed"))


@query("app_3_rejected_per_entity", "SELECT entity, count(*) AS cnt FROM q_all GROUP BY 1")
def rejected_per_entity(t):
    return _groups(t).groupBy("entity").agg(F.sum("rejected_count").alias("cnt"))


@query(
    "app_3_top_issues",
    f"""SELECT entity, field_affected, issue_type, rejected_count, severity FROM ({AUDIT}) a
        ORDER BY CASE severity WHEN 'CRITICAL' THEN 1 WHEN 'HIGH' THEN 2 ELSE 3 END, rejected_count DESC, entity, field_affected LIMIT 30""",
)
def top_issues(t):
    report = dq.audit_report(_groups(t)).select("entity", "field_affected", "issue_type", "rejected_count", "severity")
    return dq.by_severity(report, "entity", "field_affected").limit(30)


@query(
    "app_4_slowest_products",
    "SELECT product_id, product_name, brand, region, total_quantity_sold, total_sales, days_since_last_sale, avg_daily_quantity FROM g_slow ORDER BY days_since_last_sale DESC, total_quantity_sold, product_id, region LIMIT 20",
)
def slowest_products(t):
    return common.slow(t).select("product_id", "product_name", "brand", "region", "total_quantity_sold", "total_sales", "days_since_last_sale", "avg_daily_quantity").orderBy(
        F.col("days_since_last_sale").desc(), "total_quantity_sold", "product_id", "region").limit(20)


@query(
    "app_5_lead_kpis",
    f"""SELECT count(*) AS total, count(CASE WHEN lead_label = 'HOT' THEN 1 END) AS hot, count(CASE WHEN lead_label = 'WARM' THEN 1 END) AS warm,
               count(CASE WHEN lead_label = 'COLD' THEN 1 END) AS cold, {div('sum(lead_score)', 'count(*)', 1)} AS avg FROM f_leads""",
)
def lead_kpis(t):
    return fraud.lead_kpis(leads(t))


@query(
    "app_5_warm_leads",
    "SELECT customer_id, total_spent, total_orders, lead_score, lead_label FROM f_leads WHERE lead_label = 'WARM' ORDER BY lead_score DESC, total_spent DESC, customer_id LIMIT 100",
)
def warm_leads(t):
    return leads(t).where("lead_label = 'WARM'").select("customer_id", "total_spent", "total_orders", "lead_score", "lead_label").orderBy(
        F.col("lead_score").desc(), F.col("total_spent").desc(), "customer_id").limit(100)


@query("app_6_top_region", "SELECT region, sum(sales) AS total_sales FROM g_sales GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1")
def top_region(t):
    return common.sales_by_region(t).groupBy("region").agg(F.sum("sales").alias("total_sales")).orderBy(F.col("total_sales").desc(), "region").limit(1)


@query("app_6_worst_vendor", "SELECT vendor_id, vendor_name, return_rate_pct FROM g_rates ORDER BY return_rate_pct DESC, vendor_id LIMIT 1")
def worst_vendor(t):
    return common.rates(t).select("vendor_id", "vendor_name", "return_rate_pct").orderBy(F.col("return_rate_pct").desc(), "vendor_id").limit(1)


@query("app_6_flagged_customers", "SELECT count(*) AS flagged FROM f_flagged")
def flagged_customers(t):
    return common.flagged(t).agg(F.count(F.lit(1)).alias("flagged"))


@query("app_6_slowest_ten", "SELECT product_id, region, days_since_last_sale FROM g_slow ORDER BY days_since_last_sale DESC, product_id, region LIMIT 10")
def slowest_ten(t):
    return common.slow(t).select("product_id", "region", "days_since_last_sale").orderBy(F.col("days_since_last_sale").desc(), "product_id", "region").limit(10)


@query("app_6_hot_leads_west", "SELECT count(*) AS hot_leads FROM f_leads l JOIN s_customers c ON l.customer_id = c.customer_id WHERE lead_label = 'HOT' AND c.region = 'West'")
def hot_leads_west(t):
    return leads(t).where("lead_label = 'HOT' AND region = 'West'").agg(F.count(F.lit(1)).alias("hot_leads"))


@query("app_6_refunds_by_reason", "SELECT return_reason, sum(refund_amount) AS total_refund FROM s_returns GROUP BY 1")
def refunds_by_reason(t):
    return t.returns.groupBy("return_reason").agg(F.sum("refund_amount").alias("total_refund"))


@query("app_6_best_segment", "SELECT segment, sum(profit) AS total_profit FROM g_sales GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1")
def best_segment(t):
    return common.sales_by_region(t).groupBy("segment").agg(F.sum("profit").alias("total_profit")).orderBy(F.col("total_profit").desc(), "segment").limit(1)


@query("app_6_top_scores", "SELECT customer_id, anomaly_score FROM f_scored ORDER BY anomaly_score DESC, customer_id LIMIT 5")
def top_scores(t):
    return common.scored(t).select("customer_id", "anomaly_score").orderBy(F.col("anomaly_score").desc(), F.col("customer_id").asc_nulls_last()).limit(5)
