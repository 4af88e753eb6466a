"""Queries that reconcile layers and check integrity."""

from pyspark.sql import functions as F

from tallyhouse.config import ENTITIES
from tallyhouse.operators import checks as ck, mdm, quality as dq, star
from tallyhouse.plans import common
from tallyhouse.plans.check_views import div
from tallyhouse.plans.quality import DISCOVERY_SQL
from tallyhouse.plans.registry import query


def every(pattern: str, entities=ENTITIES) -> str:
    return " UNION ALL ".join(pattern.format(e=e) for e in entities)


EXPECTED = {"vendors": 100, "customers": 3000}


@query(
    "chk_1_row_counts",
    "SELECT entity, row_count, CAST(expected AS BIGINT) AS expected, CASE WHEN expected IS NULL THEN NULL WHEN row_count = expected THEN 'OK' ELSE 'DIFFERENT' END AS status FROM ("
    + every("SELECT '{e}' AS entity, count(*) AS row_count, CASE '{e}' WHEN 'vendors' THEN 100 WHEN 'customers' THEN 3000 END AS expected FROM b_{e}") + ") t",
)
def row_counts(t):
    counted = ck.row_counts({e: t.bronze(e) for e in ENTITIES}, EXPECTED)
    return counted.withColumn("status", F.when(F.col("expected").isNotNull(), F.col("status")))


@query(
    "chk_2_all_null_keys",
    """SELECT 'customers' AS entity, 'customer_id variants' AS check_col,
              count(CASE WHEN customer_id IS NULL AND customerid IS NULL AND cust_id IS NULL AND customer_identifier IS NULL THEN 1 END) AS all_id_null, count(*) AS total FROM b_customers
       UNION ALL SELECT 'orders', 'order_id', count(CASE WHEN order_id IS NULL THEN 1 END), count(*) FROM b_orders
       UNION ALL SELECT 'transactions', 'order_id', count(CASE WHEN order_id IS NULL THEN 1 END), count(*) FROM b_transactions
       UNION ALL SELECT 'returns', 'order_id variants', count(CASE WHEN order_id IS NULL AND orderid IS NULL THEN 1 END), count(*) FROM b_returns""",
)
def all_null_keys(t):
    return ck.all_null_keys({
        "customers": (t.bronze("customers"), ["customer_id", "customerid", "cust_id", "customer_identifier"]),
        "orders": (t.bronze("orders"), ["order_id"]),
        "transactions": (t.bronze("transactions"), ["order_id"]),
        "returns": (t.bronze("returns"), ["order_id", "orderid"]),
    })


@query("chk_4_layer_counts", every("SELECT '{e}' AS entity, (SELECT count(*) FROM b_{e}) AS bronze_rows, (SELECT count(*) FROM c_{e}) AS silver_rows, (SELECT count(*) FROM q_{e}) AS quarantine_rows"))
def layer_counts(t):
    return ck.layer_counts({
        "bronze": {e: t.bronze(e) for e in ENTITIES}, "silver": {e: common.clean(t, e) for e in ENTITIES}, "quarantine": {e: common.rejected(t, e) for e in ENTITIES}})


@query(
    "chk_5_dedupe_flow",
    """SELECT 'silver rows' AS metric, count(*) AS value FROM c_customers UNION ALL SELECT 'silver distinct keys', count(DISTINCT customer_id) FROM c_customers
       UNION ALL SELECT 'golden records', count(*) FROM m_customers UNION ALL SELECT 'keys with orders', count(DISTINCT customer_id) FROM c_orders
       UNION ALL SELECT 'order keys found in golden', count(DISTINCT o.customer_id) FROM c_orders o JOIN m_customers m ON o.customer_id = m.customer_id""",
)
def dedupe_flow(t):
    silver = common.clean(t, "customers")
    return ck.dedupe_flow(silver, mdm.golden_customers(silver), common.clean(t, "orders"))


@query(
    "chk_6_active_customers",
    "SELECT region, count(*) AS customers, sum(CASE WHEN customer_id IN (SELECT customer_id FROM s_orders) THEN 1 ELSE 0 END)::BIGINT AS customers_with_orders FROM s_customers GROUP BY 1",
)
def active_customers(t):
    return ck.active_by_region(t.customers, t.orders)


@query(
    "chk_7_orders_without_lines",
    "SELECT o.order_status, count(*) AS orders_without_transactions FROM s_orders o LEFT JOIN s_lines l ON o.order_id = l.order_id WHERE l.order_id IS NULL GROUP BY 1",
)
def orders_without_lines(t):
    return ck.orders_without_lines(t.orders, t.lines)


@query(
    "chk_8_orphans",
    """SELECT 'lines without order' AS fk_check, count(*) AS orphan_count FROM s_lines l WHERE NOT EXISTS (SELECT 1 FROM s_orders o WHERE o.order_id = l.order_id)
       UNION ALL SELECT 'lines without product', count(*) FROM s_lines l WHERE NOT EXISTS (SELECT 1 FROM s_products p WHERE p.product_id = l.product_id)
       UNION ALL SELECT 'orders without customer', count(*) FROM s_orders o WHERE NOT EXISTS (SELECT 1 FROM s_customers c WHERE c.customer_id = o.customer_id)
       UNION ALL SELECT 'returns without order', count(*) FROM s_returns r WHERE NOT EXISTS (SELECT 1 FROM s_orders o WHERE o.order_id = r.order_id)""",
)
def orphans(t):
    return ck.orphans({
        "lines without order": (t.lines, t.orders, "order_id"), "lines without product": (t.lines, t.products, "product_id"),
        "orders without customer": (t.orders, t.customers, "customer_id"), "returns without order": (t.returns, t.orders, "order_id")})


@query(
    "chk_9_sales_totals",
    """SELECT 'silver lines' AS source, count(*) AS row_count, sum(sales) AS total_sales, sum(profit) AS total_profit, CAST(sum(quantity) AS BIGINT) AS total_qty,
              0 AS row_count_diff, 0.0 AS total_sales_diff, 0.0 AS total_profit_diff, 0 AS total_qty_diff FROM s_lines
       UNION ALL SELECT 'gold sales', count(*), sum(sales), sum(profit), CAST(sum(quantity) AS BIGINT), count(*) - (SELECT count(*) FROM s_lines), sum(sales) - (SELECT sum(sales) FROM s_lines),
              sum(profit) - (SELECT sum(profit) FROM s_lines), CAST(sum(quantity) - (SELECT sum(quantity) FROM s_lines) AS BIGINT) FROM g_sales""",
)
def sales_totals(t):
    aggs = {"row_count": F.count(F.lit(1)), "total_sales": F.sum("sales"), "total_profit": F.sum("profit"), "total_qty": F.sum("quantity")}
    return ck.compare_totals({"silver lines": t.lines, "gold sales": common.full_sales(t)}, aggs)


@query(
    "chk_9_order_totals",
    """SELECT 'silver orders' AS source, count(*) AS row_count, count(DISTINCT order_id) AS distinct_orders, count(DISTINCT customer_id) AS distinct_customers FROM s_orders
       UNION ALL SELECT 'gold orders', count(*), count(DISTINCT order_id), count(DISTINCT customer_id) FROM s_orders""",
)
def order_totals(t):
    aggs = {"row_count": F.count(F.lit(1)), "distinct_orders": F.count_distinct("order_id"), "distinct_customers": F.count_distinct("customer_id")}
    return ck.totals({"silver orders": t.orders, "gold orders": star.fact_orders(t.orders)}, aggs)


@query(
    "chk_9_refund_totals",
    """SELECT 'silver returns' AS source, count(*) AS row_count, sum(refund_amount) AS total_refunds, count(DISTINCT order_id) AS distinct_orders FROM s_returns
       UNION ALL SELECT 'gold returns', count(*), sum(refund_amount), count(DISTINCT order_id) FROM g_returns""",
)
def refund_totals(t):
    aggs = {"row_count": F.count(F.lit(1)), "total_refunds": F.sum("refund_amount"), "distinct_orders": F.count_distinct("order_id")}
    return ck.totals({"silver returns": t.returns, "gold returns": common.returns(t)}, aggs)


KEYS = ["customer_key", "product_key", "vendor_key", "order_date_key", "region", "segment"]


@query("chk_10_null_keys", "SELECT count(*) AS total_rows, " + ", ".join(f"count(CASE WHEN {k} IS NULL THEN 1 END) AS null_{k}" for k in KEYS) + " FROM g_sales")
def null_keys(t):
    return ck.null_keys(common.full_sales(t), KEYS)


@query(
    "chk_11_key_gaps",
    """SELECT 'in_orders_not_lines' AS gap, count(*) AS cnt FROM s_orders o WHERE NOT EXISTS (SELECT 1 FROM s_lines l WHERE l.order_id = o.order_id)
       UNION ALL SELECT 'in_lines_not_orders', count(*) FROM s_lines l WHERE NOT EXISTS (SELECT 1 FROM s_orders o WHERE l.order_id = o.order_id)""",
)
def key_gaps(t):
    return ck.key_gaps(t.orders, t.lines, "order_id", "orders", "lines")


@query(
    "chk_12_customers_missing",
    """SELECT 'orders_customer_not_in_dim' AS check_name, count(DISTINCT o.customer_id) AS cnt FROM s_orders o LEFT JOIN s_customers c ON o.customer_id = c.customer_id WHERE c.customer_id IS NULL
       UNION ALL SELECT 'fact_sales_customer_not_in_dim', count(DISTINCT customer_id) FROM g_sales WHERE customer_key IS NULL AND customer_id IS NOT NULL""",
)
def customers_missing(t):
    return ck.customers_missing(t.orders, common.full_sales(t), t.customers)


@query(
    "chk_13_mart_against_lines",
    """SELECT 'mart' AS src, region, sum(total_sales) AS sales, sum(total_profit) AS profit, CAST(sum(order_count) AS BIGINT) AS orders FROM g_revenue GROUP BY 2
       UNION ALL SELECT 'direct', region, sum(sales), round(sum(profit), 2), count(DISTINCT order_id) FROM g_sales GROUP BY 2""",
)
def mart_against_lines(t):
    return ck.mart_against_lines(common.revenue(t), common.sales_by_region(t))


@query("chk_13_null_region_leak", "SELECT coalesce(region, '** NULL **') AS region, count(*) AS row_count, sum(sales) AS sales, round(sum(profit), 2) AS profit FROM g_sales GROUP BY 1")
def null_region_leak(t):
    return ck.null_region_leak(common.sales_by_region(t))


@query(
    "chk_13_grand_totals",
    """SELECT 'fact sales' AS source, sum(sales) AS total_sales, round(sum(profit), 2) AS total_profit FROM g_sales
       UNION ALL SELECT 'revenue mart', sum(total_sales), sum(total_profit) FROM g_revenue""",
)
def grand_totals(t):
    mart = common.revenue(t).select(F.col("total_sales").alias("sales"), F.col("total_profit").alias("profit"))
    return ck.totals({"fact sales": common.sales(t).select("sales", "profit"), "revenue mart": mart}, {"total_sales": F.sum("sales"), "total_profit": F.round(F.sum("profit"), 2)})


@query(
    "chk_14_rate_check",
    f"""SELECT vendor_id, vendor_name, total_orders_sold, total_returns, return_rate_pct, {div('total_returns', 'total_orders_sold', 2, 100)} AS computed_rate_pct, 'OK' AS check_result,
               total_sales, total_refund_amount FROM g_rates""",
)
def rate_check(t):
    return ck.rate_check(common.rates(t))


@query(
    "chk_15_refunds_over_tables",
    """SELECT 'fact returns' AS source, count(*) AS row_count, sum(refund_amount) AS total_refunds FROM g_returns
       UNION ALL SELECT 'vendor mart', CAST(sum(total_returns) AS BIGINT), sum(total_refund_amount) FROM g_rates
       UNION ALL SELECT 'customer mart', CAST(sum(total_returns) AS BIGINT), sum(total_refund_amount) FROM g_history""",
)
def refunds_over_tables(t):
    facts = common.returns(t).select(F.lit(1).cast("bigint").alias("n"), F.col("refund_amount").alias("refund"))
    mart = lambda d: d.select(F.col("total_returns").alias("n"), F.col("total_refund_amount").alias("refund"))
    return ck.totals({"fact returns": facts, "vendor mart": mart(common.rates(t)), "customer mart": mart(common.history(t))},
                     {"row_count": F.sum("n"), "total_refunds": F.sum("refund")})


@query(
    "chk_16_ratio_buckets",
    f"""SELECT CASE WHEN return_to_sales_ratio IS NULL THEN 'no sale' WHEN return_to_sales_ratio <= 1.5 THEN 'up to 1.5' WHEN return_to_sales_ratio <= 5 THEN 'over 1.5'
                    WHEN return_to_sales_ratio <= 20 THEN 'over 5' ELSE 'over 20' END AS ratio_bucket, count(*) AS returns_count,
               {div('sum(return_to_sales_ratio)', 'count(return_to_sales_ratio)', 2)} AS avg_ratio, min(refund_amount) AS min_refund, max(refund_amount) AS max_refund,
               min(original_sales) AS min_matched_sale, max(original_sales) AS max_matched_sale FROM g_returns GROUP BY 1""",
)
def ratio_buckets(t):
    return ck.ratio_buckets(common.returns(t))


@query(
    "chk_16_worst_matches",
    """SELECT return_to_sales_ratio, refund_amount, original_sales, product_id, order_id FROM g_returns WHERE return_to_sales_ratio IS NOT NULL
       ORDER BY return_to_sales_ratio DESC, refund_amount DESC, order_id, product_id LIMIT 15""",
)
def worst_matches(t):
    return ck.worst_matches(common.returns(t))


@query(
    "chk_17_band_audit",
    """SELECT fraud_risk_score, count(*) AS customers, min(total_returns) AS min_returns, max(total_returns) AS max_returns, min(avg_return_to_sales_ratio) AS min_ratio,
              max(avg_return_to_sales_ratio) AS max_ratio, min(max_single_refund) AS min_max_refund, max(max_single_refund) AS max_max_refund, sum(total_refund_amount) AS total_refunds
       FROM g_history GROUP BY 1""",
)
def band_audit(t):
    return ck.band_audit(common.history(t))


@query(
    "chk_18_region_coverage",
    """SELECT c.region, count(DISTINCT c.customer_id) AS total_customers, count(DISTINCT o.order_id) AS total_orders, coalesce(sum(l.sales), 0) AS total_sales
       FROM s_customers c LEFT JOIN s_orders o ON c.customer_id = o.customer_id LEFT JOIN s_lines l ON o.order_id = l.order_id GROUP BY 1""",
)
def region_coverage(t):
    return ck.region_coverage(t.customers, t.orders, t.lines)


@query(
    "chk_19_calendar_coverage",
    """SELECT min(full_date) AS calendar_start, max(full_date) AS calendar_end, count(*) AS calendar_days, (SELECT min(CAST(order_purchase_timestamp AS DATE)) FROM s_orders) AS earliest_order,
              (SELECT max(CAST(order_purchase_timestamp AS DATE)) FROM s_orders) AS latest_order FROM g_dates""",
)
def calendar_coverage(t):
    return ck.calendar_coverage(star.dim_dates(t.orders, t.returns), t.orders)


@query(
    "chk_20_distinct_products",
    """SELECT 'dim products' AS source, count(DISTINCT product_id) AS distinct_products FROM s_products UNION ALL SELECT 'fact sales', count(DISTINCT product_id) FROM g_sales
       UNION ALL SELECT 'slow movers', count(DISTINCT product_id) FROM g_slow""",
)
def distinct_products(t):
    return ck.distinct_products({"dim products": t.products, "fact sales": common.sales(t), "slow movers": common.slow(t)})


def _findings(t):
    return dq.discover_issues({e: t.bronze(e) for e in ENTITIES})


@query("chk_21_findings", f"SELECT entity, severity, issue_type, count(*) AS findings FROM ({DISCOVERY_SQL}) d GROUP BY 1, 2, 3")
def findings(t):
    return ck.findings_by_severity(_findings(t))


@query(
    "chk_22_returns_without_sale",
    """SELECT count(*) AS total_returns, count(CASE WHEN original_sales IS NULL THEN 1 END) AS returns_without_transactions,
              sum(CASE WHEN original_sales IS NULL THEN refund_amount ELSE 0 END) AS lost_comparison_value FROM g_returns""",
)
def returns_without_sale(t):
    return ck.returns_without_sale(common.returns(t))


@query(
    "chk_22_orders_of_unmatched_returns",
    "SELECT count(*) AS orders_count FROM s_orders WHERE order_id IN (SELECT r.order_id FROM s_returns r LEFT JOIN s_lines l ON r.order_id = l.order_id WHERE l.order_id IS NULL)",
)
def orders_of_unmatched_returns(t):
    return ck.orders_of_unmatched_returns(t.orders, t.returns, t.lines)


@query("chk_22_null_date_keys", "SELECT count(*) AS total_rows, count(CASE WHEN return_date_key IS NULL THEN 1 END) AS null_return_date_key FROM g_returns")
def null_date_keys(t):
    return ck.null_keys(common.full_returns(t), ["return_date_key"])
