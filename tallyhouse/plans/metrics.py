"""Queries over the metric views."""

from pyspark.sql import functions as F

from tallyhouse.operators import metrics as mv
from tallyhouse.plans import common
from tallyhouse.plans.check_views import div
from tallyhouse.plans.registry import query

REVENUE = ["total_revenue", "total_profit", "profit_margin_pct", "order_count", "units_sold", "avg_order_value"]
REVENUE_SQL = f"""sum(sales) AS total_revenue, sum(profit) AS total_profit, {div('sum(profit)', 'sum(sales)', 1, 100)} AS profit_margin_pct,
    count(DISTINCT order_id) AS order_count, CAST(sum(quantity) AS BIGINT) AS units_sold, {div('sum(sales)', 'count(DISTINCT order_id)', 2)} AS avg_order_value"""


@query("met_1_any_dimensions", f"SELECT segment, payment_type, {REVENUE_SQL} FROM g_sales WHERE payment_type <> 'voucher' GROUP BY 1, 2")
def any_dimensions(t):
    view = mv.revenue_view(common.sales(t), t.customers)
    return mv.metric_query(view, ["segment", "payment_type"], REVENUE, where=F.col("payment_type") != "voucher", order_by="total_revenue")


@query("met_1_unselected_filters", f"SELECT payment_type, {REVENUE_SQL} FROM g_sales WHERE quarter(day) IN (1, 2) AND region IS NOT NULL GROUP BY 1")
def unselected_filters(t):
    """Filters on two dimensions that the result doesn't show; one of them needs a join."""
    view = mv.revenue_view(common.sales(t), t.customers)
    return mv.metric_query(view, ["payment_type"], REVENUE, filters={"quarter": [1, 2], "region": lambda c: c.isNotNull()})


@query("met_2_revenue_by_region",f"SELECT region, {REVENUE_SQL} FROM g_sales GROUP BY 1")
def revenue_by_region(t):
    return mv.metric_query(mv.revenue_view(common.sales(t), t.customers), ["region"], REVENUE, order_by="total_revenue")


@query("met_2_revenue_by_month", f"SELECT CAST(year(day) AS INTEGER) AS year, CAST(quarter(day) AS INTEGER) AS quarter, monthname(day) AS month, {REVENUE_SQL} FROM g_sales GROUP BY 1, 2, 3")
def revenue_by_month(t):
    return mv.metric_query(mv.revenue_view(common.sales(t), t.customers), ["year", "quarter", "month"], REVENUE)


RETURNS = ["total_returns", "total_refund_amount", "avg_refund_amount", "return_rate_pct"]
RETURNS_SQL = f"""count(*) AS total_returns, sum(refund_amount) AS total_refund_amount, {div('sum(refund_amount)', 'count(refund_amount)', 2)} AS avg_refund_amount,
    {div('count(*)', 'count(DISTINCT order_id)', 1, 100)} AS return_rate_pct"""


@query("met_3_returns_by_vendor", f"SELECT vendor_name AS vendor, {RETURNS_SQL} FROM g_returns g LEFT JOIN s_vendors v ON g.vendor_id = v.vendor_id GROUP BY 1")
def returns_by_vendor(t):
    return mv.metric_query(mv.vendor_returns_view(common.returns(t), t.vendors), ["vendor"], RETURNS, order_by="return_rate_pct")


@query("met_3_returns_by_reason", f"SELECT return_reason, return_status, CAST(year(return_date) AS INTEGER) AS return_year, {RETURNS_SQL} FROM g_returns GROUP BY 1, 2, 3")
def returns_by_reason(t):
    return mv.metric_query(mv.vendor_returns_view(common.returns(t), t.vendors), ["return_reason", "return_status", "return_year"], RETURNS)


STOCK = ["slow_product_count", "avg_days_since_last_sale", "total_quantity_sold", "total_sales"]
STOCK_SQL = f"""count(CASE WHEN days_since_last_sale > 90 THEN 1 END) AS slow_product_count, {div('sum(days_since_last_sale)', 'count(days_since_last_sale)', 0)} AS avg_days_since_last_sale,
    CAST(sum(total_quantity_sold) AS BIGINT) AS total_quantity_sold, sum(total_sales) AS total_sales"""


@query("met_4_inventory_by_region", f"SELECT region, {STOCK_SQL} FROM g_slow GROUP BY 1")
def inventory_by_region(t):
    return mv.metric_query(mv.inventory_view(common.slow(t), t.products), ["region"], STOCK, order_by="slow_product_count")


@query(
    "met_4_inventory_by_product_group",
    f"""SELECT g.brand, p.categories AS category, CASE WHEN days_since_last_sale > 90 THEN 'Yes' ELSE 'No' END AS slow_moving_flag, {STOCK_SQL}
        FROM g_slow g LEFT JOIN s_products p ON g.product_id = p.product_id GROUP BY 1, 2, 3""",
)
def inventory_by_product_group(t):
    return mv.metric_query(mv.inventory_view(common.slow(t), t.products), ["brand", "category", "slow_moving_flag"], STOCK)
