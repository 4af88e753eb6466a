"""Queries over the marts."""

from tallyhouse.operators import marts
from tallyhouse.plans import common
from tallyhouse.plans.check_views import div
from tallyhouse.plans.registry import query


@query("mrt_1_revenue_by_region", "SELECT * FROM g_revenue")
def revenue_by_region(t):
    return common.revenue(t)


@query("mrt_2_return_rate_by_vendor", "SELECT * FROM g_rates")
def return_rate_by_vendor(t):
    return common.rates(t)


@query("mrt_3_slow_moving_products", "SELECT * FROM g_slow")
def slow_moving_products(t):
    return common.slow(t)


@query("mrt_4_customer_return_history", "SELECT * FROM g_history")
def customer_return_history(t):
    return common.history(t)


@query(
    "mrt_5_product_price_history",
    f"""SELECT product_id, vendor_id, base_unit_price, valid_from, valid_to, is_current, version_rank,
               {div('total', 'n', 2)} AS avg_price_to_date, min_price_to_date, max_price_to_date FROM p_history""",
)
def product_price_history(t):
    return marts.price_history(t.lines, t.orders)


@query(
    "mrt_6_price_as_of",
    """SELECT l.order_id, l.product_id, l.vendor_id, l.sales, l.order_purchase_timestamp, h.base_unit_price AS list_price, h.valid_from AS price_valid_from, h.valid_to AS price_valid_to,
              h.version_rank AS price_version
       FROM (SELECT s.*, o.order_purchase_timestamp FROM s_lines s JOIN s_orders o USING (order_id)) l
       ASOF LEFT JOIN (SELECT * FROM p_history QUALIFY row_number() OVER (PARTITION BY product_id, vendor_id, valid_from ORDER BY version_rank DESC) = 1) h
       ON l.product_id = h.product_id AND l.vendor_id = h.vendor_id AND l.order_purchase_timestamp >= h.valid_from""",
)
def price_as_of(t):
    """Every line with the list price that was valid when it was ordered."""
    lookups = t.lines.join(t.orders.select("order_id", "order_purchase_timestamp"), "order_id").select("order_id", "product_id", "vendor_id", "sales", "order_purchase_timestamp")
    return marts.price_as_of(lookups, marts.price_history(t.lines, t.orders))
