"""Queries for unit economics."""

from pyspark.sql import functions as F

from tallyhouse.operators import pricing as pr, star
from tallyhouse.plans import common
from tallyhouse.plans.check_views import div, measures
from tallyhouse.plans.registry import query

SOURCES = ("transactions_1", "transactions_2", "transactions_3")
RAW_DISCOUNT = "TRY_CAST(regexp_replace(discount, '[^0-9.]', '', 'g') AS DECIMAL(10,3))"


def _raw_discounts(t):
    """Harmonised lines whose discount is still on the scale of its source."""
    raw = t.bronze("transactions").select(
        F.col("product_id"), F.col("source_file").alias("_source_file"), F.regexp_replace("sales", r"^\$", "").try_cast("decimal(10,3)").alias("sales"),
        F.regexp_replace("discount", "[^0-9.]", "").try_cast("decimal(10,3)").alias("discount"))
    return raw


_RAW = f"SELECT product_id, source_file, TRY_CAST(regexp_replace(sales, '^\\$', '') AS DECIMAL(10,3)) AS sales, {RAW_DISCOUNT} AS d FROM b_transactions"


@query(
    "prc_1_discount_scale_by_source",
    f"""SELECT regexp_extract(source_file, 'transactions_[0-9]') AS source_file, count(*) AS txns, min(d) AS min_discount, max(d) AS max_discount,
               count(CASE WHEN d > 0 AND d < 1 THEN 1 END) AS decimal_scale, count(CASE WHEN d >= 1 THEN 1 END) AS whole_number_scale, count(CASE WHEN d = 0 THEN 1 END) AS zero_discount
        FROM ({_RAW}) r WHERE sales IS NOT NULL GROUP BY 1""",
)
def discount_scale_by_source(t):
    return pr.discount_scale_by_source(_raw_discounts(t), SOURCES)


@query(
    "prc_2_products_by_discount_pattern",
    f"""SELECT CASE WHEN f AND w THEN 'both scales' WHEN f THEN 'fractions only' WHEN w THEN 'whole numbers only' ELSE 'no discount' END AS discount_pattern, count(*) AS products
        FROM (SELECT product_id, coalesce(bool_or(d > 0 AND d < 1), false) AS f, coalesce(bool_or(d >= 1), false) AS w FROM ({_RAW}) r WHERE sales IS NOT NULL GROUP BY 1) p GROUP BY 1""",
)
def products_by_discount_pattern(t):
    return pr.products_by_discount_pattern(_raw_discounts(t))


@query(
    "prc_3_list_price_spread",
    f"""SELECT CASE WHEN pct <= 1 THEN 'A: 0-1%' WHEN pct <= 5 THEN 'B: 1-5%' ELSE 'C: 5%+' END AS after_normalization, count(*) AS products
        FROM (SELECT product_id, {div('max(lp) - min(lp)', 'max(lp)', 1, 100)} AS pct FROM p_lines WHERE nd < 1 GROUP BY 1 HAVING count(*) > 1) p GROUP BY 1""",
)
def list_price_spread(t):
    return pr.list_price_spread(t.lines)


DRILLED = 42


@query(
    "prc_4_product_drilldown",
    f"""SELECT order_id, sales, quantity, discount, nd AS norm_discount, round(unit_sales, 4) AS raw_unit_price, round(lp, 4) AS derived_list_price, profit,
               regexp_extract(_source_file, 'transactions_[0-9]') AS source FROM p_lines WHERE product_id = {DRILLED}""",
)
def product_drilldown(t):
    """The drill-down into one product is the feature itself."""
    return pr.product_drilldown(t.lines, DRILLED)


PRODUCT_SQL = f"""SELECT product_id, product_name, brand, top_category, {measures('min_list_price', 'max_list_price', 'avg_discount_pct', 'max_discount_pct', 'total_revenue', 'total_profit', 'avg_unit_profit', 'margin_pct')},
    count(*) AS total_txns, CAST(sum(quantity) AS BIGINT) AS total_units_sold, {div('sum(unit_sales)', 'count(unit_sales)', 2)} AS avg_realized_unit_price,
    round(CAST((quantile_disc(lp, 0.5) + list_extract(list_sort(list(lp)), CAST(count(*) // 2 + 1 AS BIGINT))) / 2 AS DECIMAL(38,9)), 2) AS median_list_price,
    CASE WHEN (CAST(max(lp) AS DOUBLE) - CAST(min(lp) AS DOUBLE)) / CAST(max(lp) AS DOUBLE) > CAST(0.05 AS DOUBLE) THEN 'MULTI-PRICE' ELSE 'STABLE' END AS price_flag
    FROM p_lines WHERE product_name IS NOT NULL GROUP BY 1, 2, 3, 4"""


@query("prc_5_product_economics", PRODUCT_SQL)
def product_economics(t):
    return pr.product_economics(t.lines, t.products)


@query("prc_5_top_products", f"{PRODUCT_SQL} ORDER BY total_revenue DESC, product_id LIMIT 50")
def top_products(t):
    return pr.top_products(pr.product_economics(t.lines, t.products))


FULL_SQL = measures(*pr.FULL)


@query("prc_6_by_vendor", f"SELECT vendor_id, vendor_name, {FULL_SQL} FROM p_lines WHERE vendor_name IS NOT NULL GROUP BY 1, 2")
def by_vendor(t):
    return pr.by_vendor(t.lines.join(t.orders.select("order_id"), "order_id", "left_semi"), t.vendors)


@query("prc_7_by_region", f"SELECT region, {FULL_SQL} FROM p_lines WHERE region IS NOT NULL GROUP BY 1")
def by_region(t):
    return pr.by_region(common.sales(t), t.customers)


@query("prc_8_by_category", f"SELECT top_category, count(DISTINCT product_id) AS products, {measures(*pr.FULL[:-1])} FROM p_lines WHERE top_category IS NOT NULL GROUP BY 1 HAVING count(*) >= 10")
def by_category(t):
    return pr.by_category(t.lines, t.products)


@query(
    "prc_9_by_vendor_and_region",
    f"SELECT vendor_name, region, {measures('txns', 'avg_unit_price', 'avg_discount_pct', 'total_revenue', 'margin_pct')} FROM p_lines WHERE vendor_name IS NOT NULL AND region IS NOT NULL GROUP BY 1, 2",
)
def by_vendor_and_region(t):
    return pr.by_vendor_and_region(common.sales(t), t.vendors, t.customers)


@query(
    "prc_10_loss_makers",
    f"""SELECT product_id, product_name, brand, top_category, {measures('txns', 'total_revenue', 'total_profit', 'margin_pct', 'avg_discount_pct')}
        FROM p_lines WHERE profit IS NOT NULL AND product_name IS NOT NULL GROUP BY 1, 2, 3, 4 HAVING sum(profit) < 0 ORDER BY total_profit, product_id LIMIT 25""",
)
def loss_makers(t):
    return pr.loss_makers(t.lines, t.products)


@query(
    "prc_11_multi_price_products",
    f"""SELECT product_id, product_name, count(*) AS txns, round(min(lp), 2) AS price_point_1, round(max(lp), 2) AS price_point_2, {div('max(lp)', 'min(lp)', 1)} AS price_ratio
        FROM p_lines WHERE lp IS NOT NULL AND product_name IS NOT NULL GROUP BY 1, 2
        HAVING (CAST(max(lp) AS DOUBLE) - CAST(min(lp) AS DOUBLE)) / CAST(max(lp) AS DOUBLE) > CAST(0.05 AS DOUBLE)""",
)
def multi_price_products(t):
    return pr.multi_price_products(t.lines, t.products)


@query(
    "prc_12_discount_bands",
    f"""SELECT CASE WHEN nd = 0 THEN '0% (no discount)' WHEN nd <= 0.1 THEN '1-10%' WHEN nd <= 0.2 THEN '10-20%' WHEN nd <= 0.5 THEN '20-50%' ELSE '50%+' END AS discount_band,
               {measures('txns', 'total_revenue', 'total_profit', 'margin_pct', 'avg_unit_profit')} FROM p_lines WHERE profit IS NOT NULL GROUP BY 1""",
)
def discount_bands(t):
    return pr.discount_bands(t.lines)
