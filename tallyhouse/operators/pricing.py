"""Unit economics: list prices, discounts and margins.

``discount`` may be a fraction or a whole percentage; 1 and above counts as a percentage.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyhouse.functions.numbers import count_if, ratio, unit_price


def net_discount(discount: Column) -> Column:
    """Discount as a fraction of the list price."""
    return F.when(discount >= 1, discount / F.lit(100)).otherwise(discount).cast("decimal(10,4)")


def list_price(sales: Column, quantity: Column, nd: Column) -> Column:
    """Price before discount; NULL for a full discount or no units."""
    units = quantity.cast("decimal(10,0)") * (F.lit(1) - nd)
    return F.when((nd < 1) & (quantity > 0), sales / F.nullif(units, F.lit(0).cast("decimal(1,0)"))).cast("decimal(18,8)")


def priced_lines(lines: DataFrame) -> DataFrame:
    """Sold lines with ``nd`` (net discount), ``lp`` (list price), unit price and unit profit."""
    return (
        lines.where("sales IS NOT NULL AND quantity > 0")
        .withColumn("nd", net_discount(F.col("discount")))
        .withColumns({
            "lp": list_price(F.col("sales"), F.col("quantity"), F.col("nd")),
            "unit_sales": unit_price(F.col("sales"), F.col("quantity")),
            "unit_profit": unit_price(F.col("profit"), F.col("quantity")),
        })
    )


def _avg(c: str, digits: int, scale: int = 1) -> Column:
    return ratio(F.sum(c), F.count(c), digits, scale)


MEASURES = {
    "txns": lambda: F.count(F.lit(1)),
    "total_units": lambda: F.sum("quantity"),
    "avg_unit_price": lambda: _avg("unit_sales", 2),
    "avg_discount_pct": lambda: _avg("nd", 1, 100),
    "max_discount_pct": lambda: F.round(F.max("nd") * 100, 1),
    "total_revenue": lambda: F.round(F.sum("sales"), 2),
    "total_profit": lambda: F.round(F.sum("profit"), 2),
    "margin_pct": lambda: ratio(F.sum("profit"), F.sum("sales"), 1, 100),
    "avg_unit_profit": lambda: _avg("unit_profit", 2),
    "min_list_price": lambda: F.round(F.min("lp"), 2),
    "max_list_price": lambda: F.round(F.max("lp"), 2),
}


def economics(lines: DataFrame, keys: list[str], measures: list[str]) -> DataFrame:
    return lines.groupBy(*keys).agg(*[MEASURES[m]().alias(m) for m in measures])


def spread(lo: Column, hi: Column) -> Column:
    return F.try_divide(hi.cast("double") - lo.cast("double"), hi.cast("double"))


# --- discount scale ---------------------------------------------------------------------------


def discount_scale_by_source(lines: DataFrame, sources: tuple[str, ...]) -> DataFrame:
    file = None
    for s in sources:
        hit = F.col("_source_file").contains(s)
        file = F.when(hit, s) if file is None else file.when(hit, s)
    d = F.col("discount")
    return lines.where("sales IS NOT NULL").groupBy(file.otherwise("unknown").alias("source_file")).agg(
        F.count(F.lit(1)).alias("txns"), F.round(F.min(d), 3).alias("min_discount"), F.round(F.max(d), 3).alias("max_discount"),
        count_if((d > 0) & (d < 1)).alias("decimal_scale"), count_if(d >= 1).alias("whole_number_scale"), count_if(d == 0).alias("zero_discount"))


def products_by_discount_pattern(lines: DataFrame) -> DataFrame:
    d = F.col("discount")
    per = lines.where("sales IS NOT NULL").groupBy("product_id").agg(
        F.coalesce(F.bool_or((d > 0) & (d < 1)), F.lit(False)).alias("fraction"), F.coalesce(F.bool_or(d >= 1), F.lit(False)).alias("whole"))
    pattern = (
        F.when(F.col("fraction") & F.col("whole"), "both scales").when(F.col("fraction"), "fractions only")
        .when(F.col("whole"), "whole numbers only").otherwise("no discount")
    )
    return per.groupBy(pattern.alias("discount_pattern")).agg(F.count(F.lit(1)).alias("products"))


def list_price_spread(lines: DataFrame) -> DataFrame:
    """Products by the spread of their list price, for products sold more than once."""
    per = priced_lines(lines).where("nd < 1").groupBy("product_id").agg(
        F.count(F.lit(1)).alias("n"), F.min("lp").alias("lo"), F.max("lp").alias("hi")).where("n > 1")
    pct = F.round(spread(F.col("lo"), F.col("hi")) * 100, 1)
    bucket = F.when(pct <= 1, "A: 0-1%").when(pct <= 5, "B: 1-5%").otherwise("C: 5%+")
    return per.groupBy(bucket.alias("after_normalization")).agg(F.count(F.lit(1)).alias("products"))


def product_drilldown(lines: DataFrame, product_id) -> DataFrame:
    """Every sale of one product with its derived list price."""
    return priced_lines(lines).where(F.col("product_id") == F.lit(product_id)).select(
        "order_id", "sales", "quantity", "discount", F.col("nd").alias("norm_discount"),
        F.round("unit_sales", 4).alias("raw_unit_price"), F.round("lp", 4).alias("derived_list_price"), "profit",
        F.regexp_extract("_source_file", r"(transactions_\d)", 1).alias("source"),
    ).orderBy(F.col("derived_list_price").desc(), F.col("sales").desc(), "order_id")


# --- economics by product, vendor, region and category -----------------------------------------


def top_category(categories: Column) -> Column:
    return F.get(F.split(categories, ","), F.lit(0))


def median_list_price(lines: DataFrame) -> DataFrame:
    """Exact median list price per product without holding the prices of a product.

    A histogram by product and whole price says in which bar the middle lies. Only prices of these bars are counted by
    value and put in order, bar by bar; all others are counted once and never moved again.
    """
    priced = lines.where("lp IS NOT NULL").select("product_id", "lp", F.floor(F.col("lp")).cast("bigint").alias("bar"))
    bars = priced.groupBy("product_id", "bar").agg(F.count(F.lit(1)).alias("bn"))
    below = Window.partitionBy("product_id").orderBy("bar").rowsBetween(Window.unboundedPreceding, -1)
    edges = bars.select("product_id", "bar", "bn", F.coalesce(F.sum("bn").over(below), F.lit(0)).alias("before"), F.sum("bn").over(Window.partitionBy("product_id")).alias("total"))
    # positions (1-based) of the two middle values
    lo, hi = F.floor((F.col("total") + 1) / 2), F.floor(F.col("total") / 2) + 1
    middle = edges.where((F.col("before") < hi) & (F.col("before") + F.col("bn") >= lo)).select("product_id", "bar", "before", "total")
    counted = priced.join(middle, ["product_id", "bar"]).groupBy("product_id", "bar", "before", "total", "lp").agg(F.count(F.lit(1)).alias("n"))
    inner = Window.partitionBy("product_id", "bar").orderBy("lp").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = counted.withColumn("upto", F.col("before") + F.sum("n").over(inner))
    hit = lambda p: (F.col("upto") - F.col("n") < p) & (F.col("upto") >= p)
    return placed.groupBy("product_id").agg(
        F.round((F.max(F.when(hit(lo), F.col("lp"))) + F.max(F.when(hit(hi), F.col("lp")))) / 2, 2).alias("median_list_price"))


def product_economics(lines: DataFrame, products: DataFrame) -> DataFrame:
    """List price, discount, margin and volume per product.

    Medians are computed on their own from counted prices, so no product's prices are held in memory.
    """
    priced = priced_lines(lines)
    wanted = [
        "txns", "total_units", "min_list_price", "max_list_price", "avg_unit_price", "avg_discount_pct", "max_discount_pct",
        "total_revenue", "total_profit", "avg_unit_profit", "margin_pct"]
    measures = [F.min("lp").alias("lo"), F.max("lp").alias("hi"), *[MEASURES[m]().alias(m) for m in wanted]]
    per = priced.groupBy("product_id").agg(*measures).join(median_list_price(priced), "product_id", "left")
    named = products.select("product_id", "product_name", "brand", top_category(F.col("categories")).alias("top_category"))
    return (
        per.join(named, "product_id")
        .withColumnsRenamed({"txns": "total_txns", "total_units": "total_units_sold", "avg_unit_price": "avg_realized_unit_price"})
        .withColumn("price_flag", F.when(spread(F.col("lo"), F.col("hi")) > 0.05, "MULTI-PRICE").otherwise("STABLE"))
        .drop("lo", "hi")
    )


def top_products(economics_by_product: DataFrame, k: int = 50) -> DataFrame:
    return economics_by_product.orderBy(F.col("total_revenue").desc(), "product_id").limit(k)


FULL = ["txns", "total_units", "avg_unit_price", "avg_discount_pct", "total_revenue", "total_profit", "margin_pct", "avg_unit_profit"]


def by_vendor(sales: DataFrame, vendors: DataFrame) -> DataFrame:
    """``sales``: lines with ``vendor_id``. Names are joined to the aggregated rows."""
    return economics(priced_lines(sales), ["vendor_id"], FULL).join(vendors.select("vendor_id", "vendor_name"), "vendor_id")


def by_region(sales: DataFrame, customers: DataFrame) -> DataFrame:
    located = priced_lines(sales).join(customers.select("customer_id", "region"), "customer_id")
    return economics(located, ["region"], FULL)


def by_category(lines: DataFrame, products: DataFrame, min_txns: int = 10) -> DataFrame:
    named = priced_lines(lines).join(products.select("product_id", top_category(F.col("categories")).alias("top_category")), "product_id")
    return named.groupBy("top_category").agg(
        *[MEASURES[m]().alias(m) for m in FULL[:-1]], F.count_distinct("product_id").alias("products")).where(F.col("txns") >= min_txns)


def by_vendor_and_region(sales: DataFrame, vendors: DataFrame, customers: DataFrame) -> DataFrame:
    located = priced_lines(sales).join(customers.select("customer_id", "region"), "customer_id").join(
        vendors.select("vendor_id", "vendor_name"), "vendor_id")
    return economics(located, ["vendor_name", "region"], ["txns", "avg_unit_price", "avg_discount_pct", "total_revenue", "margin_pct"])


def loss_makers(lines: DataFrame, products: DataFrame, k: int = 25) -> DataFrame:
    """Products with a loss over all their sales, worst first."""
    wanted = ["txns", "total_revenue", "total_profit", "margin_pct", "avg_discount_pct"]
    per = priced_lines(lines).where("profit IS NOT NULL").groupBy("product_id").agg(
        F.sum("profit").alias("profit"), *[MEASURES[m]().alias(m) for m in wanted]).where("profit < 0").drop("profit")
    named = products.select("product_id", "product_name", "brand", top_category(F.col("categories")).alias("top_category"))
    return per.join(named, "product_id").orderBy("total_profit", "product_id").limit(k)


def multi_price_products(lines: DataFrame, products: DataFrame) -> DataFrame:
    """Products sold at clearly different list prices."""
    per = priced_lines(lines).where("lp IS NOT NULL").groupBy("product_id").agg(
        F.count(F.lit(1)).alias("txns"), F.min("lp").alias("lo"), F.max("lp").alias("hi"))
    return (
        per.where(spread(F.col("lo"), F.col("hi")) > 0.05).join(products.select("product_id", "product_name"), "product_id")
        .select("product_id", "product_name", "txns", F.round("lo", 2).alias("price_point_1"), F.round("hi", 2).alias("price_point_2"),
                F.round(F.try_divide(F.col("hi").cast("double"), F.col("lo").cast("double")), 1).alias("price_ratio"))
    )


def discount_bands(lines: DataFrame) -> DataFrame:
    nd = F.col("nd")
    band = (
        F.when(nd == 0, "0% (no discount)").when(nd <= 0.1, "1-10%").when(nd <= 0.2, "10-20%").when(nd <= 0.5, "20-50%").otherwise("50%+")
    )
    return economics(priced_lines(lines).where("profit IS NOT NULL").withColumn("discount_band", band), ["discount_band"],
                     ["txns", "total_revenue", "total_profit", "margin_pct", "avg_unit_profit"])
