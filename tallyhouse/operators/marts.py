"""Aggregated marts over the facts.

None of them sorts its output: a stored mart has no order, reports sort when they present.
Several distinct counts or a distinct count next to sums are planned by Spark as two-step
aggregates keyed by group *and* distinct value, so a dominant group is spread over tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyhouse.functions.numbers import mean, ratio

MONTHS = ("January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December")


def date_parts(key: Column) -> dict[str, Column]:
    """Calendar columns from a day key; the same values the calendar holds, without a join."""
    month = F.floor(key / 100) % 100
    return {
        "year": F.floor(key / 10000).cast("int"),
        "quarter": F.floor((month + 2) / 3).cast("int"),
        "month": month.cast("int"),
        "month_name": F.try_element_at(F.array(*[F.lit(m) for m in MONTHS]), month.cast("int")),
    }


def key_to_date(key: Column) -> Column:
    return F.try_to_timestamp(key.cast("string"), F.lit("yyyyMMdd")).cast("date")


def revenue_by_region(sales: DataFrame) -> DataFrame:
    """Monthly sales, profit, lines and orders per region."""
    orders = F.count_distinct("order_id")
    return (
        sales.withColumns(date_parts(F.col("order_date_key")))
        .groupBy("year", "quarter", "month", "month_name", "region")
        .agg(
            F.round(F.sum("sales"), 2).alias("total_sales"),
            F.round(F.sum("profit"), 2).alias("total_profit"),
            F.count(F.lit(1)).alias("line_item_count"),
            orders.alias("order_count"),
            mean(F.sum("sales"), F.count("sales")).alias("avg_line_item_value"),
            ratio(F.sum("sales"), orders, 2).alias("avg_order_value"),
        )
    )


def return_rate_by_vendor(sales: DataFrame, returns: DataFrame, vendors: DataFrame) -> DataFrame:
    """Returns per distinct order sold, in percent, for every vendor that sold."""
    sold = sales.groupBy("vendor_id").agg(
        F.count_distinct("order_id").alias("total_orders_sold"), F.round(F.sum("sales"), 2).alias("total_sales"))
    returned = returns.groupBy("vendor_id").agg(
        F.count(F.lit(1)).alias("total_returns"),
        F.round(F.sum("refund_amount"), 2).alias("total_refund_amount"),
        mean(F.sum("refund_amount"), F.count("refund_amount")).alias("avg_refund_amount"),
    )
    return (
        sold.join(returned, "vendor_id", "left")
        .join(vendors.select("vendor_id", "vendor_name"), "vendor_id", "left")
        .fillna({"total_returns": 0})
        .withColumn("total_refund_amount", F.coalesce("total_refund_amount", F.lit(0)))
        .select(
            "vendor_id", "vendor_name", "total_orders_sold", "total_sales", "total_returns", "total_refund_amount",
            "avg_refund_amount", ratio(F.col("total_returns"), F.col("total_orders_sold"), 2, 100).alias("return_rate_pct"),
        )
    )


def slow_movers(sales: DataFrame, products: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Sales velocity per product and region as of a day (today unless given).

    Names are joined after the aggregation, on one row per product and region.
    """
    today = as_of if as_of is not None else F.current_date()
    totals = sales.groupBy("product_id", "region").agg(
        F.sum("quantity").alias("total_quantity_sold"),
        F.round(F.sum("sales"), 2).alias("total_sales"),
        F.count_distinct("order_id").alias("order_count"),
        key_to_date(F.min("order_date_key")).alias("first_sale_date"),
        key_to_date(F.max("order_date_key")).alias("last_sale_date"),
    )
    period = F.datediff("last_sale_date", "first_sale_date")
    qty = F.col("total_quantity_sold")
    return totals.join(products.select("product_id", "product_name", "brand"), "product_id", "left").select(
        "product_id", "product_name", "brand", "region", "total_quantity_sold", "total_sales", "order_count",
        "first_sale_date", "last_sale_date",
        F.datediff(today, "last_sale_date").alias("days_since_last_sale"),
        period.alias("selling_period_days"),
        F.when(period > 0, ratio(qty, period, 2)).otherwise(qty.cast("double")).alias("avg_daily_quantity"),
    )


def last_sale_day(sales: DataFrame) -> Column:
    """Latest day of the data as a scalar subquery."""
    return sales.agg(key_to_date(F.max("order_date_key"))).scalar()


def customer_return_history(returns: DataFrame, customers: DataFrame) -> DataFrame:
    """Return behaviour per customer with a HIGH, MEDIUM or LOW band."""
    per = returns.groupBy("customer_id", "region", "segment").agg(
        F.count(F.lit(1)).alias("total_returns"),
        F.round(F.sum("refund_amount"), 2).alias("total_refund_amount"),
        mean(F.sum("refund_amount"), F.count("refund_amount")).alias("avg_refund_amount"),
        F.round(F.max("refund_amount"), 2).alias("max_single_refund"),
        F.min("return_date").alias("first_return_date"),
        F.max("return_date").alias("last_return_date"),
        F.count_distinct("return_reason").alias("distinct_reasons"),
        mean(F.sum("return_to_sales_ratio"), F.count("return_to_sales_ratio")).alias("avg_return_to_sales_ratio"),
    )
    n = F.col("total_returns")
    band = (
        F.when((n >= 5) & (F.col("avg_return_to_sales_ratio") > 0.8), "HIGH")
        .when((n >= 3) | (F.col("max_single_refund") > 400), "MEDIUM")
        .otherwise("LOW")
    )
    return per.join(customers.select("customer_id", "customer_name", "customer_email"), "customer_id", "left").select(
        "customer_id", "customer_name", "customer_email", "segment", "region", "total_returns", "total_refund_amount",
        "avg_refund_amount", "max_single_refund", "first_return_date", "last_return_date",
        F.datediff("last_return_date", "first_return_date").alias("days_between_first_last_return"),
        "distinct_reasons", "avg_return_to_sales_ratio", band.alias("fraud_risk_score"),
    )


def price_history(transactions: DataFrame, orders: DataFrame) -> DataFrame:
    """Versions of the list price per product and vendor, with validity and running figures.

    The discount is a fraction, so the list price is ``sales / (quantity * (1 - discount))``.
    Versions of one product and vendor are numbered across the days on which they start:
    inside a day by a window over that day, across days by a window over one row per day. A
    product that holds a third of all prices is therefore spread over its days instead of
    being sorted in one task. Product, vendor and day travel as one struct, which is never NULL, so the days,
    the windows and the join of both read versions from one shuffle.
    """
    wanted = ["order_id", "order_purchase_timestamp"] + (["vendor_id"] if "vendor_id" not in transactions.columns else [])
    net = F.col("quantity").cast("decimal(10,0)") * (F.lit(1) - F.col("discount"))
    base = (
        transactions.where("sales IS NOT NULL")
        .withColumn("base_unit_price", ratio(F.col("sales"), net, 2).cast("decimal(12,2)"))
        .join(orders.select(*wanted), "order_id")
    )
    keys = ["product_id", "vendor_id"]
    versions = base.groupBy(*keys, "base_unit_price").agg(F.min("order_purchase_timestamp").alias("valid_from"))
    versions = versions.select(F.struct(*keys, F.to_date("valid_from").alias("day")).alias("k"), "base_unit_price", "valid_from").repartition("k")

    price = F.col("base_unit_price")
    # counting from prices alone, the days need the same columns as the windows
    priced = F.count(price)
    days = versions.groupBy("k").agg(
        (priced + F.count(F.when(price.isNull(), 1))).alias("n"), F.sum(price).alias("total"), priced.alias("priced"),
        F.min(price).alias("lo"), F.max(price).alias("hi"), F.min("valid_from").alias("first"),
    )
    across = Window.partitionBy(*keys).orderBy(F.col("day").asc_nulls_first())
    earlier = across.rowsBetween(Window.unboundedPreceding, -1)
    carried = days.select("k.*", "n", "total", "priced", "lo", "hi", "first").select(
        F.struct(*keys, "day").alias("k"),
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("n0"),
        F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("total0"),
        F.coalesce(F.sum("priced").over(earlier), F.lit(0)).alias("priced0"),
        F.min("lo").over(earlier).alias("lo0"), F.max("hi").over(earlier).alias("hi0"),
        F.lead("first").over(across).alias("next_day_from"),
    )
    within = Window.partitionBy("k").orderBy(F.col("valid_from").asc_nulls_first(), F.col("base_unit_price").asc_nulls_first())
    so_far = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = versions.select(
        "k", "base_unit_price", "valid_from",
        F.lead("valid_from").over(within).alias("next_from"),
        F.row_number().over(within).alias("rank"),
        F.sum(price).over(so_far).alias("total"), F.count(price).over(so_far).alias("priced"),
        F.min(price).over(so_far).alias("lo"), F.max(price).over(so_far).alias("hi"),
    )
    valid_to = F.coalesce("next_from", "next_day_from")
    return local.join(carried, "k").select(
        *[F.col("k")[c].alias(c) for c in keys], "base_unit_price", "valid_from", valid_to.alias("valid_to"),
        valid_to.isNull().alias("is_current"),
        (F.col("n0") + F.col("rank")).cast("int").alias("version_rank"),
        mean(F.col("total0") + F.col("total"), F.col("priced0") + F.col("priced")).alias("avg_price_to_date"),
        F.least("lo0", "lo").alias("min_price_to_date"),
        F.greatest("hi0", "hi").alias("max_price_to_date"),
    )


#: Days of one piece of a key's time line in ``price_as_of``.
PIECE_DAYS = 30


def price_as_of(lookups: DataFrame, history: DataFrame, at: str = "order_purchase_timestamp", keys: tuple[str, ...] = ("product_id", "vendor_id"), days: int = PIECE_DAYS) -> DataFrame:
    """The version of the price that was valid when each row of ``lookups`` happened.

    Adds ``list_price``, ``price_valid_from``, ``price_valid_to`` and ``price_version``, all NULL for a row before the first
    version, without a time, or of a key without history. A version holds from ``valid_from`` on, that moment included;
    of versions that begin together the last one counts. NULL keys are a key of their own.

    The time line of a key is cut into pieces of ``days``. Each piece begins with the version carried in from the pieces
    before, one row per piece, so versions and lookups are merged in order piece by piece: a key with
    millions of versions is sorted in as many tasks as its time line has pieces, and nothing is paired. Key and piece
    travel as one struct, so that pieces and windows read versions and lookups from one shuffle.
    """
    piece = F.floor(F.unix_date(F.to_date("_at")) / days).alias("_piece")
    place = F.struct(*keys, piece).alias("k")
    moment, kinds = lookups.schema[at].dataType, {k: lookups.schema[k].dataType for k in keys}
    version = F.struct(F.col("base_unit_price").alias("list_price"), F.col("valid_from").alias("price_valid_from"), F.col("valid_to").alias("price_valid_to"), F.col("version_rank").alias("price_version"))
    starts = history.where("valid_from IS NOT NULL").select(*keys, F.col("valid_from").cast(moment).alias("_at"), version.alias("_version"))
    # key and time are not repeated in the rest of the row
    rest = [F.col(f"`{c}`") for c in lookups.columns if c != at and c not in keys]
    rows = lookups.select(*keys, F.col(at).alias("_at"), F.struct(*(rest or [F.lit(True).alias("_")])).alias("_row"))
    events = rows.unionByName(starts, allowMissingColumns=True).select(place, "_at", "_row", "_version").repartition("k")
    is_row = F.col("_row").isNotNull()
    # the last version of each piece; of the pieces that are asked for, the one carried in
    pieces = events.groupBy("k").agg(F.max_by("_version", F.when(~is_row, F.struct("_at", "_version.price_version"))).alias("_last"))
    earlier = Window.partitionBy(*keys).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    carried = pieces.select("k.*", "_last").select(F.struct(*keys, "_piece").alias("k"), F.last("_last", True).over(earlier).alias("_before")).where("_before IS NOT NULL")
    # versions come before the rows of their moment, the last one last
    until = Window.partitionBy("k").orderBy("_at", is_row, "_version.price_version").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = events.select("k", "_row", "_at", F.last("_version", True).over(until).alias("_version")).where("_row IS NOT NULL")
    valid = F.when(F.col("_at").isNotNull(), F.coalesce("_version", "_before"))
    columns = {at: F.col("_at"), **{k: F.col("k")[k].cast(kind) for k, kind in kinds.items()}}
    return found.join(carried, "k", "left").select(
        *[columns.get(c, F.col("_row")[c]).alias(c) for c in lookups.columns],
        *[valid[c].alias(c) for c in ("list_price", "price_valid_from", "price_valid_to", "price_version")])
