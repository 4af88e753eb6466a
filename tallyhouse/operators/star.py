"""Dimensions and facts of the star schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tallyhouse.config import EXACT_MATCH_TOLERANCE
from tallyhouse.functions.numbers import ratio


def surrogate(*columns: str) -> Column:
    return F.md5(F.concat_ws("||", *[F.col(c).cast("string") for c in columns]))


def date_key(c: Column) -> Column:
    """``yyyyMMdd`` as a number; NULL stays NULL."""
    return F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)


# --- dimensions -----------------------------------------------------------------------------


def dim_customers(customers: DataFrame) -> DataFrame:
    return customers.select(
        surrogate("customer_id").alias("customer_key"), "customer_id", "customer_name", "customer_email",
        "segment", "country", "city", "state", "postal_code", "region",
    )


def dim_products(products: DataFrame) -> DataFrame:
    return products.select(
        surrogate("product_id").alias("product_key"), "product_id", "product_name", "brand", "categories", "colors",
        "manufacturer", "upc", "sizes", "weight", "product_photos_qty", "date_added", "date_updated", "dimension",
    )


def dim_vendors(vendors: DataFrame) -> DataFrame:
    return vendors.select(surrogate("vendor_id").alias("vendor_key"), "vendor_id", "vendor_name")


def dim_dates(orders: DataFrame, returns: DataFrame) -> DataFrame:
    """Calendar from the first to the last day of orders and returns, one row per day."""
    days = orders.select(F.to_date("order_purchase_timestamp").alias("d")).unionAll(returns.select(F.to_date("return_date").alias("d")))
    span = days.agg(
        F.coalesce(F.min("d"), F.lit("2015-01-01").cast("date")).alias("lo"),
        F.coalesce(F.max("d"), F.lit("2022-12-31").cast("date")).alias("hi"),
    )
    d = F.col("full_date")
    return span.select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias("full_date")).select(
        date_key(d).alias("date_key"),
        "full_date",
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.dayofweek(d).alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.dayofweek(d).isin(1, 7).alias("is_weekend"),
    )


# --- orders and sales -----------------------------------------------------------------------


def fact_orders(orders: DataFrame) -> DataFrame:
    """Order fact; a plain projection, the same for streams."""
    rest = [c for c in ("order_id", "customer_id", "vendor_id", "ship_mode", "order_status") if c in orders.columns]
    return orders.select(surrogate("order_id").alias("order_key"), *rest, *[c for c in orders.columns if c.startswith("order_") and c.endswith("_timestamp")])


def sales_lines(transactions: DataFrame, orders: DataFrame, *columns: str) -> DataFrame:
    """Lines with the customer, vendor and day of their order, and more ``columns`` of it.

    The vendor may hang on the order or on the line. The day key comes from the order itself:
    the calendar is built from the same orders, so looking the key up there would always
    find it.
    """
    wanted = ["order_id", "customer_id"] + (["vendor_id"] if "vendor_id" not in transactions.columns else [])
    return transactions.join(
        orders.select(*wanted, date_key(F.col("order_purchase_timestamp")).alias("order_date_key"), *columns), "order_id"
    )


def with_customer(df: DataFrame, customers: DataFrame, *columns: str) -> DataFrame:
    return df.join(customers.select("customer_id", *columns), "customer_id", "left")


SALES_COLUMNS = (
    "sales_key", "customer_key", "customer_id", "region", "segment", "product_key", "product_id", "vendor_key", "vendor_id",
    "order_date_key", "order_id", "sales", "quantity", "discount", "profit", "payment_type", "payment_installments",
)


def fact_sales(
    transactions: DataFrame, orders: DataFrame, customers: DataFrame, products: DataFrame, vendors: DataFrame, odd: dict[str, DataFrame] | None = None
) -> DataFrame:
    """Sales fact with all surrogate keys. ``transactions`` may be a stream.

    Customers are joined to the orders, which are fewer than the lines, and keys are made from the ids after the joins. Where ``odd``
    holds the :func:`odd_ids` of a dimension by the name of its key, lines are joined to these instead of to the dimension.
    """
    odd = odd or {}
    placed = _with_known(orders, customers, "customer_id", "region", "segment")
    lines = sales_lines(transactions, placed, "_customer_id", "region", "segment")
    for key, dimension in (("product_id", products), ("vendor_id", vendors)):
        lines = _with_odd(lines, odd[key], key) if key in odd else _with_known(lines, dimension, key)
    return _keyed(lines).withColumn("sales_key", surrogate("order_id", "product_id")).select(*SALES_COLUMNS)


def odd_ids(df: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Ids of ``df`` that a dimension does not have just once and spelled alike, with what a join to it finds for them.

    A dimension has nearly all ids once, so these are few; written to a folder of their own, Spark sees how few before it plans a
    join to them. Only ids are shuffled for it. An id that the dimension lacks comes with NULL, one that it repeats as often as there.
    """
    met = df.select(key).where(F.col(key).isNotNull()).distinct().join(dimension.select(key, F.col(key).alias(f"_{key}")), key, "left")
    found = F.col(f"_{key}").cast("string")
    times = F.count(F.lit(1)).over(Window.partitionBy(key))
    return met.select(key, found.alias(f"_{key}"), times.alias("_times")).where(
        (F.col("_times") > 1) | ~F.col(f"_{key}").eqNullSafe(F.col(key).cast("string"))).drop("_times")


def _with_odd(df: DataFrame, odd: DataFrame, key: str) -> DataFrame:
    """What ``_with_known`` adds, as text: odd ids have it from ``odd``, and all others are known."""
    found = odd.select(key, F.col(f"_{key}").alias("_found"), F.lit(True).alias("_odd"))
    known = F.when(F.col("_odd"), F.col("_found")).otherwise(F.col(key).cast("string"))
    return df.join(found, key, "left").withColumn(f"_{key}", known).drop("_found", "_odd")


def _with_known(df: DataFrame, dimension: DataFrame, key: str, *columns: str) -> DataFrame:
    """The id that the dimension has for a row, as ``_`` and its name, NULL if it has none."""
    return df.join(dimension.select(key, F.col(key).alias(f"_{key}"), *columns), key, "left")


def _keyed(df: DataFrame) -> DataFrame:
    """Surrogate keys of the ids that their dimensions know; they are long, so they travel through no join."""
    return df.withColumns({f"{n}_key": F.when(F.col(f"_{n}_id").isNotNull(), surrogate(f"_{n}_id")) for n in ("customer", "product", "vendor")})


# --- returns ----------------------------------------------------------------------------------

# Orders are counted in so many groups. Those of a group with more lines and returns than ``LONG`` are cut into price buckets.
CROWDS = 1 << 16
LONG = 1 << 18
# Width of a price bucket within such an order.
BUCKET = 1 << 16


def _rank_price(transactions: DataFrame) -> Column:
    """Price used for ranking: a missing one counts as 0."""
    return F.coalesce("sales", F.lit(0).cast(transactions.schema["sales"].dataType)).alias("price")


def _line(transactions: DataFrame) -> Column:
    """What a match reports about the line; the order of fields breaks ties."""
    return F.struct("product_id", "sales", *[c for c in ("vendor_id",) if c in transactions.columns]).alias("line")


def price_points(transactions: DataFrame) -> DataFrame:
    """Lines of an order reduced to its distinct prices.

    ``order_id, price``, the first line at that price and how many priced lines share it.
    """
    return transactions.select("order_id", _rank_price(transactions), _line(transactions)).groupBy("order_id", "price").agg(
        F.min("line").alias("line"), F.count("line.sales").alias("lines"))


def match_confidence(has_lines: Column, same_price: Column) -> Column:
    return (
        F.when(~F.coalesce(has_lines, F.lit(False)), "ORPHAN")
        .when(same_price == 1, "EXACT")
        .when(same_price > 1, "AMBIGUOUS")
        .otherwise("ESTIMATED")
    )


def _match_by_sorting(returns: DataFrame, transactions: DataFrame) -> DataFrame:
    """Nearest price for orders of any size, without pairing returns with lines.

    Lines and returns of an order are shuffled once, by order, and sorted once, together by price; the neighbours of a refund are the
    least line of the last price up to its own and that of the first price after it. Long orders are cut into price buckets,
    to which the nearest lines of other buckets are added (``_beyond``).
    """
    kept = {c: f"_r{i}" for i, c in enumerate(returns.columns)}
    refund = F.coalesce("refund_amount", F.lit(0).cast(returns.schema["refund_amount"].dataType)).alias("price")
    lines = transactions.where(F.col("order_id").isNotNull()).select("order_id", _rank_price(transactions), _line(transactions))
    asked = returns.select("order_id", refund, *[F.col(c).alias(r) for c, r in kept.items()])
    # orders are counted by groups of them, so that few rows are shuffled; at most one in LONG rows is the number of a group that is cut
    rows = lines.select("order_id").unionAll(asked.select("order_id").where(F.col("order_id").isNotNull()))
    crowd = F.pmod(F.xxhash64(F.col("order_id").cast(rows.schema["order_id"].dataType)), F.lit(CROWDS))
    long = rows.groupBy(crowd.alias("crowd")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > LONG).agg(F.collect_list("crowd")).scalar()
    cut = F.array_contains(long, crowd)
    # a return without an order has no neighbours, so any part will do
    part = F.when(F.col("order_id").isNull(), F.xxhash64(*kept.values())).when(cut, _bucket()).otherwise(F.lit(0).cast("bigint"))
    beyond = _beyond(price_points(transactions.where(F.col("order_id").isNotNull() & cut)), asked.where(F.col("order_id").isNotNull() & cut))
    events = lines.unionByName(asked, allowMissingColumns=True).withColumn("part", part).unionByName(beyond, allowMissingColumns=True)
    # the shuffle comes first, so that it moves no column made for the windows
    is_line = F.col("line").isNotNull()
    dealt = events.repartition("order_id", "part").withColumn("spot", F.when(is_line, F.struct("price", "line")))
    keys, by = ["order_id", "part"], ["price", "line IS NULL", "line"]
    order = Window.partitionBy(*keys).orderBy(*[F.expr(c) for c in by])
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = dealt.withColumns({
        "_last": F.lag("spot").over(order)["price"], "_n": F.count("line.sales").over(so_far),
        "hi": F.expr(f"lead(spot) IGNORE NULLS OVER (PARTITION BY {', '.join(keys)} ORDER BY {', '.join(by)})")})
    # the least line of each price, and how many priced lines come before it
    before = (F.col("_n") - F.col("line.sales").isNotNull().cast("int")).alias("before")
    head = F.when(is_line & ~F.col("_last").eqNullSafe(F.col("price")), F.struct("price", "line", before))
    near = placed.withColumn("lo", F.last(head, True).over(so_far)).where("line IS NULL")
    gap = lambda c: F.when(F.col(c).isNotNull(), F.struct(F.abs(F.col(f"{c}.price") - F.col("price")).alias("gap"), F.col(f"{c}.line").alias("line")))
    found = near.select(
        "order_id", "price", *kept.values(), F.least(gap("lo"), gap("hi"))["line"].alias("_line"),
        F.when(F.col("lo.price") == F.col("price"), F.col("_n") - F.col("lo.before")).alias("_same"))
    # in whole cents only an equal price is closer than the tolerance
    if not (_in_cents(returns.schema["refund_amount"].dataType) and _in_cents(transactions.schema["sales"].dataType)):
        found = _count_same(found.drop("_same"), asked.select("order_id", "price").distinct(), price_points(transactions))
    return found.select(
        *[F.col(r).alias(c) for c, r in kept.items()], "_line", F.col("_line").isNotNull().alias("_has"),
        F.when(F.col(kept["refund_amount"]).isNotNull(), F.coalesce("_same", F.lit(0))).alias("_same"),
    )


def _bucket() -> Column:
    return F.floor(F.col("price") / BUCKET).cast("bigint")


def _beyond(points: DataFrame, asked: DataFrame) -> DataFrame:
    """The nearest price points below and above each bucket that has refunds, as lines of that bucket."""
    events = points.select("order_id", "price", F.struct("price", "line").alias("spot")).unionByName(asked.select("order_id", "price"), allowMissingColumns=True)
    priced = F.when(F.col("spot").isNotNull(), F.col("price"))
    edges = events.groupBy("order_id", _bucket().alias("part")).agg(
        F.max_by("spot", priced).alias("top"), F.min_by("spot", priced).alias("bottom"), F.max(F.col("spot").isNull()).alias("wanted"))
    outer = Window.partitionBy("order_id").rowsBetween(Window.unboundedPreceding, -1)
    around = edges.select(
        "order_id", "part", "wanted",
        F.last("top", True).over(outer.orderBy("part")).alias("below"),
        F.last("bottom", True).over(outer.orderBy(F.col("part").desc())).alias("above"),
    ).where("wanted")
    return around.select("order_id", "part", F.explode(F.array_compact(F.array("below", "above"))).alias("spot")).select("order_id", "part", "spot.price", "spot.line")


def _in_cents(kind: T.DataType) -> bool:
    return isinstance(kind, T.IntegralType) or isinstance(kind, T.DecimalType) and kind.scale <= 2 and float(EXACT_MATCH_TOLERANCE) <= 0.01


def _count_same(best: DataFrame, asked: DataFrame, points: DataFrame) -> DataFrame:
    """``_same``, the lines whose price is closer to the asked one than the tolerance, for prices of any type."""
    # prices closer than the tolerance lie in the same or the next cent
    cents = lambda c: F.floor(c * 100).cast("bigint")
    by_cent = points.select("order_id", F.col("price").alias("p"), "lines", cents(F.col("price")).alias("cent"))
    same = (
        asked.withColumn("cent", F.explode(F.transform(F.array(F.lit(-1), F.lit(0), F.lit(1)), lambda i: cents(F.col("price")) + i)))
        .join(by_cent, ["order_id", "cent"])
        .where(F.abs(F.col("p") - F.col("price")) < F.lit(EXACT_MATCH_TOLERANCE).cast("decimal(3,2)"))
        .groupBy("order_id", "price").agg(F.sum("lines").alias("_same"))
    )
    return best.join(same, ["order_id", "price"], "left")


def match_returns(returns: DataFrame, transactions: DataFrame) -> DataFrame:
    """Find the returned line: the one whose price is nearest to the refund.

    Ties go to the smaller product. Adds ``product_id``, ``original_sales``,
    ``match_confidence`` (and ``vendor_id`` when lines carry it).

    Prices are sorted per order, and per price bucket in long orders, so no order is gathered whole, whatever
    its length, and no job runs when this is called.
    """
    matched = _match_by_sorting(returns, transactions)
    vendor = [F.col("_line.vendor_id").alias("vendor_id")] if "vendor_id" in transactions.columns else []
    return matched.select(
        *returns.columns, "_line.product_id", F.col("_line.sales").alias("original_sales"), *vendor,
        match_confidence(F.col("_has"), F.col("_same")).alias("match_confidence"),
    )


RETURN_COLUMNS = (
    "return_key", "customer_key", "customer_id", "region", "segment", "product_key", "product_id", "vendor_key", "vendor_id",
    "return_date_key", "order_id", "refund_amount", "return_reason", "return_status", "return_date", "original_sales",
    "return_to_sales_ratio", "match_confidence",
)


def return_ratio() -> Column:
    sale = F.col("original_sales")
    return F.when(sale > 0, ratio(F.col("refund_amount"), sale, 2).cast("decimal(14,2)"))


def returned_lines(returns: DataFrame, orders: DataFrame, transactions: DataFrame, *columns: str) -> DataFrame:
    """Matched returns with customer and vendor of their order, and more ``columns`` of it."""
    matched = match_returns(returns, transactions)
    wanted = ["order_id", "customer_id"] + (["vendor_id"] if "vendor_id" not in transactions.columns else [])
    return matched.join(orders.select(*wanted, *columns), "order_id", "left").withColumn("return_to_sales_ratio", return_ratio())


def fact_returns(
    returns: DataFrame, orders: DataFrame, transactions: DataFrame, customers: DataFrame, products: DataFrame, vendors: DataFrame
) -> DataFrame:
    """Returns fact with all surrogate keys; a return without order keeps NULL keys."""
    placed = _with_known(orders, customers, "customer_id", "region", "segment")
    lines = returned_lines(returns, placed, transactions, "_customer_id", "region", "segment")
    lines = _with_known(_with_known(lines, products, "product_id"), vendors, "vendor_id")
    return _keyed(lines).withColumns(
        {"return_key": surrogate("order_id", "return_date"), "return_date_key": date_key(F.col("return_date"))}
    ).select(*RETURN_COLUMNS)
