"""Executive key figures and the sentences built from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyhouse.config import MOM_SWING_PCT, VENDOR_CONCERN_PCT, VENDOR_RISK_PCT
from tallyhouse.functions.clean import region
from tallyhouse.functions.numbers import count_if, ratio


def month_index(year: Column, month: Column) -> Column:
    """Months since year 0: the month before January is December of the year before."""
    return year * 12 + month - 1


def periods(revenue: DataFrame) -> DataFrame:
    """Latest month with data and the calendar month before it."""
    last = revenue.where("year IS NOT NULL AND month IS NOT NULL AND region IS NOT NULL").agg(F.max(month_index(F.col("year"), F.col("month"))).alias("i"))
    year, month = lambda i: F.floor(i / 12).cast("int"), lambda i: (i % 12 + 1).cast("int")
    i = F.col("i")
    return last.select(year(i).alias("latest_year"), month(i).alias("latest_month"), year(i - 1).alias("prior_year"), month(i - 1).alias("prior_month"))


def region_kpis(revenue: DataFrame) -> DataFrame:
    """Latest month per region with margin and change on the month before.

    Both months are read in one aggregation; a region without a prior month shows no change.
    """
    valid = revenue.where("year IS NOT NULL AND month IS NOT NULL AND region IS NOT NULL").withColumn("i", month_index(F.col("year"), F.col("month")))
    last = valid.agg(F.max("i")).scalar()
    now, before = F.col("i") == last, F.col("i") == last - 1
    s = lambda c, cond: F.sum(F.when(cond, F.col(c)))
    both = valid.where(now | before).groupBy(region(F.col("region")).alias("region")).agg(
        F.round(s("total_sales", now), 2).alias("total_sales"), F.round(s("total_profit", now), 2).alias("total_profit"),
        s("order_count", now).alias("order_count"), s("total_sales", before).alias("prior"))
    prior = F.coalesce("prior", "total_sales")
    change = F.when(prior > 0, ratio(F.col("total_sales") - prior, prior, 1, 100)).otherwise(F.lit(0.0))
    margin = F.when(F.col("total_sales") > 0, ratio(F.col("total_profit"), F.col("total_sales"), 1, 100)).otherwise(F.lit(0.0))
    return both.where("total_sales IS NOT NULL").select(
        "region", "total_sales", "total_profit", margin.alias("profit_margin_pct"), "order_count", change.alias("mom_delta_pct"))


def revenue_summary(kpis: DataFrame) -> DataFrame:
    """Total, best and worst region, growing and declining regions. One row per region goes in."""
    swing = F.col("mom_delta_pct")
    names = lambda cond: F.array_join(F.sort_array(F.collect_list(F.when(cond, F.col("region")))), ", ")
    return kpis.agg(
        F.round(F.sum("total_sales"), 2).alias("total_revenue"), F.max_by("region", "total_sales").alias("top_region"),
        F.min_by("region", "total_sales").alias("bottom_region"), names(swing > MOM_SWING_PCT).alias("growing_regions"),
        names(swing < -MOM_SWING_PCT).alias("declining_regions"))


def vendor_kpis(rates: DataFrame, vendors: DataFrame) -> DataFrame:
    """Every vendor with its weighted return rate, status and the rate of the whole fleet."""
    n = lambda c: F.coalesce(F.sum(c), F.lit(0))
    per = vendors.select("vendor_id", "vendor_name").join(rates.drop("vendor_name"), "vendor_id", "left").groupBy("vendor_id", "vendor_name").agg(
        n("total_returns").alias("total_returns"), n("total_orders_sold").alias("total_orders"),
        F.round(n("total_refund_amount"), 2).alias("total_refund_amount"))
    rate = F.coalesce(ratio(F.col("total_returns"), F.col("total_orders"), 1, 100), F.lit(0.0))
    fleet = rates.agg(ratio(F.sum("total_returns"), F.sum("total_orders_sold"), 1, 100)).scalar()
    status = F.when(F.col("return_rate") > VENDOR_RISK_PCT, "HIGH RISK").when(F.col("total_orders") == 0, "no_return_data").otherwise("within threshold")
    return per.withColumn("return_rate", rate).withColumns({"status": status, "fleet_avg_return_rate": fleet})


def slow_stock_kpis(slow: DataFrame) -> DataFrame:
    """Idle products, tied-up sales and average idle days per region, as of the last sale day."""
    last = slow.agg(F.max("last_sale_date")).scalar()
    located = slow.where("region IS NOT NULL").withColumn("idle", F.datediff(last, "last_sale_date"))
    return located.groupBy(region(F.col("region")).alias("region")).agg(
        F.count(F.lit(1)).alias("slow_product_count"), F.round(F.sum(F.coalesce("total_sales", F.lit(0))), 2).alias("estimated_exposure"),
        ratio(F.sum("idle"), F.count("idle"), 0).alias("avg_days_stagnant"))


def slow_stock_summary(kpis: DataFrame) -> DataFrame:
    return kpis.agg(
        F.sum("slow_product_count").alias("total_slow_products"), F.round(F.sum("estimated_exposure"), 2).alias("total_exposure"),
        F.max_by("region", F.struct("slow_product_count", "region")).alias("worst_region"))


#: Rows that a bundle lists at most; its totals are over all rows.
LISTED = 50


def bundle(kpis: DataFrame, insight_type: str, by: str, totals: dict[str, Column], generated_at: Column, first: tuple[Column, ...] = (), most: int = LISTED) -> DataFrame:
    """A KPI table as one JSON text: time, totals over all of its rows, and the ``most`` first rows in order of ``first``, then ``by``.

    The list is a top-k report: every task keeps its best rows, so a table of any number of vendors gives a text of bounded size.
    """
    row = F.struct(F.col(by), *[F.col(c) for c in kpis.columns if c != by])
    summed = kpis.agg(F.struct(*[c.alias(name) for name, c in totals.items()]).alias("t")).scalar()
    place = F.row_number().over(Window.orderBy(*first, by))
    listed = kpis.orderBy(*first, by).limit(most).select(place.alias("nth"), row.alias("row")).agg(F.sort_array(F.collect_list(F.struct("nth", "row"))).alias("rows"))
    text = F.to_json(F.struct(F.lit(insight_type).alias("insight"), generated_at.cast("string").alias("generated_at"), summed.alias("totals"), F.transform("rows", lambda r: r["row"]).alias("by_row")))
    return listed.select(F.lit(insight_type).alias("insight_type"), generated_at.alias("generated_at"), text.alias("kpi_json"))


def insight_bundles(region: DataFrame, vendor: DataFrame, stock: DataFrame, generated_at: Column) -> DataFrame:
    """The three domains of the executive insights: revenue by region, returns by vendor, slow stock by region."""
    total = lambda c: F.sum(c).cast("double")
    revenue = bundle(region, "revenue_performance", "region", {"total_sales": total("total_sales"), "total_profit": total("total_profit"), "order_count": total("order_count")}, generated_at)
    returns = bundle(
        vendor, "vendor_return_rate", "vendor_id",
        {"vendors": F.count(F.lit(1)).cast("double"), "high_risk_vendors": count_if(F.col("status") == "HIGH RISK").cast("double"), "total_returns": total("total_returns"), "total_refund_amount": total("total_refund_amount")},
        generated_at, (F.col("return_rate").desc(),))
    idle = bundle(stock, "slow_moving_inventory", "region", {"total_slow_products": total("slow_product_count"), "total_exposure": total("estimated_exposure")}, generated_at)
    return revenue.unionByName(returns).unionByName(idle)


# --- sentences ------------------------------------------------------------------------------


def vendor_assessment(rates: DataFrame) -> DataFrame:
    r = F.round("return_rate_pct", 1)
    label = F.when(r < VENDOR_CONCERN_PCT, "ACCEPTABLE").when(r <= VENDOR_RISK_PCT, "CONCERNING").otherwise("CRITICAL")
    return rates.select(
        "vendor_id", "vendor_name", r.alias("return_rate_pct"), "total_returns", label.alias("risk_label"),
        F.format_string("Vendor %s has a return rate of %.1f%% against a benchmark of 20%%: %s.", "vendor_name", r, label).alias("risk_assessment"))


def revenue_assessment(kpis: DataFrame) -> DataFrame:
    d = F.col("mom_delta_pct")
    label = F.when(d < -MOM_SWING_PCT, "ALARMING").when(d > MOM_SWING_PCT, "OPPORTUNITY").otherwise("EXPECTED")
    return kpis.select(
        "region", "total_sales", "total_profit", "order_count", label.alias("revenue_label"),
        F.format_string("The %s region took $%.2f from %d orders, %.1f%% on the month before: %s.",
                        "region", F.col("total_sales").cast("double"), "order_count", d, label).alias("revenue_commentary"))
