"""Metric views: named dimensions and measures over a joined source, aggregated on request."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from tallyhouse.config import SLOW_DAYS
from tallyhouse.functions.numbers import count_if, mean, ratio
from tallyhouse.operators.marts import date_parts


@dataclass(frozen=True)
class MetricView:
    """A source with its joins, plus expressions by name.

    A join is made only if one of the requested names needs it, so asking for a measure of the
    fact alone reads no dimension.
    """

    source: DataFrame
    dimensions: dict[str, Callable[[], Column]]
    measures: dict[str, Callable[[], Column]]
    joins: dict[str, tuple[DataFrame, str]] = field(default_factory=dict)
    needs: dict[str, str] = field(default_factory=dict)


def metric_query(
    view: MetricView, dims: list[str], measures: list[str], where: Column | None = None, order_by: str | None = None, filters: dict[str, object] | None = None
) -> DataFrame:
    """``measures`` per combination of ``dims``; unknown names are an error.

    ``filters`` keeps rows by dimension, selected or not, before they are aggregated: a value, a list of values, None for
    NULL, or a function from the dimension to a condition. ``where`` is a condition on columns of the source.
    """
    filters = filters or {}
    for name in [*dims, *measures, *filters]:
        if name not in view.dimensions and (name in filters or name not in view.measures):
            raise KeyError(f"{name} is not part of this metric view")
    df = view.source
    for join in dict.fromkeys(view.needs[n] for n in [*dims, *measures, *filters] if n in view.needs):
        other, key = view.joins[join]
        df = df.join(other, key, "left")
    if where is not None:
        df = df.where(where)
    for name, wanted in filters.items():
        c = view.dimensions[name]()
        if callable(wanted):
            df = df.where(wanted(c))
        elif wanted is None:
            df = df.where(c.isNull())
        else:
            df = df.where(c.isin(*wanted) if isinstance(wanted, list | tuple | set) else c == F.lit(wanted))
    out = df.groupBy(*[view.dimensions[d]().alias(d) for d in dims]).agg(*[view.measures[m]().alias(m) for m in measures])
    return out.orderBy(F.col(order_by).desc(), *dims) if order_by else out


def revenue_view(sales: DataFrame, customers: DataFrame) -> MetricView:
    orders = lambda: F.count_distinct("order_id")
    part = lambda name: (lambda: date_parts(F.col("order_date_key"))[name])
    return MetricView(
        source=sales.drop("region", "segment"),
        joins={"customers": (customers.select("customer_id", "region", "segment"), "customer_id")},
        needs={"region": "customers", "segment": "customers"},
        dimensions={
            "region": lambda: F.col("region"),
            "segment": lambda: F.col("segment"),
            "year": part("year"),
            "quarter": part("quarter"),
            "month": part("month_name"),
            "payment_type": lambda: F.col("payment_type"),
        },
        measures={
            "total_revenue": lambda: F.sum("sales"),
            "total_profit": lambda: F.sum("profit"),
            "profit_margin_pct": lambda: ratio(F.sum("profit"), F.sum("sales"), 1, 100),
            "order_count": orders,
            "units_sold": lambda: F.sum("quantity"),
            "avg_order_value": lambda: ratio(F.sum("sales"), orders(), 2),
        },
    )


def vendor_returns_view(returns: DataFrame, vendors: DataFrame) -> MetricView:
    n = lambda: F.count(F.lit(1))
    return MetricView(
        source=returns,
        joins={"vendors": (vendors.select("vendor_id", "vendor_name"), "vendor_id")},
        needs={"vendor": "vendors"},
        dimensions={
            "vendor": lambda: F.col("vendor_name"),
            "return_reason": lambda: F.col("return_reason"),
            "return_status": lambda: F.col("return_status"),
            "return_year": lambda: F.year("return_date"),
        },
        measures={
            "total_returns": n,
            "total_refund_amount": lambda: F.round(F.sum("refund_amount"), 2),
            "avg_refund_amount": lambda: mean(F.sum("refund_amount"), F.count("refund_amount")),
            "return_rate_pct": lambda: ratio(n(), F.count_distinct("order_id"), 1, 100),
        },
    )


def inventory_view(slow: DataFrame, products: DataFrame) -> MetricView:
    days = lambda: F.col("days_since_last_sale")
    return MetricView(
        source=slow.drop("brand"),
        joins={"products": (products.select("product_id", "brand", "categories"), "product_id")},
        needs={"brand": "products", "category": "products"},
        dimensions={
            "region": lambda: F.col("region"),
            "brand": lambda: F.col("brand"),
            "category": lambda: F.col("categories"),
            "slow_moving_flag": lambda: F.when(days() > SLOW_DAYS, "Yes").otherwise("No"),
        },
        measures={
            "slow_product_count": lambda: count_if(days() > SLOW_DAYS),
            "avg_days_since_last_sale": lambda: mean(F.sum("days_since_last_sale"), F.count("days_since_last_sale"), 0),
            "total_quantity_sold": lambda: F.sum("total_quantity_sold"),
            "total_sales": lambda: F.round(F.sum("total_sales"), 2),
        },
    )
