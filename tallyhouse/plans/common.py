"""Frames that several queries start from."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallyhouse.config import rules_for
from tallyhouse.operators import fraud, marts, star
from tallyhouse.operators.harmonize import harmonize_entity
from tallyhouse.operators.quality import drop_violations, quarantine
from tallyhouse.plans.check_views import RUN_ID
from tallyhouse.session import work_dir
from tallyhouse.sources.testbed import Testbed

RUN_AT = "2024-02-01 00:00:00"


def run_at():
    return F.lit(RUN_AT).cast("timestamp_ntz")


def harmonised(t: Testbed, entity: str) -> DataFrame:
    return harmonize_entity(t.bronze(entity), entity)


def clean(t: Testbed, entity: str) -> DataFrame:
    return drop_violations(harmonised(t, entity), rules_for(entity))


def rejected(t: Testbed, entity: str) -> DataFrame:
    return quarantine(harmonised(t, entity), rules_for(entity), RUN_ID, run_at())


def sales(t: Testbed) -> DataFrame:
    """Lines with customer and day of their order; no dimension is joined."""
    return star.sales_lines(t.lines, t.orders)


def orders_by_region(t: Testbed) -> DataFrame:
    """Orders with region and segment of their customer, which so never meet the lines themselves."""
    return star.with_customer(t.orders, t.customers, "region", "segment")


def sales_by_region(t: Testbed) -> DataFrame:
    return star.sales_lines(t.lines, orders_by_region(t), "region", "segment")


def full_sales(t: Testbed) -> DataFrame:
    return star.fact_sales(t.lines, t.orders, t.customers, t.products, t.vendors)


def returns(t: Testbed) -> DataFrame:
    """Matched returns with customer; no dimension is joined."""
    return star.returned_lines(t.returns, t.orders, t.lines)


def returns_by_region(t: Testbed) -> DataFrame:
    return star.returned_lines(t.returns, orders_by_region(t), t.lines, "region", "segment")


def staged(t: Testbed, name: str, df: DataFrame) -> DataFrame:
    """Rows that several branches of a query read, written once."""
    path = work_dir(t.spark, name)
    df.write.parquet(path)
    return t.spark.read.parquet(path)


def full_returns(t: Testbed) -> DataFrame:
    return star.fact_returns(t.returns, t.orders, t.lines, t.customers, t.products, t.vendors)


def revenue(t: Testbed) -> DataFrame:
    return marts.revenue_by_region(sales_by_region(t))


def rates(t: Testbed) -> DataFrame:
    return marts.return_rate_by_vendor(sales(t), returns(t), t.vendors)


def slow(t: Testbed) -> DataFrame:
    """Velocity as of the last day on which an order was placed that has lines."""
    return marts.slow_movers(sales_by_region(t), t.products, marts.last_sale_day(sales(t)))


def history(t: Testbed) -> DataFrame:
    return marts.customer_return_history(returns_by_region(t), t.customers)


def scored(t: Testbed) -> DataFrame:
    return fraud.score(fraud.customer_profile(returns(t), t.orders, t.customers))


def flagged(t: Testbed) -> DataFrame:
    return fraud.flagged(scored(t))
