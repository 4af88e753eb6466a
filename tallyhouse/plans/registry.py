"""Registry that pairs every query with its check SQL."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tallyhouse.plans.check_views import CHECK_VIEWS
from tallyhouse.sources.testbed import Testbed

Query = Callable[[Testbed], DataFrame]
QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; ``sql`` may use any view of ``CHECK_VIEWS`` by name."""

    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql:
            CHECKS[name] = sql
        return fn

    return add


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles and timestamps without zone, the types the check can compare."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DecimalType, T.FloatType)):
            c = c.cast("double")
        elif isinstance(f.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        out.append(c.alias(f.name))
    return df.select(*out)


def runnable(fn: Query) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: plain(fn(Testbed(spark, sf_dir)))


def expand(sql: str) -> str:
    """Put the views a check uses in front of it, in the order they depend on each other."""
    ordered: list[str] = []

    def visit(text: str) -> None:
        for word in dict.fromkeys(re.findall(r"[a-z][a-z0-9_]*", text)):
            if word in CHECK_VIEWS and word not in ordered:
                visit(CHECK_VIEWS[word])
                if word not in ordered:
                    ordered.append(word)

    visit(sql)
    if not ordered:
        return sql
    ctes = ",\n".join(f"{n} AS ({CHECK_VIEWS[n]})" for n in ordered)
    return f"WITH {ctes}\nSELECT * FROM (\n{sql}\n) answer"
