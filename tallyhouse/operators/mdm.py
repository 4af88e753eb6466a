"""Golden records by per-column survivorship."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyhouse.config import SURVIVORSHIP, Survivorship

UNKNOWN_RANK = 99


def source_rank(path: Column, order: tuple[str, ...]) -> Column:
    """Position of the source named in a file path, 99 if it is not listed."""
    rank = None
    for i, name in enumerate(order, 1):
        hit = path.rlike(f"(?<![0-9A-Za-z_]){re.escape(name)}(?![0-9A-Za-z_])")  # customers_10 is not customers_1
        rank = F.when(hit, i) if rank is None else rank.when(hit, i)
    return F.lit(UNKNOWN_RANK) if rank is None else rank.otherwise(UNKNOWN_RANK)


def golden_record(
    df: DataFrame,
    key: str,
    rules: list[Survivorship] | tuple[Survivorship, ...],
    source: str = "_source_file",
    loaded: str = "_load_timestamp",
) -> DataFrame:
    """One row per key; every column survives by its own rule.

    * ``source_priority``: value of the best-ranked source, even when it is NULL
    * ``most_recent``: value of the latest load, then the best-ranked source
    * ``most_complete``: first value that is not NULL by source rank

    Columns that share a strategy and an order of sources come from the same row. All strategies are ``min_by``
    aggregates of one grouping: rows are reduced map-side before the only shuffle, however
    many copies a key has. Remaining ties go to the smaller source name, then smaller value.
    """
    order = next((r.source_priority_order for r in rules if r.source_priority_order), ())
    # newest first under an ascending order
    age = -F.unix_micros(F.col(loaded).cast("timestamp"))
    by_order: dict[str, dict[tuple[str, ...], list[str]]] = {"source_priority": {}, "most_recent": {}}
    for r in rules:
        if r.strategy in by_order:
            by_order[r.strategy].setdefault(r.source_priority_order or order, []).append(r.canonical_column)
    priority, recent = by_order["source_priority"], by_order["most_recent"]
    rank_of = {r.canonical_column: source_rank(F.col(source), r.source_priority_order or order) for r in rules}
    complete = [r.canonical_column for r in rules if r.strategy == "most_complete"]
    aggs = []
    for i, names in enumerate(priority.values()):
        row = F.struct(*names)
        aggs.append(F.min_by(row, F.struct(rank_of[names[0]], F.col(source), row)).alias(f"_p{i}"))
    for i, names in enumerate(recent.values()):
        row = F.struct(*names)
        aggs.append(F.min_by(row, F.struct(age, rank_of[names[0]], F.col(source), row)).alias(f"_r{i}"))
    aggs.append(F.max(loaded).alias("_loaded"))
    for c in complete:
        aggs.append(F.min_by(F.col(c), F.struct(F.col(c).isNull(), rank_of[c], F.col(source), F.col(c))).alias(f"_c_{c}"))
    picked = df.groupBy(key).agg(*aggs)
    where = {c: f"_p{i}.{c}" for i, names in enumerate(priority.values()) for c in names}
    where |= {c: f"_r{i}.{c}" for i, names in enumerate(recent.values()) for c in names}
    where |= {c: f"_c_{c}" for c in complete}
    ordered = [c for c in df.columns if c in where]
    return picked.select(key, *[F.col(where[c]).alias(c) for c in ordered], F.col("_loaded").alias(loaded))


def golden_customers(df: DataFrame, rules: tuple[Survivorship, ...] = SURVIVORSHIP) -> DataFrame:
    return golden_record(df, "customer_id", [r for r in rules if r.entity == "customers"])


def keep_latest(df: DataFrame, key: str, loaded: str = "_load_timestamp") -> DataFrame:
    """Newest row per key. Every task keeps one row per key before the shuffle."""
    rest = [c for c in df.columns if c not in (key, loaded)]
    w = Window.partitionBy(key).orderBy(F.col(loaded).desc(), *[F.col(c).asc_nulls_last() for c in rest])
    return df.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")
