"""Exploration of raw tables: gaps, duplicates, formats and key overlap."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tallyhouse.functions.numbers import count_if, ratio


def missing_values(frames: dict[str, DataFrame]) -> DataFrame:
    """Null or blank cells per column that has any; one aggregation per table."""
    parts = []
    for table, d in frames.items():
        blank = lambda c: F.col(f"`{c}`").isNull() | (F.trim(F.col(f"`{c}`").cast("string")) == "")
        counted = d.agg(F.count(F.lit(1)).alias("total"), *[count_if(blank(c)).alias(f"m{i}") for i, c in enumerate(d.columns)])
        rows = [F.struct(F.lit(table).alias("table_name"), F.lit(c).alias("column_name"), F.col(f"m{i}").alias("null_or_empty_count"), F.col("total").alias("total_rows"))
                for i, c in enumerate(d.columns)]
        parts.append(counted.select(F.inline(F.array(*rows))))
    return reduce(DataFrame.unionByName, parts).where("null_or_empty_count > 0").withColumn(
        "pct_missing", ratio(F.col("null_or_empty_count"), F.col("total_rows"), 2, 100))


def duplicate_keys(frames: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Rows, distinct keys and surplus rows per table; a missing key counts as one key."""
    parts = []
    for table, (d, key) in frames.items():
        counted = d.groupBy(key).agg(F.count(F.lit(1)).alias("n")).agg(F.sum("n").alias("total_rows"), F.count(F.lit(1)).alias("distinct_keys"))
        parts.append(counted.withColumns({"table_name": F.lit(table), "key_column": F.lit(key)}))
    out = reduce(DataFrame.unionByName, parts).withColumn("duplicate_rows", F.col("total_rows") - F.col("distinct_keys"))
    return out.withColumn("pct_duplicates", F.coalesce(ratio(F.col("duplicate_rows"), F.col("total_rows"), 2, 100), F.lit(0.0)))


def prefix_share(checks: list[tuple[str, DataFrame, str]], prefix: str = "$") -> DataFrame:
    """How many values of a text column carry a prefix."""
    parts = []
    for table, d, column in checks:
        counted = d.agg(F.count(F.lit(1)).alias("total_rows"), count_if(F.col(column).startswith(prefix)).alias("with_prefix"))
        parts.append(counted.withColumns({"table_name": F.lit(table), "column_name": F.lit(column)}))
    return reduce(DataFrame.unionByName, parts).withColumns({
        "without_prefix": F.col("total_rows") - F.col("with_prefix"),
        "pct_with_prefix": ratio(F.col("with_prefix"), F.col("total_rows"), 1, 100),
        "status": F.when(F.col("with_prefix") > 0, "MIXED").otherwise("CLEAN"),
    })


def distributions(checks: list[tuple[str, DataFrame, str]]) -> DataFrame:
    """Value counts of several categorical columns."""
    parts = [d.groupBy(F.col(c).cast("string").alias("value")).agg(F.count(F.lit(1)).alias("cnt")).withColumns(
        {"table_name": F.lit(t), "column_name": F.lit(c)}) for t, d, c in checks]
    return reduce(DataFrame.unionByName, parts)


def key_overlap(relations: dict[str, tuple[DataFrame, Column, DataFrame, Column]]) -> DataFrame:
    """Distinct source keys and how many of them the target knows."""
    parts = []
    for name, (source, source_key, target, target_key) in relations.items():
        s = source.select(source_key.cast("string").alias("id")).distinct()
        t = target.select(target_key.cast("string").alias("id")).distinct().withColumn("hit", F.lit(1))
        parts.append(s.join(t, "id", "left").agg(F.count(F.lit(1)).alias("source_distinct_keys"), F.count("hit").alias("matched_in_target")).withColumn(
            "relationship", F.lit(name)))
    return reduce(DataFrame.unionByName, parts).withColumn("orphaned_keys", F.col("source_distinct_keys") - F.col("matched_in_target"))


def overview(frames: dict[str, DataFrame]) -> DataFrame:
    """Rows, number of columns and column names per table."""
    parts = [d.agg(F.count(F.lit(1)).alias("row_count")).withColumns(
        {"table_name": F.lit(t), "col_count": F.lit(len(d.columns)), "columns": F.lit(", ".join(d.columns))}) for t, d in frames.items()]
    return reduce(DataFrame.unionByName, parts)


def schema_matrix(headers: DataFrame, names: list[str]) -> DataFrame:
    """One row per column name (case ignored), one column per named file or table: its spelling or MISSING. Expects ``file_name, columns``."""
    long = headers.select("file_name", F.explode("columns").alias("spelling")).withColumn("column_name", F.lower("spelling"))
    return long.groupBy("column_name").pivot("file_name", names).agg(F.min("spelling")).fillna("MISSING")
