"""Writing results: append, replace, clustered layouts, tables in buckets and the run log."""

from __future__ import annotations

import uuid

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.utils import AnalysisException


def append(df: DataFrame, path: str) -> None:
    """Append; new columns are fine, readers merge the layouts (:func:`read_merged`)."""
    df.write.mode("append").parquet(path)


def read_merged(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("mergeSchema", "true").parquet(path)


def replace(df: DataFrame, path: str) -> str:
    """Replace a dataset together with its layout.

    The new content goes to a folder of its own; only then the pointer moves. A failed write
    leaves the old content in force, and the input may be the old content itself.
    """
    spark = df.sparkSession
    version = uuid.uuid4().hex
    df.write.parquet(f"{path}/data-{version}")
    stamp = spark.range(1).select(F.lit(version).alias("version"), F.current_timestamp().alias("at"))
    stamp.write.mode("append").parquet(f"{path}/pointer")
    return version


def read_current(spark: SparkSession, path: str) -> DataFrame:
    current = spark.read.parquet(f"{path}/pointer").agg(F.max_by("version", "at").alias("v")).first()["v"]
    return spark.read.parquet(f"{path}/data-{current}")


def write_clustered(df: DataFrame, path: str, *columns: str, partitions: int | None = None) -> None:
    """Files hold narrow ranges of the given columns, so that filters on them skip files.

    Ranges are cut by sampled quantiles of all columns together; add a unique column last if
    one value alone fills many files.
    """
    args = [partitions, *columns] if partitions else list(columns)
    df.repartitionByRange(*args).sortWithinPartitions(*columns).write.mode("overwrite").parquet(path)


#: Bits of a rank, so ranges per column, in the key of ``write_zordered``.
RANK_BITS = 8


def _ordinal(df: DataFrame, name: str) -> Column:
    """A number that grows with the value: days and seconds of dates, the first six bytes of texts; NULL comes first."""
    kind, c = df.schema[name].dataType.typeName(), F.col(f"`{name}`")
    if kind == "string":
        return F.conv(F.rpad(F.hex(F.substring(c.cast("binary"), 1, 6)), 12, "0"), 16, 10).cast("double")
    if kind == "date":
        return F.unix_date(c).cast("double")
    return c.cast("timestamp").cast("double") if kind in ("timestamp", "timestamp_ntz") else c.cast("double")


def write_zordered(df: DataFrame, path: str, *columns: str, partitions: int | None = None, bits: int = RANK_BITS) -> None:
    """Files hold narrow ranges of each of the given columns, so that a filter on any of them skips files.

    Each column is cut into ``2 ** bits`` ranges that hold about as many rows; the bits of a row's ranks, taken in turn from
    the columns, are its sort key. The cuts of all columns come from one aggregation and are bounded in number; rows are ranked by
    binary search in them, one column at a time. Rows are only moved by the range partitioning of the key.
    """
    p = "_z"
    while any(c.startswith(p) for c in df.columns):
        p += "_"
    plain = df.select("*", *[_ordinal(df, c).alias(f"{p}o{i}") for i, c in enumerate(columns)])
    shares = [(k + 1) / (1 << bits) for k in range((1 << bits) - 1)]
    found = plain.agg(*[F.approx_percentile(f"{p}o{i}", F.lit(shares), F.lit(10_000)).alias(f"c{i}") for i in range(len(columns))]).first()

    def ranks(cuts: list[float]):
        def of(values: pd.Series) -> pd.Series:
            return pd.Series(np.where(values.isna(), 0, np.searchsorted(np.array(cuts), values.to_numpy(dtype=float, na_value=-np.inf), side="left")))

        return F.pandas_udf(of, "long")

    ranked = plain.select("*", *[ranks(sorted(set(found[f"c{i}"] or [])))(F.col(f"{p}o{i}")).alias(f"{p}r{i}") for i in range(len(columns))])
    key = F.lit(0).cast("bigint")
    for b in range(bits):
        for i in range(len(columns)):
            key = key + F.shiftleft(F.shiftright(F.col(f"{p}r{i}"), b).bitwiseAND(F.lit(1)), b * len(columns) + len(columns) - 1 - i)
    keyed = ranked.withColumn(p, key)
    args = [partitions, p] if partitions else [p]
    keyed.repartitionByRange(*args).sortWithinPartitions(p).select(*[F.col(f"`{c}`") for c in df.columns]).write.mode("overwrite").parquet(path)


# --- tables in buckets --------------------------------------------------------------------------


def with_bucket(df: DataFrame, key: str, buckets: int) -> DataFrame:
    return df.withColumn("_bucket", F.pmod(F.xxhash64(F.coalesce(F.col(key).cast("string"), F.lit(""))), F.lit(buckets)).cast("int"))


def read_parquet(spark: SparkSession, path: str) -> DataFrame | None:
    """A folder of Parquet files, if it is there and has any."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def bucket_state(spark: SparkSession, path: str) -> tuple[int, dict[int, int], set[str]]:
    """Newest version, folder of each bucket, and the batches that went into it; (0, none, none) before the first."""
    lists = read_parquet(spark, f"{path}/list")
    if lists is None:
        return 0, {}, set()
    version = lists.agg(F.max("version")).first()[0]
    batches = {r[0] for r in lists.where("batch IS NOT NULL").select("batch").distinct().collect()}
    return version, {r.bucket: r.folder for r in lists.where(F.col("version") == version).collect() if r.bucket >= 0}, batches


def read_buckets(spark: SparkSession, path: str, only: list[int] | None = None) -> DataFrame | None:
    """The rows of all (or ``only`` some) buckets with their ``_bucket``; None if there are none."""
    folders = {b: v for b, v in bucket_state(spark, path)[1].items() if only is None or b in only}
    if not folders:
        return None
    return spark.read.option("basePath", path).parquet(*[f"{path}/version={v}/_part={b}" for b, v in sorted(folders.items())]).drop("version", "_part")


def replace_buckets(rows: DataFrame, path: str, touched: list[int] | None = None, batch: str | None = None) -> DataFrame | None:
    """Write ``rows`` (with ``_bucket``) as the new content of the touched buckets, or of all; others stay where they are.

    A version is a folder per bucket and, written last, a list of (bucket, folder): until then, and after a failure, readers
    see the version before. Returns the rows as written, None without any.
    """
    spark = rows.sparkSession
    version, folders, _ = bucket_state(spark, path)
    target = f"{path}/version={version + 1}"
    rows.withColumn("_part", F.col("_bucket")).repartition("_part").write.mode("overwrite").partitionBy("_part").parquet(target)
    parts = read_parquet(spark, target)
    written = [r[0] for r in parts.select("_bucket").distinct().collect()] if parts is not None else []
    folders = {b: v for b, v in folders.items() if touched is not None and b not in touched} | dict.fromkeys(written, version + 1)
    listed = [(b, v, batch) for b, v in sorted(folders.items())] or [(-1, version + 1, batch)]
    spark.createDataFrame(listed, "bucket int, folder int, batch string").coalesce(1).write.mode("overwrite").parquet(f"{path}/list/version={version + 1}")
    return parts


RUN_LOG = "notebook string, run_timestamp timestamp, records_processed bigint, records_flagged bigint, llm_calls_made bigint, outputs_flagged bigint, status string, notes string"


def log_run(
    spark: SparkSession, path: str, notebook: str, processed: int, flagged: int = 0, calls: int = 0, review: int = 0, notes: str = "", at: Column | None = None
) -> None:
    """Append one line to the run log; pass counts taken from an ``Observation``."""
    row = spark.createDataFrame(
        [(notebook, None, processed, flagged, calls, review, "SUCCESS" if review == 0 else "PARTIAL_REVIEW", notes)], RUN_LOG)
    append(row.withColumn("run_timestamp", at if at is not None else F.current_timestamp()), path)


def last_runs(log: DataFrame, k: int = 8) -> DataFrame:
    """The latest runs; a top-k report."""
    return log.orderBy(F.col("run_timestamp").desc(), "notebook").limit(k)


def exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.parquet(path).schema
    except AnalysisException:
        return False
    return True
