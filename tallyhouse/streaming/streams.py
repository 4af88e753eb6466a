"""The same operators as incremental streams over files.

Streams stop when all available input is processed (``availableNow``), so a run is a batch
that remembers what it has seen. Static sides are read again for every micro-batch.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyhouse.config import Mapping, Rule
from tallyhouse.operators.harmonize import harmonize_entity
from tallyhouse.operators.quality import drop_violations, quarantine
from tallyhouse.operators.star import fact_orders, fact_returns, fact_sales, odd_ids


def file_stream(spark: SparkSession, folder: str, glob: str, files_per_trigger: int | None = None) -> DataFrame:
    """Parquet files of a folder as a stream; the layout is taken from the files present."""
    schema = spark.read.option("pathGlobFilter", glob).parquet(folder).schema
    reader = spark.readStream.schema(schema).option("pathGlobFilter", glob)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(folder)


def run_append(df: DataFrame, target: str, checkpoint: str) -> None:
    (
        df.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start().awaitTermination()
    )


def run_batches(df: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    (
        df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start().awaitTermination()
    )


def silver_stream(bronze: DataFrame, entity: str, rules: list[Rule], target: str, checkpoint: str, mappings: list[Mapping] | None = None) -> None:
    """Harmonise, drop rows that break a dropping rule, append."""
    run_append(drop_violations(harmonize_entity(bronze, entity, mappings), rules), target, checkpoint)


def silver_with_quarantine(bronze: DataFrame, entity: str, rules: list[Rule], run_id: str, clean: str, rejected: str, checkpoint: str) -> None:
    """Clean rows and quarantine of the same micro-batch, from one harmonised copy of it.

    Both sides write to a folder named by the batch, so a repeated batch replaces itself. The
    harmonised batch is written once and read for both sides.
    """

    def split(batch: DataFrame, batch_id: int) -> None:
        staged = f"{clean}-staged/batch={batch_id}"
        harmonize_entity(batch, entity).write.mode("overwrite").parquet(staged)
        rows = batch.sparkSession.read.parquet(staged)
        drop_violations(rows, rules).write.mode("overwrite").parquet(f"{clean}/batch={batch_id}")
        quarantine(rows, rules, run_id).write.mode("overwrite").parquet(f"{rejected}/batch={batch_id}")

    run_batches(bronze, split, checkpoint)


def fact_orders_stream(orders: DataFrame, target: str, checkpoint: str) -> None:
    run_append(fact_orders(orders), target, checkpoint)


def fact_sales_stream(transactions: DataFrame, orders: DataFrame, customers: DataFrame, products: DataFrame, vendors: DataFrame, target: str, checkpoint: str) -> None:
    """Lines joined to static orders and dimensions, per micro-batch.

    The ids that products and vendors do not have just once are written first. As these are few, Spark joins the lines to them where
    they lie, and lines are shuffled once, by order. Shuffle files go when the write that made them ends, and the random keys are
    written by zstd, which halves them. A batch writes a folder named by it, so a repeated one replaces itself.
    """

    def load(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        # the session of this stream only
        spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
        odd = {}
        for key, dimension in (("product_id", products), ("vendor_id", vendors)):
            path = f"{target}-odd/{key}/batch={batch_id}"
            odd_ids(batch if key in batch.columns else orders, dimension, key).write.mode("overwrite").parquet(path)
            odd[key] = spark.read.parquet(path)
        sold = fact_sales(batch, orders, customers, products, vendors, odd)
        sold.write.mode("overwrite").option("compression", "zstd").parquet(f"{target}/batch={batch_id}")

    run_batches(transactions, load, checkpoint)


def fact_returns_stream(
    returns: DataFrame, orders: DataFrame, transactions: DataFrame, customers: DataFrame, products: DataFrame, vendors: DataFrame, target: str, checkpoint: str
) -> None:
    """Returns matched per micro-batch: matching sorts within an order, which a stream cannot."""

    def match(batch: DataFrame, batch_id: int) -> None:
        fact_returns(batch, orders, transactions, customers, products, vendors).write.mode("overwrite").parquet(f"{target}/batch={batch_id}")

    run_batches(returns, match, checkpoint)
