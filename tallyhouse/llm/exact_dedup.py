"""Exact duplicates by content sort, with DataFrame functions only.

The normalised texts are range-partitioned by splitters that Spark samples (a text's beginning, then its
fingerprint), each range is sorted externally, and the window reads the sorted rows one after another and compares each whole key
with its predecessor's; the first row of a run of equals has the smallest identifier.

A run may not span tasks, so a text that many rows share would fill one range. Such texts are found
by a map-side combined count of fingerprints and get a salt as a further sort key: their runs are
sorted in pieces, and the pieces take the smallest identifier and the size of the whole group from
an aggregation over full texts that sends one row per task. Fingerprints only decide order and
what is salted, so a collision of them costs balance and never a wrong answer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

SPACES = r"[\t-\r][ \t-\r]*| [ \t-\r]+"
HOT_SHARE = 2
LEAD = 48


def normalised(text: Column) -> Column:
    """The text with each run of white space as one space; null is empty. Single spaces need no replacement."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, " ")


def exact_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per input row: key, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Null texts are empty texts. Of rows repeated with the same key and text exactly one is kept. A null key
    sorts first and is kept only if all of its group's keys are null; ``keep_id`` is then null. An
    empty table gives no rows.

    Of the texts only those that more than one ``2 * partitions``-th of all rows share are salted, so
    there are at most ``2 * partitions`` of them; that bounds the two broadcast tables.
    """
    decided, keep, kept = _decided(docs, text, key, F.lit(None))
    return decided.select(F.col("_id").alias(key), keep.alias("keep_id"), F.coalesce("_all", "_size").alias("group_size"), kept.alias("kept"), "text_sha256")


def first_copies(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The rows that ``exact_duplicates`` keeps, with all columns of ``docs`` as they are, whatever their names."""
    decided, _, kept = _decided(docs, text, key, F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)]))
    return decided.where(kept).select(*[F.col(f"_row.c{i}").alias(c) for i, c in enumerate(docs.columns)])


def _decided(docs: DataFrame, text: str, key: str, row: Column) -> tuple[DataFrame, Column, Column]:
    """Rows with ``_id``, ``_row`` and what decides; the key that stays and whether it is this row."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    limit = max(16, docs.count() // (HOT_SHARE * parts))
    base = docs.select(F.col(f"`{key}`").alias("_id"), normalised(F.col(f"`{text}`")).alias("_text"), row.alias("_row"))
    print_ = F.xxhash64("_text")
    narrow = base.select("_id", "_text")
    hot = narrow.select(print_.alias("_print")).groupBy("_print").count().filter(F.col("count") > limit)
    hot = hot.select("_print", F.ceil(F.col("count") / F.lit(limit)).cast("int").alias("_pieces"))
    whole = narrow.withColumn("_print", print_).join(F.broadcast(hot), "_print", "left_semi").groupBy("_text").agg(F.min("_id").alias("_least"), F.count(F.lit(1)).alias("_all"))
    whole = whole.select(F.sha2("_text", 256).alias("text_sha256"), "_least", "_all")
    salted = base.withColumn("_print", print_).join(F.broadcast(hot), "_print", "left").withColumn("_salt", F.when(F.col("_pieces").isNotNull(), F.pmod(F.xxhash64("_id"), F.col("_pieces"))).otherwise(0).cast("int"))
    # splitters go through the driver, so they are the text's beginning and its fingerprint, not whole texts
    ranged = salted.select("_text", "_print", "_salt", "_id", "_row", F.substring("_text", 1, LEAD).alias("_lead")).repartitionByRange(parts, "_lead", "_print", "_salt")
    run = Window.partitionBy("_lead", "_print", "_salt", "_text")
    ordered = run.orderBy(F.col("_id").asc_nulls_last())
    marked = ranged.select("_id", "_row", F.sha2("_text", 256).alias("text_sha256"), F.row_number().over(ordered).alias("_nth"), F.first("_id").over(ordered).alias("_first"), F.count(F.lit(1)).over(run).alias("_size"))
    joined = marked.join(F.broadcast(whole), "text_sha256", "left")
    keep = F.when(F.col("_all").isNotNull(), F.col("_least")).otherwise(F.col("_first"))
    kept = (F.col("_nth") == 1) & (F.col("_id").eqNullSafe(keep) & (F.col("_all").isNull() | F.col("_first").eqNullSafe(keep)))
    return joined, keep, kept
