"""Lines that many sites share: boilerplate by distinct-site spread.

For every line hash a HyperLogLog sketch of its sites is built in the tasks and merged by aggregation.
Lines whose estimate is clearly below the threshold stay, lines clearly above go, and the lines near it
get an exact count of distinct sites. Only lines that go are brought back to their documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tallyhouse.llm.bloom import marked
from tallyhouse.session import work_dir

SITES = 12
LG_K = 10
#: Three standard errors of a sketch with 2**LG_K registers.
MARGIN = 3 * 1.04 / 2 ** (LG_K / 2)


def line_key(line: Column) -> Column:
    """128 bits of the line without white space at its ends, runs as one blank; null for a blank line."""
    plain = F.trim(F.regexp_replace(line, r"[\t-\r][ \t-\r]*| [ \t-\r]+", " "))
    return F.when(plain != "", F.struct(F.xxhash64(plain).alias("a"), F.xxhash64(F.lit(1), plain).alias("b")))


def spread(lines: DataFrame, sites: int = SITES) -> DataFrame:
    """``line`` keys that stand on at least ``sites`` distinct sites; ``lines`` has line and site. A null site is no site."""
    pairs = lines.where("line IS NOT NULL AND site IS NOT NULL")
    estimated = pairs.groupBy("line").agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(LG_K))).alias("about"))
    sure = estimated.where(F.col("about") >= sites * (1 + MARGIN) + 1).select("line")
    near = estimated.where((F.col("about") < sites * (1 + MARGIN) + 1) & (F.col("about") >= sites * (1 - MARGIN) - 1)).select("line")
    # distinct pairs first: a line on very many documents is one row per task and site before the join
    counted = pairs.distinct().join(near, "line", "left_semi").groupBy("line").agg(F.count(F.lit(1)).alias("exact"))
    return sure.unionByName(counted.where(F.col("exact") >= sites).select("line"))


def without_boilerplate(docs: DataFrame, sites: int = SITES, text: str = "text", key: str = "doc_id", site: str = "source") -> DataFrame:
    """One row per input row: key, ``lines``, ``removed`` and the rest as ``clean`` (joined by line feeds).

    Lines end at line feeds. Blank lines are never removed, null texts are empty, and a text left without lines is
    empty. Rows repeated with the same key and text are cleaned alike; a null key is a key.
    """
    rows = docs.select(F.col(f"`{key}`").alias("_key"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("_text"), F.col(f"`{site}`").alias("site")).withColumn("_print", F.xxhash64("_text"))
    lines = rows.select("_key", "_print", "site", F.posexplode(F.split("_text", "\n")).alias("at", "_line")).select("_key", "_print", "site", "at", line_key(F.col("_line")).alias("line"))
    folder = work_dir(docs.sparkSession, "lines")  # three steps read the keys, and no step but the last the texts
    lines.where("line IS NOT NULL").write.parquet(f"{folder}/lines")
    lines = docs.sparkSession.read.parquet(f"{folder}/lines")
    bad = spread(lines.select("line", "site"), sites)
    salts = 8  # a line may stand in a third of all documents
    bad = bad.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    found = lines.withColumn("_salt", F.pmod(F.xxhash64("_key", "at"), F.lit(salts)).cast("int")).join(bad.hint("merge"), ["line", "_salt"], "left_semi")
    found.groupBy(F.col("_key").alias("_same"), F.col("_print").alias("_alike")).agg(F.collect_set("at").alias("_gone")).withColumn("_row", F.xxhash64("_same", "_alike")).write.parquet(f"{folder}/gone")
    gone = docs.sparkSession.read.parquet(f"{folder}/gone")
    # texts that lose no line stay where they are
    probed = marked(rows.withColumn("_row", F.xxhash64("_key", "_print")), gone, "_row", "_maybe")
    parts = F.split("_text", "\n")
    hit = probed.where("_maybe").join(gone.drop("_row"), F.col("_key").eqNullSafe(F.col("_same")) & (F.col("_print") == F.col("_alike")), "left")
    kept = F.when(F.col("_gone").isNull(), F.col("_text")).otherwise(F.array_join(F.filter(parts, lambda x, i: ~F.array_contains(F.col("_gone"), i)), "\n"))
    out = lambda removed, clean: [F.col("_key").alias(key), F.size(parts).cast("long").alias("lines"), removed.cast("long").alias("removed"), clean.alias("clean")]
    return hit.select(*out(F.when(F.col("_gone").isNull(), 0).otherwise(F.size("_gone")), kept)).unionByName(probed.where("NOT _maybe").select(*out(F.lit(0), F.col("_text"))))
