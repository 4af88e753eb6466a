"""Connected components of an edge table, by alternating stars.

Each round hangs the neighbours of every node under the least of them, first the larger ones, then the smaller. The
edges are written to the shared folder after each round, so a lost executor repeats one round and lineage stays short.
No neighbourhood is gathered: a round is one minimum per node and one join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallyhouse.session import work_dir

#: Rows that a file of small results should hold, and how many tasks write at least.
ROWS_PER_FILE, LEAST_FILES = 50_000, 2


def files(rows: int) -> int:
    """How many tasks write so many small rows: few for few, so that rounds don't leave a tiny file for each shuffle partition; it grows with the rows."""
    return LEAST_FILES + rows // ROWS_PER_FILE


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of an edge (a, b); the component is its least node. Loops and repeats do nothing."""
    spark, folder = edges.sparkSession, work_dir(edges.sparkSession, "components")

    def saved(e: DataFrame, name: str, rows: int) -> tuple[DataFrame, tuple]:
        e.coalesce(files(rows)).write.parquet(f"{folder}/{name}")
        got = spark.read.parquet(f"{folder}/{name}")
        return got, tuple(got.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())

    current, mark = saved(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "0", edges.count())
    turn = 0
    while mark[0]:
        turn += 1
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(down, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").unionByName(down.select("a", F.col("m").alias("b"))).distinct()
        current, new = saved(small, str(turn), mark[0])
        if new == mark:
            break
        mark = new
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
