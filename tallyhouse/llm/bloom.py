"""A blocked Bloom filter as a table, built and read with DataFrame functions.

The filter is a table of blocks of eight 32-bit words. A value's hash picks one block and one bit in each
of its words, so a lookup reads one row. Its size has a fixed upper bound, hence it may be broadcast; with more
values than it is made for, more of the others pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

BITS = 12
MAX_BLOCKS = 1 << 16
WORDS = 8


def bloom(listed: DataFrame, column: str) -> tuple[DataFrame, int]:
    """The filter as a table ``_block, _w0 .. _w7`` and its number of blocks, at most ``MAX_BLOCKS``."""
    blocks = min(MAX_BLOCKS, max(1, -(-listed.count() * BITS // (32 * WORDS))))
    rows = listed.select(_block(F.col(column), blocks).alias("_block"), *[m.alias(f"_w{i}") for i, m in enumerate(_bits(F.col(column)))])
    return rows.groupBy("_block").agg(*[F.bit_or(f"_w{i}").alias(f"_w{i}") for i in range(WORDS)]), blocks


def _block(c: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(c), F.lit(blocks)).cast("int")


def _bits(c: Column) -> list[Column]:
    """One bit of each word, from five bits each of a second hash."""
    second = F.xxhash64(F.lit("bits"), c)
    return [F.call_function("shiftleft", F.lit(1), F.shiftright(second, 5 * i).bitwiseAND(F.lit(31)).cast("int")) for i in range(WORDS)]


def marked(rows: DataFrame, listed: DataFrame, column: str, name: str) -> DataFrame:
    """``rows`` with a flag: false if the column's value is surely not in ``listed``. A null is in no list."""
    blocks, n = bloom(listed, column)
    columns = [F.col(f"`{c}`") for c in rows.columns]
    probed = rows.select(*columns, _block(F.col(column), n).alias("_block"), *[m.alias(f"_m{i}") for i, m in enumerate(_bits(F.col(column)))]).join(F.broadcast(blocks), "_block", "left")
    maybe = F.col(column).isNotNull()
    for i in range(WORDS):
        maybe = maybe & F.coalesce(F.col(f"_w{i}").bitwiseAND(F.col(f"_m{i}")) != 0, F.lit(False))
    return probed.select(*columns, maybe.alias(name))


def possible(rows: DataFrame, listed: DataFrame, column: str) -> DataFrame:
    """The rows whose value may be in ``listed``."""
    return marked(rows, listed, column, "_maybe").where("_maybe").drop("_maybe")
