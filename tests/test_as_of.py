"""Price versions against a plain search, with pieces so short that versions are carried over many of them."""

import datetime as dt
import random
import re

import pytest

from tallyhouse.operators import marts


def plain(rows, versions):
    out = []
    for key, at, note in rows:
        valid = [v for v in versions if v[0] == key and v[2] is not None and at is not None and v[2] <= at]
        best = max(valid, key=lambda v: (v[2], v[4]), default=None)
        out.append((key, at, note, *(best[1:] if best else (None,) * 4)))
    return sorted(out, key=str)


@pytest.mark.parametrize("days", [1, 7, 4000])
def test_against_a_search(spark, days):
    r = random.Random(days)
    start = dt.datetime(2020, 1, 1)
    time = lambda: start + dt.timedelta(hours=r.randint(0, 24 * 90))
    versions = [(r.choice([1, 2, 3, None]), float(i), None if i % 29 == 0 else time(), None, i) for i in range(150)]
    versions += [(9, 1.0, start, start, 500), (9, 2.0, start, None, 501), (8, 5.0, start + dt.timedelta(days=400), None, 600)]
    rows = [(r.choice([1, 2, 3, 7, 9, None]), time(), f"n{i}") for i in range(300)]
    rows += [(1, None, "no time"), (9, start, "at the start"), (9, start - dt.timedelta(seconds=1), "before"), (2, start + dt.timedelta(days=3000), "late"), (2, start + dt.timedelta(days=3000), "late")]
    rows += [(v[0], v[2], "at a version") for v in versions if v[2]][:40]
    # a column of the caller may be named like one of the versions' columns
    history = spark.createDataFrame(versions, "k int, base_unit_price double, valid_from timestamp_ntz, valid_to timestamp_ntz, version_rank int")
    lookups = spark.createDataFrame(rows, "k int, order_purchase_timestamp timestamp_ntz, valid_from string")
    got = marts.price_as_of(lookups, history, keys=("k",), days=days)
    assert sorted((tuple(x) for x in got.collect()), key=str) == plain(rows, versions)


def test_a_long_history_is_sorted_in_pieces(spark):
    """Many versions of one key: windows run over (key, piece), and across pieces over one row for each."""
    history = spark.range(5000).selectExpr("1 AS k", "CAST(id AS DOUBLE) AS base_unit_price", "TIMESTAMP_NTZ '2020-01-01 00:00:00' + id * INTERVAL 1 HOUR AS valid_from", "CAST(NULL AS TIMESTAMP_NTZ) AS valid_to", "CAST(id AS INT) AS version_rank")
    lookups = history.selectExpr("k", "valid_from + INTERVAL 30 MINUTE AS order_purchase_timestamp", "version_rank AS want")
    got = marts.price_as_of(lookups, history, keys=("k",), days=5)
    assert got.where("want <> price_version OR price_version IS NULL").count() == 0 and got.count() == 5000
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_empty(spark):
    history = spark.createDataFrame([], "product_id int, vendor_id int, base_unit_price double, valid_from timestamp_ntz, valid_to timestamp_ntz, version_rank int")
    lookups = spark.createDataFrame([(1, 2, dt.datetime(2020, 1, 1))], "product_id int, vendor_id int, order_purchase_timestamp timestamp_ntz")
    assert [tuple(r)[3:] for r in marts.price_as_of(lookups, history).collect()] == [(None,) * 4]
    assert marts.price_as_of(lookups.limit(0), history).count() == 0


def test_versions_and_lookups_move_once(spark):
    """Every version and lookup is shuffled once; beyond that only one row of each piece, and one of each day, moves."""
    orders = spark.range(2000).selectExpr("id AS order_id", "TIMESTAMP_NTZ '2020-01-01 00:00:00' + (id % 300) * INTERVAL 1 DAY AS order_purchase_timestamp")
    lines = spark.range(6000).selectExpr("id % 2000 AS order_id", "id % 7 AS product_id", "id % 3 AS vendor_id", "CAST(100 + id % 90 AS DECIMAL(10,2)) AS sales", "1 AS quantity", "CAST(0 AS DECIMAL(4,2)) AS discount")
    moves = lambda df: len(re.findall(r"(?<!Reused)Exchange hashpartitioning", df.collect() and df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]))
    history = marts.price_history(lines, orders)
    # lines and orders by order, prices, versions by day, days by product, back to the versions
    assert moves(history) <= 6
    versions = spark.createDataFrame(history.collect(), history.schema)
    lookups = lines.limit(6000).withColumn("order_purchase_timestamp", versions.agg({"valid_from": "max"}).scalar())
    assert moves(marts.price_as_of(lookups, versions)) <= 3
