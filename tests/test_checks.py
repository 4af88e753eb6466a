"""Registered queries against their check SQL on the smallest tables.

The headline queries and everything that writes files run by default; ``TEST_ALL=1`` runs all
of them, as ``tools_check.py`` does on larger tables.
"""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from bench import HEADLINE
from tools_check import TABLES, normal

QUERIES, CHECKS = entry.queries(), entry.oracle_sql()
WANTED = sorted(n for n in QUERIES if os.environ.get("TEST_ALL") or n in HEADLINE or n.startswith(("src_", "snk_", "str_")))


@pytest.fixture(scope="module")
def con(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", WANTED)
def test_query(name, spark, sf_dir, con):
    got = QUERIES[name](spark, sf_dir).toPandas()
    if name not in CHECKS:
        assert len(got.columns) and len(got) > 0
        return
    want = con.execute(CHECKS[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    a, b = normal(got), normal(want)
    assert len(a) == len(b)
    assert a.equals(b)


def test_every_check_has_a_query():
    assert set(CHECKS) <= set(QUERIES)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
