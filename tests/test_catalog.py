"""Registered queries against their SQL twins at the smallest scale; jobs and fitted models have tests of their own."""

from __future__ import annotations

import math
import os

import pytest

import __spark_entry__ as driver

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
SLOW = ("boosted_", "density_", "prepare", "create_time_split", "regress_", "train", "config_round_trip")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "", ""
    if isinstance(value, bool):
        return "b", str(value)
    if isinstance(value, (int, float)):
        return "n", round(float(value), 5)
    return "s", str(value)


def test_twins_belong_to_queries():
    assert set(driver.oracle_sql()) <= set(driver.queries())


def test_entry_has_rows(spark):
    assert not driver.entry(spark).isEmpty()


@pytest.mark.parametrize("name", [n for n in driver.oracle_sql() if not n.startswith(SLOW)])
def test_query_equals_its_twin(spark, duck, name):
    ours = driver.queries()[name](spark, SF)
    theirs = duck.sql(driver.oracle_sql()[name])
    assert sorted(ours.columns) == sorted(theirs.columns)
    order = sorted(ours.columns)
    got = sorted(tuple(plain(r[c]) for c in order) for r in ours.collect())
    place = [theirs.columns.index(c) for c in order]
    want = sorted(tuple(plain(r[i]) for i in place) for r in theirs.fetchall())
    assert len(got) == len(want)
    for a, b in zip(got, want):
        for (kind, x), (other, y) in zip(a, b):
            assert kind == other and (x == y or (kind == "n" and math.isclose(x, y, rel_tol=1e-6, abs_tol=2e-5)))
