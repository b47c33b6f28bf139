"""Registered queries against their SQL on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from fleetlens.plans import oracles, registry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the driver's tables")


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def test_every_query_has_sql():
    assert set(registry.queries()) == set(oracles.oracle_sql())


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, duck, name):
    got = registry.queries()[name](spark, SF).toArrow().to_pylist()
    cursor = duck.execute(oracles.oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    want = [dict(zip(columns, r)) for r in cursor.fetchall()]
    key = lambda r: tuple(repr(r[c]) for c in sorted(r))
    assert sorted(map(key, got)) == sorted(map(key, want))


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "rolling_28_day_avg_distance_m" in df.columns
