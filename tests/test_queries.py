"""Every registered query against its SQL on the smallest tables."""

import math
import os

import duckdb
import pytest
from conftest import SF

from anemora.plans import load_queries

QUERIES, SQL = load_queries()
TABLES = [f[:-8] for f in os.listdir(SF) if f.endswith(".parquet")]


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value
    return value


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, oracle, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = [tuple(_plain(r[c]) for c in columns) for r in df.collect()]
    if name not in SQL:
        assert got
        return
    relation = oracle.sql(SQL[name])
    assert sorted(relation.columns) == columns
    index = [relation.columns.index(c) for c in columns]
    want = [tuple(_plain(r[i]) for i in index) for r in relation.fetchall()]
    order = lambda r: tuple((v is None, str(v)) for v in r)
    assert sorted(got, key=order) == sorted(want, key=order)


def test_resource_summary_builds_no_bootstrap(spark, monkeypatch):
    """The summary of nodes does not read the bootstrap, parts of which run where it is built."""
    from anemora.operators import bootstrap

    def fail(*args, **options):
        raise AssertionError("built")

    monkeypatch.setattr(bootstrap, "bootstrap_summary", fail)
    assert QUERIES["resource_summary"](spark, SF).columns
