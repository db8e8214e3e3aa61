import os

import duckdb
import pytest

from anemora.llm.queries import QUERIES, SQL

FOLDER = "/root/testdata/sf0.001"


def _plain(rows):
    return sorted((tuple(r) for r in rows), key=str)


@pytest.mark.parametrize("name", sorted(SQL))
def test_against_sql(spark, name):
    connection = duckdb.connect()
    for f in os.listdir(FOLDER):
        connection.sql(f"CREATE VIEW {f[:-8]} AS SELECT * FROM '{FOLDER}/{f}'")
    got, want = QUERIES[name](spark, FOLDER), connection.sql(SQL[name])
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    assert _plain(got.select(*columns).collect()) == _plain(want.select(", ".join(columns)).fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_rows(spark, name):
    got = QUERIES[name](spark, FOLDER)
    source = "pages" if name.startswith("op2_") else "embeddings" if name.startswith(("op6_", "op7_")) else "documents"
    rows = spark.read.parquet(f"{FOLDER}/{source}.parquet")
    if name.startswith("op7_"):
        assert got.count() == 5 * rows.where("vec_id % 50 = 0").count()
    elif name.startswith("op11_"):
        per_item = got.groupBy("item_id").agg({"rank": "max", "*": "count"}).collect()
        assert per_item and all(r["max(rank)"] == r["count(1)"] <= 50 for r in per_item)
    else:
        assert got.count() == rows.count()
