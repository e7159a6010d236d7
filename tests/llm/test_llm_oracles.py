"""Queries that have SQL against it, on the tables the driver compares."""

from __future__ import annotations

import duckdb
import pytest

from salestide.llm import queries

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in ("documents", "conversations", "embeddings", "pages"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    yield connection
    connection.close()


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_rows_are_those_of_the_sql(spark, duck, name):
    frame = queries.QUERIES[name](spark, FOLDER)
    columns = sorted(frame.columns)
    found = duck.execute(queries.SQL[name])
    assert sorted(d[0] for d in found.description) == columns
    want = duck.execute(f"SELECT {', '.join(columns)} FROM ({queries.SQL[name]})").fetchall()
    assert sorted(map(tuple, frame.select(*columns).collect()), key=str) == sorted(want, key=str)


def test_every_operator_has_a_query():
    assert [n.split("_")[0] for n in queries.QUERIES] == [f"op{n}" for n in range(1, 14)]
