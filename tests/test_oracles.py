"""Every registered query against its SQL counterpart in DuckDB, row for row."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as contract

FOLDER = "/root/testdata/sf0.01"
# The queries of the text subpackage have tests of their own.
QUERIES = {n: q for n, q in contract.queries().items() if n not in contract.TEXT_QUERIES}
SQL = {n: q for n, q in contract.oracle_sql().items() if n not in contract.TEXT_QUERIES}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in "region nation customer supplier part orders lineitem".split():
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    yield connection
    connection.close()


def _sortable(row):
    return tuple((value is None, "" if value is None else value) for value in row)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, duck, name):
    rows = QUERIES[name](spark, FOLDER)
    columns = sorted(rows.columns)
    ours = [tuple(row[c] for c in columns) for row in rows.collect()]
    result = duck.execute(SQL[name])
    names = [column[0] for column in result.description]
    places = [names.index(c) for c in columns]
    theirs = [tuple(row[i] for i in places) for row in result.fetchall()]
    assert sorted(names) == columns
    assert len(ours) > 0
    assert sorted(ours, key=_sortable) == sorted(theirs, key=_sortable)


def test_entry_is_the_flagship(spark):
    rows = contract.entry(spark)
    assert rows.columns[-1] == "py_change"
    assert rows.count() > 0


def _is_sorted(values) -> bool:
    return all(a <= b for a, b in zip(values, values[1:]))


@pytest.mark.parametrize(
    ("name", "columns", "descending"),
    [
        ("trend_order_lines", ["order_date"], False),
        ("trend_daily", ["order_date"], False),
        ("trend_year_month", ["order_year", "order_month"], False),
        ("seg_product_cost_range_counts", ["total_products"], True),
        ("seg_customer_counts", ["total_customers"], True),
        ("share_by_category", ["total_sales"], True),
        ("report_top_customers", ["total_sales"], True),
    ],
)
def test_results_come_in_order(spark, name, columns, descending):
    rows = QUERIES[name](spark, "/root/testdata/sf0.001").collect()
    keys = [tuple(row[c] for c in columns) for row in rows]
    assert _is_sorted(keys[::-1] if descending else keys)


def test_products_come_by_name_and_year_with_unknown_ones_last(spark):
    rows = QUERIES["perf_yoy"](spark, FOLDER).collect()
    keys = [(r.product_name is None, r.product_name or "", r.order_year) for r in rows]
    assert _is_sorted(keys)
    assert keys[-1][0]


def test_product_keys_are_unique(spark):
    """The price join, left out where no one reads the price, repeats no line."""
    part = spark.read.parquet(f"{FOLDER}/part.parquet").select("p_partkey")
    assert part.count() == part.distinct().count()
