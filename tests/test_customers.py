from __future__ import annotations

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from salestide.operators.customers import ATTRIBUTES, customer_totals, dated_lines
from salestide.plans import reports, segments
from salestide.plans.catalog import ANALYSES, Options
from salestide.sources.star import Star
from tests.conftest import line

D = Decimal
AS_OF = "2024-06-30"


def _rows(frame):
    return [tuple(row) for row in frame.collect()]


def _by_key(frame):
    return {row.customer_key: row for row in frame.collect()}


def _customers(tables):
    return tables.customers(
        {"customer_key": 1, "customer_number": "C1", "first_name": "Ann", "last_name": "Lee", "birthdate": "2004-02-29"},
        {"customer_key": 2, "customer_number": "C2", "first_name": None, "last_name": "Poe", "birthdate": None},
        {"customer_key": 3, "customer_number": "C3", "first_name": "Bo", "last_name": "Ray", "birthdate": "1994-07-01"},
        {"customer_key": 4, "customer_number": "C4", "first_name": "Cy", "last_name": "Fox", "birthdate": "1974-06-30"},
        {"customer_key": 5, "customer_number": "C5", "first_name": "Di", "last_name": "Orr", "birthdate": "1990-01-01"},
        {"customer_key": None, "customer_number": "C?", "first_name": "No", "last_name": "Key"},
    )


def _sales(tables):
    return tables.sales(
        # 5000 in 400 days: Regular by days, New by months
        line("A1", 1, "2022-01-01", "2000.00", product=1, quantity=2),
        line("A1", 1, "2022-01-01", "1000.00", product=2, quantity=1),
        line("A2", 1, "2023-02-05", "2000.00", product=1, quantity=2),
        # two orders ten days apart: no whole month of custom
        line("B1", 2, "2024-01-01", "30.00", product=3),
        line("B2", 2, "2024-01-11", "70.01", product=4),
        # no amount at all
        line("C1", 3, "2024-05-01", "0.00", product=None),
        # long-standing and above the limit; an order without a number, an undated line
        line("D1", 4, "2020-01-31", "6000.00", product=5),
        line(None, 4, "2024-02-29", "1.00", product=5),
        line("D3", 4, None, "500.00", product=6),
        # only undated lines
        line("E1", 5, None, "10.00"),
        line("E2", 5, None, "20.00"),
        # unknown customers share an order and a product; one line has no customer key
        line("X1", 77, "2023-01-01", "1.00", product=1),
        line("X1", 88, "2023-03-01", "2.00", product=1),
        line("X2", 88, "2024-03-01", "3.00", product=2),
        line("X3", None, "2023-06-01", "4.00", product=9),
    )


def test_spending_counts_undated_lines_and_joins_unknown_customers(tables):
    rows = _by_key(segments.customer_spending(_sales(tables), _customers(tables)))
    assert set(rows) == {1, 2, 3, 4, 5, None}
    assert tuple(rows[4]) == (4, D("6501.00"), dt.date(2020, 1, 31), dt.date(2024, 2, 29), 1490)
    assert tuple(rows[5]) == (5, D("30.00"), None, None, None)
    assert tuple(rows[None]) == (None, D("10.00"), dt.date(2023, 1, 1), dt.date(2024, 3, 1), 425)


def test_segments_by_days(tables):
    sales, customers = _sales(tables), _customers(tables)
    detail = _by_key(segments.customer_detail(sales, customers))
    assert {k: r.customer_seg for k, r in detail.items()} == {
        1: "Regular",
        2: "New",
        3: "New",
        4: "VIP",
        5: "New",
        None: "Regular",
    }
    assert detail[1].life_span == 400
    labels = segments.customer_labels(sales, customers)
    assert sorted(_rows(labels), key=str) == sorted([(k, r.customer_seg) for k, r in detail.items()], key=str)
    # The group of unknown customers has a label but does not count as a customer.
    assert _rows(segments.customer_counts(sales, customers)) == [("New", 3), ("Regular", 1), ("VIP", 1)]


def test_report_base(tables):
    rows = reports.base(_sales(tables), _customers(tables), AS_OF)
    assert rows.columns == [
        "order_number", "product_key", "order_date", "sales_amount", "quantity",
        "customer_key", "customer_number", "customer_name", "age",
    ]
    people = {(r.customer_key, r.customer_name, r.age) for r in rows.collect()}
    assert people == {
        (1, "Ann Lee", 20),
        (2, " Poe", None),
        (3, "Bo Ray", 29),
        (4, "Cy Fox", 50),
        (None, " ", None),
    }
    assert rows.count() == 12


def test_report(tables):
    rows = _by_key(reports.report(_sales(tables), _customers(tables), AS_OF))
    assert tuple(rows[1]) == (
        1, "C1", "Ann Lee", 20, "20-29", "New", 16, D("2500.00"), D("384.62"), 2, D(5000), 5, 2, dt.date(2023, 2, 5), 13,
    )
    assert tuple(rows[2]) == (
        2, "C2", " Poe", None, "50 and above", "New", 5, D("50.01"), D("100.01"), 2, D("100.01"), 2, 2, dt.date(2024, 1, 11), 0,
    )
    assert tuple(rows[3])[7:] == (D(0), D(0), 1, D(0), 1, 0, dt.date(2024, 5, 1), 0)
    assert tuple(rows[4]) == (
        4, "C4", "Cy Fox", 50, "50 and above", "VIP", 4, D("6001.00"), D("125.02"), 1, D(6001), 2, 1, dt.date(2024, 2, 29), 48,
    )
    assert 5 not in rows
    # Orders and products of unknown customers count once for the whole group.
    assert tuple(rows[None]) == (
        None, None, " ", None, "50 and above", "Regular", 3, D("3.33"), D("0.71"), 3, D(10), 4, 3, dt.date(2024, 3, 1), 14,
    )


def test_recency_can_be_negative(tables):
    rows = _by_key(reports.report(_sales(tables), _customers(tables), "2024-01-01"))
    assert rows[3].recency_months == -4


def test_sales_without_any_order_number_divide_by_zero(tables):
    sales = tables.sales(line(None, 1, "2024-01-01", "5.00"))
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO|REMAINDER_BY_ZERO|[Dd]ivi"):
        reports.report(sales, _customers(tables), AS_OF).collect()


def _plain_totals(sales, customers):
    """The totals as one grouping with two distinct counts."""
    return (
        dated_lines(sales, customers, AS_OF)
        .groupBy(*ATTRIBUTES)
        .agg(
            F.count_distinct("order_number").alias("total_orders"),
            F.sum("sales_amount").alias("total_sales"),
            F.sum("quantity").alias("total_quantity"),
            F.count_distinct("product_key").alias("total_products"),
            F.max("order_date").alias("last_order_date"),
        )
    )


def _random_tables(tables, seed):
    """Random lines with NULLs, unknown customers and customers listed more than once."""
    rng = random.Random(seed)

    def maybe(value):
        return None if rng.random() < 0.1 else value

    sales = tables.sales(
        *[
            line(
                maybe(f"O{rng.randrange(60)}"),
                maybe(rng.randrange(12)),
                maybe(f"20{rng.randrange(10, 24)}-0{rng.randrange(1, 10)}-1{rng.randrange(10)}"),
                maybe(f"{rng.randrange(100000) / 100:.2f}"),
                product=maybe(rng.randrange(15)),
                quantity=maybe(rng.randrange(1, 5)),
            )
            for _ in range(600)
        ]
    )
    people = [
        {"customer_key": maybe(k), "customer_number": f"C{k}", "first_name": maybe("A"), "last_name": "B",
         "birthdate": maybe("1980-05-05")}
        for k in (0, 1, 2, 3, 4, 5, 6, 6, 7)
    ]
    return sales, tables.customers(*people, people[0], people[1], people[1])


@pytest.mark.parametrize("seed", range(3))
def test_totals_equal_the_plain_grouping(tables, seed):
    sales, customers = _random_tables(tables, seed)
    ours = customer_totals(sales, customers, AS_OF).drop("lifespan")
    plain = _plain_totals(sales, customers).select(ours.columns)
    assert sorted(_rows(ours), key=str) == sorted(_rows(plain), key=str)


def test_published_report(spark, tables):
    sales, customers = _sales(tables), _customers(tables)
    report = reports.report(sales, customers, AS_OF)
    reports.publish_view(report)
    best = reports.top_customers(spark.table("report_customer"), 2)
    assert [(r.customer_key, r.total_sales) for r in best.collect()] == [(4, D(6001)), (1, D(5000))]
    # Publishing again replaces the view.
    reports.publish_view(report.filter("customer_key = 2"))
    assert [r.customer_key for r in reports.top_customers(spark.table("report_customer")).collect()] == [2]


def test_the_report_is_a_table_that_other_sessions_query(spark, tables):
    sales, customers = _sales(tables), _customers(tables)
    report = reports.report(sales, customers, AS_OF)
    for rows in (report.limit(1), report):
        reports.publish_table(rows, "published.report_customer")
    other = spark.newSession()
    best = other.sql("SELECT * FROM published.report_customer ORDER BY total_sales DESC LIMIT 20")
    assert _rows(best) == _rows(reports.top_customers(report))
    with pytest.raises(Exception):
        reports.publish_table(report.selectExpr("raise_error('no') AS bad"), "published.report_customer")
    assert other.table("published.report_customer").count() == report.count()


@pytest.mark.parametrize("seed", [1, 2])
def test_the_lasting_view_equals_the_report(spark, tables, tmp_path, seed):
    """On random rows with NULLs, unknown and repeated keys, and a current date."""
    sales, customers = _random_tables(tables, seed)
    for name, rows in (("fact_sales", sales), ("dim_customers", customers)):
        rows.write.parquet(f"{tmp_path}/{name}")
    reports.publish_lasting_view(spark, str(tmp_path), f"lasting.random_{seed}", spend_limit=100, tenure_months=3)
    want = reports.report(sales, customers, spend_limit=100, tenure_months=3)
    got = spark.table(f"lasting.random_{seed}")
    assert sorted(_rows(got), key=str) == sorted(_rows(want), key=str)


def test_an_analysis_leaves_the_views_of_the_session_alone(spark, tables):
    star = Star(_sales(tables), _customers(tables), tables.products())
    reports.publish_view(reports.report(star.sales, star.customers, AS_OF).filter("customer_key = 2"))
    assert ANALYSES["report_top_customers"](star, Options(AS_OF, 1, 1, 1)).count() > 1
    assert [r.customer_key for r in spark.table("report_customer").collect()] == [2]


def test_top_customers_breaks_ties_by_key_and_puts_missing_sums_first(spark):
    rows = [(3, D(5)), (None, D(5)), (1, D(5)), (2, None), (4, D(9))]
    ties = spark.createDataFrame(rows, "customer_key int, total_sales decimal(12,2)")
    assert [r.customer_key for r in reports.top_customers(ties, 4).collect()] == [2, 4, 1, 3]
