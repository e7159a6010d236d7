"""Plans as they should be at scale: what is read, what is shuffled, and hot keys."""

from __future__ import annotations

import re
from contextlib import contextmanager
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from salestide.operators.customers import customer_totals
from salestide.operators.products import sales_by_attribute
from salestide.plans import cumulative, performance, reports, segments, shares, trends
from salestide.sources import schema
from salestide.sources.csv_load import write_table
from salestide.sources.star import open_star

LINES = 120_000


@contextmanager
def settings(spark, **values):
    kept = {name: spark.conf.get(name, None) for name in values}
    for name, value in values.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in kept.items():
            spark.conf.set(name, value) if value is not None else spark.conf.unset(name)


def _sales(spark):
    """A third of all lines belong to one customer, one product and one date."""
    n = F.col("id")
    hot = n % 3 == 0
    rows = spark.range(0, LINES, numPartitions=8).select(
        F.concat(F.lit("SO"), (n / 2).cast("int")).alias("order_number"),
        F.when(hot, 1).otherwise(n % 500).cast("int").alias("product_key"),
        F.when(hot, 1).otherwise(n % 3000).cast("int").alias("customer_key"),
        F.when(hot, F.lit("2020-07-01").cast("date"))
        .otherwise(F.date_add(F.lit("2018-01-01").cast("date"), (n % 1500).cast("int")))
        .alias("order_date"),
        F.lit(None).cast("date").alias("shipping_date"),
        F.lit(None).cast("date").alias("due_date"),
        (n % 1000).cast(schema.MONEY).alias("sales_amount"),
        (n % 7).cast("int").alias("quantity"),
        (n % 90).cast(schema.MONEY).alias("price"),
    )
    return rows


@pytest.fixture(scope="module")
def star(spark, tmp_path_factory):
    warehouse = str(tmp_path_factory.mktemp("warehouse"))
    key = F.col("id").cast("int")

    def dimension(columns, count, **values):
        return spark.range(count).select(
            *[values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.stored(columns).fields]
        )

    people = dimension(
        schema.CUSTOMERS, 2000, customer_key=key, customer_number=key, first_name=F.lit("A"),
        last_name=F.lit("B"), birthdate=F.lit("1980-01-01"),
    )
    goods = dimension(schema.PRODUCTS, 400, product_key=key, product_name=key % 50, category=key % 5, cost=key)
    write_table(people, warehouse, "dim_customers")
    write_table(goods, warehouse, "dim_products")
    write_table(_sales(spark), warehouse, "fact_sales")
    return open_star(spark, warehouse)


def _plan(frame) -> str:
    """The plan before adaptive execution."""
    return frame._jdf.queryExecution().executedPlan().toString()


def _final_plan(frame) -> str:
    frame.collect()
    return _plan(frame).split("Initial Plan")[0]


def _count(pattern: str, text: str) -> int:
    return len(re.findall(pattern, text))


def _read_columns(plan: str) -> list[set[str]]:
    return [set(re.findall(r"(\w+):", found)) for found in re.findall(r"ReadSchema: struct<([^>]*)>", plan)]


def test_scans_read_only_what_is_needed(star):
    plan = _plan(trends.yearly(star.sales))
    assert _read_columns(plan) == [{"customer_key", "order_date", "sales_amount", "quantity"}]
    assert "PushedFilters: [IsNotNull(order_date)]" in plan
    assert _read_columns(_plan(cumulative.running_by_month(star.sales))) == [{"order_date", "sales_amount"}]
    assert _read_columns(_plan(segments.customer_labels(star.sales, star.customers))) == [
        {"customer_key", "order_date", "sales_amount"},
        {"customer_key"},
    ]
    assert {"product_key", "category"} in _read_columns(_plan(shares.by_category(star.sales, star.products)))


@pytest.mark.parametrize(
    "analysis",
    [cumulative.running_by_month, cumulative.running_by_year, cumulative.running_with_mean_price],
)
def test_single_task_windows_sit_on_grouped_rows(star, analysis):
    lines = _plan(analysis(star.sales)).splitlines()
    single = next(i for i, text in enumerate(lines) if "Exchange SinglePartition" in text)
    below = [text for text in lines[single + 1 :] if "Project" not in text]
    assert "HashAggregate" in below[0]
    assert "Exchange hashpartitioning" in below[1]
    assert "rangepartitioning" not in " ".join(lines)


def test_distinct_customers_are_spread_and_combined_before_the_shuffle(star):
    plan = _plan(trends.yearly(star.sales))
    assert "Expand" not in plan
    first = plan[plan.rindex("Exchange hashpartitioning") :]
    assert re.match(r"Exchange hashpartitioning\(_groupingexpression#\d+, customer_key", first)
    assert "partial_sum" in first.splitlines()[1]


def test_year_on_year_has_one_window_of_each_kind_and_one_window_sort(star):
    plan = _plan(performance.year_on_year(star.sales, star.products))
    assert _count(r"lag\(", plan) == 1
    assert _count(r"Window \[sum\(", plan) == 1
    assert _count(r"Sort \[product_name#\d+ ASC NULLS FIRST", plan) == 1
    # One shuffle by name serves the windows and the final order.
    assert _count(r"Exchange \w+partitioning\(product_name#\d+", plan) == 1
    assert _count("Exchange rangepartitioning", plan) == 1


def test_grand_total_reuses_the_grouped_shuffle(star):
    frame = shares.by_category(star.sales, star.products)
    frame.collect()
    plan = _plan(frame)
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert "ReusedExchange" in plan


def test_product_tables_meet_sums_and_not_lines(spark, star):
    with settings(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        plan = _plan(sales_by_attribute(star.sales, star.products, "product_name"))
        assert "SortMergeJoin" in plan
        assert _count("partial_sum", plan[plan.index("Join") :]) >= 1
    small = _plan(sales_by_attribute(star.sales, star.products, "product_name"))
    assert "BroadcastHashJoin" in small


def test_report_groups_twice_without_expanding_lines(star):
    plan = _plan(customer_totals(star.sales, star.customers, "2024-01-01"))
    assert "Expand" not in plan
    # Lines are combined per customer and order, or product, before anything else.
    assert _count(r"Exchange hashpartitioning\(_key#\d+, order_number", plan) == 1
    assert _count(r"Exchange hashpartitioning\(_key#\d+, product_key", plan) == 1
    for below in re.split(r"Exchange hashpartitioning\(_key#\d+, (?:order_number|product_key)", plan)[1:]:
        assert below.split("FileScan")[0].count("Join") == 0
    # Grouping by profile adds no shuffle to the one per customer.
    assert "customer_name" not in " ".join(re.findall(r"Exchange hashpartitioning\([^)]*\)", plan))


def test_top_customers_does_not_sort_everything(star):
    plan = _plan(reports.top_customers(reports.report(star.sales, star.customers, "2024-01-01"), 20))
    assert "TakeOrderedAndProject" in plan
    assert "rangepartitioning" not in plan


def test_a_hot_date_is_sorted_by_several_tasks(spark):
    rows = trends.order_lines(_sales(spark))
    with settings(
        spark, **{"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "8"}
    ):
        # Found by mapping each task's output, as another shuffle would mix the rows.
        per_task = rows.rdd.mapPartitions(lambda found: [sum(1 for _ in found)]).collect()
        in_order = [r.order_date for r in rows.collect()]
    assert sum(per_task) == LINES
    assert max(per_task) < LINES / 5
    assert in_order == sorted(in_order)


SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4096",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4096",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.mark.parametrize("hot", ["known", "missing"])
def test_joins_of_a_hot_customer_are_split(spark, star, hot):
    key = "customer_key"
    lines = star.sales.withColumn(key, F.nullif(key, F.lit(1))) if hot == "missing" else star.sales
    with settings(spark, **SKEW):
        base = _final_plan(reports.base(lines, star.customers, "2024-01-01"))
        totals = _final_plan(customer_totals(lines, star.customers, "2024-01-01"))
    assert "SortMergeJoin(skew=true)" in base
    # The orders of the customer are many; the products, once combined, are not.
    assert _count(r"SortMergeJoin\(skew=true\)", totals) == 1


def test_results_do_not_depend_on_the_join_strategy(spark, star):
    def everything():
        frames = [
            reports.report(star.sales, star.customers, "2024-01-01"),
            segments.customer_detail(star.sales, star.customers),
            performance.year_on_year(star.sales, star.products),
        ]
        return [sorted(map(tuple, frame.collect()), key=str) for frame in frames]

    expected = everything()
    with settings(spark, **SKEW):
        assert everything() == expected


def test_a_hot_year_is_written_by_several_tasks(spark, tmp_path):
    hot = F.lit("2020-07-01").cast("date")
    rows = _sales(spark).withColumn("order_date", F.when(F.col("quantity") < 6, hot).otherwise(F.col("order_date")))
    with settings(spark, **{"spark.sql.adaptive.advisoryPartitionSizeInBytes": "200000"}):
        write_table(rows, str(tmp_path), "fact_sales")
    files = {
        folder.name: len(list(folder.glob("*.parquet"))) for folder in Path(tmp_path, "fact_sales").glob("order_year=*")
    }
    assert files["order_year=2020"] > 1
    assert files["order_year=2018"] == 1
    assert spark.read.parquet(f"{tmp_path}/fact_sales").count() == LINES
