"""Sales lines summed per calendar period, and running figures over those periods."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql import WindowSpec

from salestide.functions.numbers import round_mean
from salestide.sources.schema import ORDER_YEAR


def dated(sales: DataFrame) -> DataFrame:
    """Lines with an order date; the filter reaches the Parquet scan. Stored sales are
    also filtered by their year, so that the folder of undated lines is not opened."""
    lines = sales.filter(F.col("order_date").isNotNull())
    return lines.filter(F.col(ORDER_YEAR).isNotNull()) if ORDER_YEAR in sales.columns else lines


Columns = dict[str, Column]


def per_period(sales: DataFrame, periods: Columns, measures: Columns) -> DataFrame:
    """One row per period, in no particular order.

    Sums and distinct counts are both combined inside each task before the shuffle.
    For a distinct count Spark first groups by (period, value), so a value that holds
    a large share of the lines is one small row per task by then.
    """
    rows = dated(sales).groupBy(*[c.alias(name) for name, c in periods.items()])
    return rows.agg(*[c.alias(name) for name, c in measures.items()])


def mean_price(sales: DataFrame, period: Column, places: int = 2) -> DataFrame:
    """``order_date`` (the period), ``total_sales`` and the mean line price of the period."""
    sums = per_period(
        sales,
        {"order_date": period},
        {
            "total_sales": F.sum("sales_amount"),
            "price_sum": F.sum("price"),
            "price_count": F.count("price"),
        },
    )
    price = round_mean(F.col("price_sum"), F.col("price_count"), places)
    return sums.select("order_date", "total_sales", price.alias("avg_price"))


def _so_far(reset: Column | None = None) -> WindowSpec:
    """From the first period up to the current one, within ``reset`` if given.

    Without ``reset`` all rows meet in one task. The input must be one row per
    calendar period, so there are at most a few thousand, whatever the sales volume.
    """
    return W.partitionBy(*([] if reset is None else [reset])).orderBy("order_date")


def running_total(
    periods: DataFrame, value: str, name: str, reset: Column | None = None
) -> DataFrame:
    return periods.withColumn(name, F.sum(value).over(_so_far(reset)))


def running_mean(periods: DataFrame, value: str, name: str, places: int) -> DataFrame:
    """Running mean of ``value``, computed from a running sum and count to stay exact."""
    window = _so_far()
    sums = periods.withColumns(
        {"_sum": F.sum(value).over(window), "_count": F.count(value).over(window)}
    )
    mean = round_mean(F.col("_sum"), F.col("_count"), places)
    return sums.withColumn(name, mean).drop("_sum", "_count")
