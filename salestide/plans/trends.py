"""How sales, customers and units change over time. Undated lines are left out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salestide.operators.periods import dated, per_period


def _activity_by(sales: DataFrame, **periods: Column) -> DataFrame:
    """Sales, distinct customers and units per period, in period order."""
    measures = {
        "total_sales": F.sum("sales_amount"),
        "total_customers": F.count_distinct("customer_key"),
        "total_quantity": F.sum("quantity"),
    }
    return per_period(sales, periods, measures).orderBy(*periods)


def order_lines(sales: DataFrame) -> DataFrame:
    """Date and amount of every line, by date.

    A global sort puts equal sort keys into one task. The partition number as last key
    lets one date with a large share of all lines be split over many tasks; it stays
    the same when a lost task is run again.
    """
    lines = dated(sales).select("order_date", "sales_amount")
    return lines.orderBy("order_date", F.spark_partition_id())


def daily(sales: DataFrame) -> DataFrame:
    totals = {"total_sales": F.sum("sales_amount")}
    return per_period(sales, {"order_date": F.col("order_date")}, totals).orderBy("order_date")


def yearly(sales: DataFrame) -> DataFrame:
    return _activity_by(sales, order_year=F.year("order_date"))


def month_of_year(sales: DataFrame) -> DataFrame:
    """Calendar months 1 to 12, all years together."""
    return _activity_by(sales, order_month=F.month("order_date"))


def year_month(sales: DataFrame) -> DataFrame:
    return _activity_by(
        sales, order_year=F.year("order_date"), order_month=F.month("order_date")
    )


def month_start(sales: DataFrame) -> DataFrame:
    return _activity_by(sales, order_month_start=F.trunc("order_date", "month"))
