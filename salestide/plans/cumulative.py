"""Running totals and running averages over months and years.

An all-time running total comes out in date order, as one task computes it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salestide.operators.periods import mean_price, per_period, running_mean, running_total


def _sales_by(sales: DataFrame, period: Column, name: str = "order_date") -> DataFrame:
    return per_period(sales, {name: period}, {"total_sales": F.sum("sales_amount")})


def _month() -> Column:
    return F.trunc("order_date", "month")


def _year() -> Column:
    return F.trunc("order_date", "year")


def month_of_year(sales: DataFrame) -> DataFrame:
    return _sales_by(sales, F.month("order_date"), "sales_month").orderBy("sales_month")


def month_totals(sales: DataFrame) -> DataFrame:
    return _sales_by(sales, _month()).orderBy("order_date")


def running_by_month(sales: DataFrame) -> DataFrame:
    return running_total(_sales_by(sales, _month()), "total_sales", "running_total_sales")


def year_to_date(sales: DataFrame) -> DataFrame:
    """Running total by month that starts again each January."""
    months = _sales_by(sales, _month())
    return running_total(
        months, "total_sales", "running_total_sales", reset=F.year("order_date")
    ).orderBy("order_date")


def running_by_year(sales: DataFrame) -> DataFrame:
    return running_total(_sales_by(sales, _year()), "total_sales", "running_total_sale_by_year")


def yearly_mean_price(sales: DataFrame) -> DataFrame:
    prices = mean_price(sales, _year()).withColumnRenamed("total_sales", "total_sum")
    return prices.orderBy("order_date")


def running_with_mean_price(sales: DataFrame) -> DataFrame:
    """Running sales, and the running mean of the yearly mean prices as rounded."""
    totals = running_total(mean_price(sales, _year()), "total_sales", "running_total_sales")
    return running_mean(totals, "avg_price", "running_avg_price", 2).select(
        "order_date", "total_sales", "running_total_sales", "avg_price", "running_avg_price"
    )
