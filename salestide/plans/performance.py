"""Yearly sales of each product against its own mean and its previous year.

Each function adds a step to the one before it. All but the first return rows by product
name and year.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salestide.operators.products import (
    against_mean,
    against_previous,
    with_mean,
    with_previous,
    yearly_product_sales,
)

SALES = ["order_year", "product_name", "current_year_sales"]


def _by_name(sales: DataFrame, products: DataFrame) -> DataFrame:
    """Yearly sales, split by ranges of product names.

    One such shuffle serves the windows, which need each name in one task, and the final
    order. A name has no more rows than there are years.
    """
    yearly = yearly_product_sales(sales, products)
    return yearly.repartitionByRange(F.asc_nulls_last("product_name"))


def _in_order(rows: DataFrame) -> DataFrame:
    return rows.orderBy(F.asc_nulls_last("product_name"), F.asc("order_year"))


def mean(sales: DataFrame, products: DataFrame) -> DataFrame:
    rows = with_mean(_by_name(sales, products))
    return _in_order(rows.select(*SALES, "product_avg_sales"))


def mean_difference(sales: DataFrame, products: DataFrame) -> DataFrame:
    rows = against_mean(with_mean(_by_name(sales, products)))
    return _in_order(rows.select(*SALES, "product_avg_sales", "diff_avg_sales"))


def mean_label(sales: DataFrame, products: DataFrame) -> DataFrame:
    rows = against_mean(with_mean(_by_name(sales, products)))
    return _in_order(rows.select(*SALES, "product_avg_sales", "diff_avg_sales", "avg_change"))


def _compared(sales: DataFrame, products: DataFrame) -> DataFrame:
    return against_mean(with_mean(with_previous(_by_name(sales, products))))


def previous_year(sales: DataFrame, products: DataFrame) -> DataFrame:
    rows = _compared(sales, products)
    return _in_order(
        rows.select(*SALES, "product_avg_sales", "diff_avg_sales", "avg_change", "py_sales")
    )


def year_on_year(sales: DataFrame, products: DataFrame) -> DataFrame:
    rows = against_previous(_compared(sales, products))
    return _in_order(
        rows.select(
            *SALES,
            "product_avg_sales",
            "diff_avg_sales",
            "avg_change",
            "py_sales",
            "diff_py",
            "py_change",
        )
    )
