"""What each product category contributes to all sales, undated lines included."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salestide.operators.products import sales_by_attribute, share_of_total


def by_category(sales: DataFrame, products: DataFrame) -> DataFrame:
    shares = share_of_total(sales_by_attribute(sales, products, "category"), "total_sales")
    return shares.orderBy(F.desc_nulls_first("total_sales"))
