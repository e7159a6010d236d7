"""Sales by product attributes. Lines without a known product form the NULL group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from salestide.functions.labels import AGAINST_MEAN, AGAINST_PREVIOUS, by_sign
from salestide.functions.numbers import round_mean, round_ratio
from salestide.functions.text import join_text
from salestide.operators.periods import dated

def sales_by_attribute(
    sales: DataFrame,
    products: DataFrame,
    attribute: str,
    also_by: dict[str, Column] | None = None,
) -> DataFrame:
    """``total_sales`` per product attribute and any columns of ``also_by``.

    Lines are first summed per product key, so that neither lines nor a hot product reach
    the join, which handles one row per key. Whether it broadcasts is left to Spark, which
    measures the tables when it runs. Nothing runs when this is called.
    """
    groups = also_by or {}
    lookup = products.select(F.col("product_key").alias("_product"), attribute)
    lines = sales.select(
        F.col("product_key").alias("_key"),
        F.col("sales_amount").alias("_sales"),
        *[column.alias(name) for name, column in groups.items()],
    )
    sums = lines.groupBy("_key", *groups).agg(F.sum("_sales").alias("_sales"))
    joined = sums.join(lookup, F.col("_key") == F.col("_product"), "left")
    # The sum of sums has the type of a single sum.
    total = F.sum("_sales").cast(sums.schema["_sales"].dataType)
    return joined.groupBy(*groups, attribute).agg(total.alias("total_sales"))


def share_of_total(groups: DataFrame, value: str) -> DataFrame:
    """Adds the grand total and each row's share of it as text such as ``15.30%``.

    The grand total is a scalar subquery: partial sums are combined, so it needs no
    single-task window and no cross join however many groups there are, and it reuses
    the shuffle of ``groups``.
    """
    total = groups.agg(F.sum(value)).scalar()
    share = round_ratio(F.col(value) * 100, F.col("overall_sales"), 2)
    return groups.withColumn("overall_sales", total).withColumn(
        "percentage_of_total", join_text(share, F.lit("%"))
    )


def yearly_product_sales(sales: DataFrame, products: DataFrame) -> DataFrame:
    """Sales per year and product name; products that share a name count as one."""
    return sales_by_attribute(
        dated(sales), products, "product_name", {"order_year": F.year("order_date")}
    ).select("order_year", "product_name", F.col("total_sales").alias("current_year_sales"))


def with_previous(yearly: DataFrame) -> DataFrame:
    """Adds the sales of the product's previous year on record, gaps skipped."""
    window = W.partitionBy("product_name").orderBy("order_year")
    return yearly.withColumn("py_sales", F.lag("current_year_sales").over(window))


def with_mean(yearly: DataFrame) -> DataFrame:
    """Adds the product's mean yearly sales, rounded to a whole amount.

    Call it after ``with_previous``: both windows then share one shuffle and one sort.
    """
    window = W.partitionBy("product_name")
    sums = yearly.withColumns(
        {
            "_sum": F.sum("current_year_sales").over(window),
            "_count": F.count("current_year_sales").over(window),
        }
    )
    mean = round_mean(F.col("_sum"), F.col("_count"), 0)
    return sums.withColumn("product_avg_sales", mean).drop("_sum", "_count")


def against_mean(yearly: DataFrame) -> DataFrame:
    """Adds the difference from the rounded mean and its label."""
    difference = F.col("current_year_sales") - F.col("product_avg_sales")
    return yearly.withColumn("diff_avg_sales", difference).withColumn(
        "avg_change", by_sign(F.col("diff_avg_sales"), AGAINST_MEAN)
    )


def against_previous(yearly: DataFrame) -> DataFrame:
    """Adds the difference from the previous year on record and its label."""
    difference = F.col("current_year_sales") - F.col("py_sales")
    return yearly.withColumn("diff_py", difference).withColumn(
        "py_change", by_sign(F.col("diff_py"), AGAINST_PREVIOUS)
    )
