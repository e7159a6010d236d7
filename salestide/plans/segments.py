"""Products by cost range, customers by spending and length of custom."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salestide.functions import labels
from salestide.operators.customers import customer_spending


def product_cost_ranges(products: DataFrame, edges=labels.COST_EDGES) -> DataFrame:
    label = labels.cost_range(F.col("cost"), edges)
    return products.select("product_key", "product_name", "cost", label.alias("cost_range"))


def _largest_first(rows: DataFrame, label: str, key: str, count: str) -> DataFrame:
    """Members per label; members without a key do not count, but their label shows."""
    return (
        rows.groupBy(label)
        .agg(F.count(key).alias(count))
        .orderBy(F.desc(count), F.asc(label))
    )


def product_cost_range_counts(products: DataFrame, edges=labels.COST_EDGES) -> DataFrame:
    ranges = product_cost_ranges(products, edges)
    return _largest_first(ranges, "cost_range", "product_key", "total_products")


def customer_detail(
    sales: DataFrame,
    customers: DataFrame,
    spend_limit=labels.SPEND_LIMIT,
    tenure_days=labels.TENURE_DAYS,
) -> DataFrame:
    label = labels.segment_by_days(
        F.col("total_spending"), F.col("life_span"), spend_limit, tenure_days
    )
    return customer_spending(sales, customers).select(
        "customer_key", "total_spending", "life_span", label.alias("customer_seg")
    )


def customer_labels(sales: DataFrame, customers: DataFrame, **limits) -> DataFrame:
    return customer_detail(sales, customers, **limits).select("customer_key", "customer_seg")


def customer_counts(sales: DataFrame, customers: DataFrame, **limits) -> DataFrame:
    rows = customer_labels(sales, customers, **limits)
    return _largest_first(rows, "customer_seg", "customer_key", "total_customers")
