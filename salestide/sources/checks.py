"""What a load should be checked for. The analyses accept either kind of fault."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unknown_keys(sales: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Keys of sales lines, NULL among them, that the dimension does not have, with the
    number of lines. Lines are counted per key before they meet the dimension."""
    used = sales.groupBy(F.col(key).alias("_key")).agg(F.count("*").alias("lines"))
    lost = used.join(dimension.select(key), F.col("_key") == F.col(key), "left_anti")
    return lost.select(F.col("_key").alias(key), "lines")


def repeated_keys(dimension: DataFrame, key: str) -> DataFrame:
    """Keys that several rows of a dimension share, so that sales lines count repeatedly."""
    return dimension.groupBy(key).agg(F.count("*").alias("rows")).filter("rows > 1")
