"""The three tables every analysis reads."""

from __future__ import annotations

from collections.abc import Mapping
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from salestide.sources import schema


class Star(NamedTuple):
    sales: DataFrame
    customers: DataFrame
    products: DataFrame


def open_table(
    spark: SparkSession,
    warehouse: str,
    name: str,
    tables: Mapping[str, T.StructType] = schema.TABLES,
) -> DataFrame:
    """A table as ``load_star`` wrote it. No schema is inferred, no file is opened yet."""
    columns = schema.stored(tables[name])
    if name == schema.SALES_TABLE:
        columns = columns.add(schema.ORDER_YEAR, T.IntegerType())
    return spark.read.schema(columns).parquet(f"{warehouse}/{name}")


def open_star(
    spark: SparkSession, warehouse: str, tables: Mapping[str, T.StructType] = schema.TABLES
) -> Star:
    return Star(
        sales=open_table(spark, warehouse, "fact_sales", tables),
        customers=open_table(spark, warehouse, "dim_customers", tables),
        products=open_table(spark, warehouse, "dim_products", tables),
    )


def register_table(spark: SparkSession, database: str, name: str, path: str) -> None:
    """Make stored Parquet known to the catalog, for SQL on ``gold.fact_sales`` and the like."""
    table = f"{database}.{name}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.catalog.createTable(table, path=path, source="parquet")
    if name == schema.SALES_TABLE:
        spark.catalog.recoverPartitions(table)


def register_star(spark: SparkSession, warehouse: str, database: str = "gold") -> None:
    for name in schema.TABLES:
        register_table(spark, database, name, f"{warehouse}/{name}")
