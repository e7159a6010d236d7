from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import DataFrame, SparkSession

from salestide.session import builder
from salestide.sources import schema


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        builder("tests", shuffle_partitions=4)
        .master("local[4]")
        .config("spark.driver.memory", "4g")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("catalog")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def _value(text, kind: str):
    if text is None:
        return None
    if kind == "date":
        return dt.date.fromisoformat(text)
    if kind.startswith("decimal"):
        return Decimal(str(text))
    return text


class Tables:
    """Small tables from rows that name only the columns that matter."""

    def __init__(self, spark: SparkSession):
        self.spark = spark

    def _make(self, name: str, rows: list[dict]) -> DataFrame:
        columns = schema.stored(schema.TABLES[name])
        unknown = {key for row in rows for key in row} - set(columns.names)
        assert not unknown, unknown
        data = [
            tuple(_value(row.get(f.name), f.dataType.simpleString()) for f in columns.fields)
            for row in rows
        ]
        return self.spark.createDataFrame(data, columns)

    def sales(self, *rows: dict) -> DataFrame:
        return self._make("fact_sales", list(rows))

    def customers(self, *rows: dict) -> DataFrame:
        return self._make("dim_customers", list(rows))

    def products(self, *rows: dict) -> DataFrame:
        return self._make("dim_products", list(rows))


@pytest.fixture(scope="session")
def tables(spark) -> Tables:
    return Tables(spark)


def line(order, customer, date, amount, product=1, quantity=1, price=1) -> dict:
    return {
        "order_number": order,
        "customer_key": customer,
        "order_date": date,
        "sales_amount": amount,
        "product_key": product,
        "quantity": quantity,
        "price": price,
    }
