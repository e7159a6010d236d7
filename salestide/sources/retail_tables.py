"""The star of tables as a view of TPC-H-like retail tables, for tests and benchmarks.

Some keys are left out of the dimensions and some values are set to NULL on purpose,
so that lines without a customer, a product or a date occur.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salestide.session import work_folder
from salestide.sources import schema
from salestide.sources.csv_load import load_star
from salestide.sources.schema import MONEY
from salestide.sources.star import open_table


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def sales(spark: SparkSession, folder: str, with_price: bool = False) -> DataFrame:
    """Order lines. The price comes from a left join that neither drops nor repeats a
    line, so it is left out where no one reads the price."""
    lines = _table(spark, folder, "lineitem")
    orders = _table(spark, folder, "orders")
    no_date = F.col("o_orderkey") % 97 == 0
    columns = [
        F.col("o_orderkey").cast("string").alias("order_number"),
        F.col("l_partkey").alias("product_key"),
        F.col("o_custkey").alias("customer_key"),
        F.when(~no_date, F.col("o_orderdate").cast("date")).alias("order_date"),
        F.col("l_shipdate").cast("date").alias("shipping_date"),
        F.col("l_extendedprice").cast(MONEY).alias("sales_amount"),
        F.col("l_quantity").cast("int").alias("quantity"),
    ]
    rows = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    if with_price:
        part = _table(spark, folder, "part")
        rows = rows.join(part, F.col("l_partkey") == F.col("p_partkey"), "left")
        columns.append(F.col("p_retailprice").cast(MONEY).alias("price"))
    return rows.select(*columns)


def customers(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("c_custkey")
    day = F.date_add(F.lit("1930-01-01").cast("date"), (key * 7919 % 20000).cast("int"))
    people = _table(spark, folder, "customer").filter(key % 40 != 0)
    return people.join(
        _table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    ).select(
        key.alias("customer_key"),
        F.col("c_name").alias("customer_number"),
        F.when(key % 11 != 0, F.col("c_mktsegment")).alias("first_name"),
        F.col("n_name").alias("last_name"),
        F.when(key % 13 != 0, day).alias("birthdate"),
    )


def products(spark: SparkSession, folder: str) -> DataFrame:
    return (
        _table(spark, folder, "part")
        .filter(F.col("p_partkey") % 50 != 0)
        .select(
            F.col("p_partkey").alias("product_key"),
            F.col("p_name").alias("product_name"),
            F.when(F.col("p_type") != "PROMO", F.col("p_type")).alias("category"),
            (F.col("p_size") * 25).cast(MONEY).alias("cost"),
        )
    )


class RetailStar:
    """The tables by name, each set up only when it is asked for."""

    def __init__(self, spark: SparkSession, folder: str, with_price: bool = False):
        self._place = (spark, folder)
        self._with_price = with_price

    @property
    def sales(self) -> DataFrame:
        return sales(*self._place, self._with_price)

    @property
    def customers(self) -> DataFrame:
        return customers(*self._place)

    @property
    def products(self) -> DataFrame:
        return products(*self._place)


# Keys of the retail tables may be longer than the declared ones.
TABLES = {name: schema.with_long_keys(columns) for name, columns in schema.TABLES.items()}


def _all_columns(rows: DataFrame, name: str) -> DataFrame:
    """Every declared column of the table in order, NULL where the rows have none."""
    nothing = F.lit(None).cast("string")
    return rows.select(
        *[F.col(c) if c in rows.columns else nothing.alias(c) for c in TABLES[name].names]
    )


def _full_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table with text that needs quoting, empty text and ``Yes``/``No`` values."""
    if name == "dim_products":
        part = _table(spark, folder, "part")
        size = F.col("p_size")
        extra = part.select(
            F.col("p_partkey").alias("product_key"),
            F.format_string('"%s", size %d', "p_brand", size).alias("product_number"),
            F.when(size % 3 == 0, "Yes").when(size % 3 == 1, "No").alias("maintenance"),
            F.when(size % 5 == 0, "").otherwise("n/a").alias("product_line"),
        )
        rows = products(spark, folder).join(extra, "product_key")
    elif name == "dim_customers":
        rows = customers(spark, folder)
    else:
        rows = sales(spark, folder, with_price=True)
    return _all_columns(rows, name)


def loaded(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One table written as CSV, loaded from there into typed Parquet, and opened.

    Both copies go to a new folder in the cluster's shared folder.
    """
    place = work_folder(spark, "load")
    _full_table(spark, folder, name).write.csv(f"{place}/csv", header=True, quote='"', escape='"')
    load_star(spark, {name: f"{place}/csv"}, place, TABLES)
    return open_table(spark, place, name, TABLES)
