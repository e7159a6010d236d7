"""Declared columns of the three tables. Every column may be NULL."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(12, 2)

# Column names, types and text lengths, in file order.
CUSTOMERS = T.StructType(
    [
        T.StructField("customer_key", T.IntegerType()),
        T.StructField("customer_id", T.IntegerType()),
        T.StructField("customer_number", T.VarcharType(20)),
        T.StructField("first_name", T.VarcharType(50)),
        T.StructField("last_name", T.VarcharType(50)),
        T.StructField("country", T.VarcharType(50)),
        T.StructField("marital_status", T.VarcharType(20)),
        T.StructField("gender", T.VarcharType(10)),
        T.StructField("birthdate", T.DateType()),
        T.StructField("create_date", T.DateType()),
    ]
)

PRODUCTS = T.StructType(
    [
        T.StructField("product_key", T.IntegerType()),
        T.StructField("product_id", T.IntegerType()),
        T.StructField("product_number", T.VarcharType(50)),
        T.StructField("product_name", T.VarcharType(255)),
        T.StructField("category_id", T.VarcharType(20)),
        T.StructField("category", T.VarcharType(100)),
        T.StructField("subcategory", T.VarcharType(100)),
        T.StructField("maintenance", T.BooleanType()),
        T.StructField("cost", MONEY),
        T.StructField("product_line", T.VarcharType(50)),
        T.StructField("start_date", T.DateType()),
    ]
)

SALES = T.StructType(
    [
        T.StructField("order_number", T.VarcharType(30)),
        T.StructField("product_key", T.IntegerType()),
        T.StructField("customer_key", T.IntegerType()),
        T.StructField("order_date", T.DateType()),
        T.StructField("shipping_date", T.DateType()),
        T.StructField("due_date", T.DateType()),
        T.StructField("sales_amount", MONEY),
        T.StructField("quantity", T.IntegerType()),
        T.StructField("price", MONEY),
    ]
)

# Dimensions come first, the table that refers to them last.
TABLES = {"dim_customers": CUSTOMERS, "dim_products": PRODUCTS, "fact_sales": SALES}

# Partition column of the stored sales.
SALES_TABLE, ORDER_YEAR = "fact_sales", "order_year"


def with_long_keys(columns: T.StructType) -> T.StructType:
    """The same columns with room for more than two billion keys."""

    def kind(field: T.StructField) -> T.DataType:
        is_key = field.name.endswith(("_key", "_id"))
        return T.LongType() if is_key and field.dataType == T.IntegerType() else field.dataType

    return T.StructType([T.StructField(f.name, kind(f)) for f in columns.fields])


def stored(schema: T.StructType) -> T.StructType:
    """The schema as written to Parquet, where text has no declared length."""

    def kind(field: T.StructField) -> T.DataType:
        return T.StringType() if isinstance(field.dataType, T.VarcharType) else field.dataType

    return T.StructType([T.StructField(f.name, kind(f)) for f in schema.fields])
