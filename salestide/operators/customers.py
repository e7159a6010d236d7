"""Sales by customer.

Groups follow the customer table's key, not the line's: lines whose customer is
unknown, whatever their own key, form one group with a NULL key. Lines are summed
before they meet the customer table, which may be too large to broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salestide.functions import labels
from salestide.functions.dates import as_date, whole_months, whole_years
from salestide.functions.numbers import round_ratio
from salestide.functions.text import join_text
from salestide.operators.periods import dated

ATTRIBUTES = ["customer_key", "customer_number", "customer_name", "age"]


def customer_spending(sales: DataFrame, customers: DataFrame) -> DataFrame:
    """Total, first and last order date and the days between, per known customer.

    Lines without a date count towards the total.
    """
    per_key = sales.groupBy(F.col("customer_key").alias("_key")).agg(
        F.sum("sales_amount").alias("_sales"),
        F.min("order_date").alias("_first"),
        F.max("order_date").alias("_last"),
    )
    known = customers.select("customer_key")
    return (
        per_key.join(known, F.col("_key") == F.col("customer_key"), "left")
        .groupBy("customer_key")
        .agg(
            F.sum("_sales").alias("total_spending"),
            F.min("_first").alias("first_order"),
            F.max("_last").alias("last_order"),
        )
        .withColumn("life_span", F.datediff("last_order", "first_order"))
    )


def customer_profile(customers: DataFrame, as_of=None) -> DataFrame:
    """Key, number, full name and age in years, one row per row of the table."""
    name = join_text(F.col("first_name"), F.lit(" "), F.col("last_name"))
    return customers.select(
        "customer_key",
        "customer_number",
        name.alias("customer_name"),
        whole_years(F.col("birthdate"), as_date(as_of)).alias("age"),
    )


def _name_or_blank() -> Column:
    """Without a customer the name is the blank between two missing parts."""
    return F.coalesce("customer_name", F.lit(" ")).alias("customer_name")


def dated_lines(sales: DataFrame, customers: DataFrame, as_of=None) -> DataFrame:
    """Every dated line with its customer's profile."""
    lines = dated(sales).select(
        "order_number",
        "product_key",
        "order_date",
        "sales_amount",
        "quantity",
        F.col("customer_key").alias("_key"),
    )
    joined = lines.join(
        customer_profile(customers, as_of), F.col("_key") == F.col("customer_key"), "left"
    )
    return joined.select(
        "order_number",
        "product_key",
        "order_date",
        "sales_amount",
        "quantity",
        "customer_key",
        "customer_number",
        _name_or_blank(),
        "age",
    )


def _with_known_key(rows: DataFrame, customers: DataFrame) -> DataFrame:
    """Adds the customer table's key for ``_key``, NULL where it has none.

    Only the bare keys take part: broadcast if Spark finds them small, else joined by
    sort-merge, where AQE splits the tasks of a customer with very many rows. It does
    so only if the join itself shuffles both sides. Hence the key is passed on as an
    aggregate: a plain ``distinct`` would lend its own partitioning to the join.
    """
    keys = customers.groupBy(F.col("customer_key").alias("_group")).agg(
        F.max("customer_key").alias("customer_key")
    )
    return rows.join(keys.drop("_group"), F.col("_key") == F.col("customer_key"), "left")


def _count_items(
    rows: DataFrame, customers: DataFrame, item: str, name: str, measures: dict[str, Column]
) -> DataFrame:
    """Counts the distinct ``item`` values of rows that hold each (``_key``, item) once.

    A known customer becomes one row. Unknown customers may share items, so they become
    one row per item, counted as one, and are left for the caller to sum.
    """
    unknown = F.col("customer_key").isNull()
    grouped = (
        _with_known_key(rows, customers)
        .groupBy("customer_key", F.when(unknown, F.col(item)).alias("_item"))
        .agg(F.count(item).alias("_count"), *[c.alias(n) for n, c in measures.items()])
    )
    items = F.when(unknown, F.col("_item").isNotNull().cast("bigint")).otherwise(F.col("_count"))
    return grouped.select("customer_key", items.alias(name), *measures)


def customer_totals(sales: DataFrame, customers: DataFrame, as_of=None) -> DataFrame:
    """Orders, sales, units, products, last order and months of custom per customer.

    Two distinct counts in one grouping would make Spark copy every line three times,
    names and all. Instead lines become one row per (customer, order) and one per
    (customer, product). Both are combined inside the tasks before their shuffle and
    spread by order or product, so neither one customer with a third of all lines nor
    the group of unknown customers is a hot spot, and no line reaches a join. Rows are
    combined again before each later shuffle. Names and ages join last.

    ``sales`` is read twice, once for orders and once for products. Stored tables are
    read with the needed columns only; store a derived frame first, or it is computed
    twice.
    """
    lines = dated(sales).withColumnRenamed("customer_key", "_key")
    orders = lines.groupBy("_key", "order_number").agg(
        F.sum("sales_amount").alias("total_sales"),
        F.sum("quantity").alias("total_quantity"),
        F.min("order_date").alias("_first"),
        F.max("order_date").alias("last_order_date"),
    )
    bought = lines.select("_key", "product_key").distinct()
    measures = {
        "total_sales": F.sum("total_sales"),
        "total_quantity": F.sum("total_quantity"),
        "_first": F.min("_first"),
        "last_order_date": F.max("last_order_date"),
    }
    # Put together by a union: a join would not match the NULL key of unknown customers.
    both = _count_items(orders, customers, "order_number", "total_orders", measures).unionByName(
        _count_items(bought, customers, "product_key", "total_products", {}),
        allowMissingColumns=True,
    )
    totals = both.groupBy(F.col("customer_key").alias("_key")).agg(
        F.sum("total_orders").alias("total_orders"),
        F.sum("total_products").alias("total_products"),
        *[column.alias(name) for name, column in measures.items()],
    )
    profiles = customer_profile(customers, as_of)
    joined = totals.join(profiles, F.col("_key") == F.col("customer_key"), "left")
    # A repeated key in the customer table counts its lines again, once per row with
    # the same profile. The grouping keeps the partitioning of the join.
    return (
        joined.groupBy(
            F.col("_key").alias("customer_key"), "customer_number", _name_or_blank(), "age"
        )
        .agg(
            F.max("total_orders").alias("total_orders"),
            F.sum("total_sales").alias("total_sales"),
            F.sum("total_quantity").alias("total_quantity"),
            F.max("total_products").alias("total_products"),
            F.max("last_order_date").alias("last_order_date"),
            F.min("_first").alias("_first"),
        )
        .withColumn("lifespan", whole_months(F.col("_first"), F.col("last_order_date")))
        .drop("_first")
    )


def customer_report(
    sales: DataFrame,
    customers: DataFrame,
    as_of=None,
    spend_limit=labels.SPEND_LIMIT,
    tenure_months=labels.TENURE_MONTHS,
) -> DataFrame:
    """One row per customer: totals, age group, segment, recency and spending habits."""
    total, months, age = F.col("total_sales"), F.col("lifespan"), F.col("age")
    segment = labels.segment_by_months(total, months, spend_limit, tenure_months)
    order_value = round_ratio(total, F.col("total_orders").cast("decimal(20,0)"), 2)
    per_order = F.when(total == 0, F.lit(0)).otherwise(order_value)
    monthly = round_ratio(total, months.cast("decimal(10,0)"), 2)
    per_month = F.when(months == 0, F.round(total, 2)).otherwise(monthly)
    return customer_totals(sales, customers, as_of).select(
        *ATTRIBUTES,
        labels.age_group(age).alias("age_group"),
        segment.alias("customer_segment"),
        whole_months(F.col("last_order_date"), as_date(as_of)).alias("recency_months"),
        per_order.cast("decimal(38,2)").alias("avg_order_value"),
        per_month.cast("decimal(38,2)").alias("avg_monthly_spend"),
        "total_orders",
        "total_sales",
        "total_quantity",
        "total_products",
        "last_order_date",
        "lifespan",
    )
