"""The customer report: its steps, the report itself, its best customers, its publication."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salestide.functions import labels
from salestide.operators.customers import (
    ATTRIBUTES,
    customer_report,
    dated_lines,
)

VIEW = "report_customer"


def base(sales: DataFrame, customers: DataFrame, as_of=None) -> DataFrame:
    return dated_lines(sales, customers, as_of).select(
        "order_number", "product_key", "order_date", "sales_amount", "quantity", *ATTRIBUTES
    )


report = customer_report


def publish_view(report_rows: DataFrame, name: str = VIEW) -> None:
    """Register the report as a view of this session. Nothing is stored: ages and recency
    follow the current date unless the report was built with a fixed ``as_of``."""
    report_rows.createOrReplaceTempView(name)


def publish_table(report_rows: DataFrame, name: str) -> None:
    """Store the report as the catalog's table ``database.name``, for every session that
    shares the catalog. Ages and recency are those of the day; publish again to renew them.

    The rows are written to a table of their own first, so a report that fails leaves the
    published one as it is, and readers of it are not cut off for long.
    """
    spark = report_rows.sparkSession
    database, _, table = name.rpartition(".")
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    fresh = f"{name}_{uuid.uuid4().hex}"
    report_rows.write.saveAsTable(fresh)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"ALTER TABLE {fresh} RENAME TO {name}")


def _months(start: str, end: str) -> str:
    """SQL for completed months, as ``whole_months``."""

    def completed(a: str, b: str) -> str:
        return f"(12 * (year({b}) - year({a})) + month({b}) - month({a}) - CAST(day({b}) < day({a}) AS INT))"

    return f"CASE WHEN {end} >= {start} THEN {completed(start, end)} ELSE -{completed(end, start)} END"


def _ratio(number: str, count: str) -> str:
    """SQL for a quotient rounded once to cents, as ``round_ratio``."""
    scaled = f"({number} * CAST(100 AS DECIMAL(18,0)))"
    rest = f"({scaled} % {count})"
    step = f"CASE WHEN abs({rest}) * 2 >= abs({count}) THEN signum({scaled}) * signum({count}) ELSE 0 END"
    return f"CAST((CAST(({scaled} - {rest}) / {count} AS DECIMAL(38,0)) + CAST({step} AS DECIMAL(1,0))) / 100 AS DECIMAL(38,2))"


def view_sql(warehouse: str, spend_limit=labels.SPEND_LIMIT, tenure_months=labels.TENURE_MONTHS) -> str:
    """The customer report as a SELECT on stored tables, in the steps of ``customer_report``."""
    sales, people = (f"parquet.`{warehouse.replace('`', '``')}/{name}`" for name in ("fact_sales", "dim_customers"))
    ages = " ".join(f"WHEN age < {limit} THEN '{name}'" for limit, name in labels.AGE_GROUPS.items())
    return f"""
WITH lines AS (
  SELECT customer_key AS k, order_number, product_key, order_date, sales_amount, quantity
  FROM {sales} WHERE order_date IS NOT NULL),
known AS (SELECT customer_key AS known_key FROM {people} GROUP BY customer_key),
orders AS (
  SELECT known_key, order_number, sum(sales) AS sales, sum(units) AS units, min(first) AS first, max(last) AS last
  FROM (SELECT k, order_number, sum(sales_amount) AS sales, sum(quantity) AS units,
          min(order_date) AS first, max(order_date) AS last FROM lines GROUP BY k, order_number)
  LEFT JOIN known ON k = known_key GROUP BY known_key, order_number),
by_order AS (
  SELECT known_key, count(order_number) AS total_orders, sum(sales) AS total_sales, sum(units) AS total_quantity,
    min(first) AS first_order, max(last) AS last_order_date
  FROM orders GROUP BY known_key),
by_product AS (
  SELECT known_key AS product_owner, count(product_key) AS total_products
  FROM (SELECT DISTINCT known_key, product_key FROM (SELECT DISTINCT k, product_key FROM lines) LEFT JOIN known ON k = known_key)
  GROUP BY known_key),
profiles AS (
  SELECT customer_key, customer_number, concat_ws('', first_name, ' ', last_name) AS customer_name,
    CAST(({_months("birthdate", "current_date()")}) DIV 12 AS INT) AS age
  FROM {people}),
totals AS (
  SELECT known_key AS customer_key, customer_number, coalesce(customer_name, ' ') AS customer_name, age,
    max(total_orders) AS total_orders, sum(total_sales) AS total_sales, sum(total_quantity) AS total_quantity,
    max(total_products) AS total_products, max(last_order_date) AS last_order_date, min(first_order) AS first_order
  FROM by_order JOIN by_product ON known_key <=> product_owner LEFT JOIN profiles ON known_key = customer_key
  GROUP BY known_key, customer_number, coalesce(customer_name, ' '), age),
spans AS (SELECT *, {_months("first_order", "last_order_date")} AS lifespan FROM totals)
SELECT customer_key, customer_number, customer_name, age,
  CASE {ages} ELSE '{labels.OLDEST}' END AS age_group,
  CASE WHEN lifespan >= {tenure_months} AND total_sales > {spend_limit} THEN '{labels.VIP}'
    WHEN lifespan >= {tenure_months} AND total_sales < {spend_limit} THEN '{labels.REGULAR}' ELSE '{labels.NEW}' END AS customer_segment,
  {_months("last_order_date", "current_date()")} AS recency_months,
  CAST(CASE WHEN total_sales = 0 THEN 0 ELSE {_ratio("total_sales", "CAST(total_orders AS DECIMAL(20,0))")} END AS DECIMAL(38,2)) AS avg_order_value,
  CAST(CASE WHEN lifespan = 0 THEN round(total_sales, 2) ELSE {_ratio("total_sales", "CAST(lifespan AS DECIMAL(10,0))")} END AS DECIMAL(38,2)) AS avg_monthly_spend,
  total_orders, total_sales, total_quantity, total_products, last_order_date, lifespan
FROM spans"""


def publish_lasting_view(spark: SparkSession, warehouse: str, name: str, **limits: int) -> None:
    """Create the catalog's view ``database.name`` on the stored tables, for every session that
    shares the catalog. It reads the tables anew each time, so it follows later loads and the date."""
    database = name.rpartition(".")[0]
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {view_sql(warehouse, **limits)}")


def top_customers(report_rows: DataFrame, count: int = 20) -> DataFrame:
    """The report's rows with the highest sales; ties go by customer key."""
    best = [F.desc_nulls_first("total_sales"), F.asc_nulls_last("customer_key")]
    return report_rows.orderBy(*best).limit(count)
