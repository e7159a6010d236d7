"""The same analyses as DuckDB SQL, for checking results only.

Written independently of the Spark code: sums are taken in whole cents and rounded
half up with integer division, dates are compared with DuckDB's own ``age``.
Whole numbers leave as BIGINT and money as DOUBLE on both sides.
"""

from __future__ import annotations

# Settings that suit the amounts and dates of the test tables.
AS_OF = "2002-01-01"
SPEND_LIMIT = 2_000_000
TENURE_DAYS = 2_000
TENURE_MONTHS = 12

TABLES = """
sales AS (
  SELECT cast(o_orderkey AS varchar) AS order_number,
         l_partkey AS product_key,
         o_custkey AS customer_key,
         CASE WHEN o_orderkey % 97 <> 0 THEN cast(o_orderdate AS date) END AS order_date,
         cast(l_shipdate AS date) AS shipping_date,
         cast(l_extendedprice AS decimal(12,2)) AS sales_amount,
         cast(l_quantity AS integer) AS quantity,
         cast(p_retailprice AS decimal(12,2)) AS price
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  LEFT JOIN part ON l_partkey = p_partkey
),
customers AS (
  SELECT c_custkey AS customer_key,
         c_name AS customer_number,
         CASE WHEN c_custkey % 11 <> 0 THEN c_mktsegment END AS first_name,
         n_name AS last_name,
         CASE WHEN c_custkey % 13 <> 0
              THEN date '1930-01-01' + cast(c_custkey * 7919 % 20000 AS integer) END AS birthdate
  FROM customer JOIN nation ON c_nationkey = n_nationkey
  WHERE c_custkey % 40 <> 0
),
products AS (
  SELECT p_partkey AS product_key,
         p_name AS product_name,
         CASE WHEN p_type <> 'PROMO' THEN p_type END AS category,
         cast(p_size * 25 AS decimal(12,2)) AS cost
  FROM part
  WHERE p_partkey % 50 <> 0
)"""


def _with(*more: str) -> str:
    return "WITH " + ",\n".join((TABLES.strip(),) + more) + "\n"


def _money(expression: str) -> str:
    return f"cast({expression} AS double)"


def _cents(expression: str) -> str:
    return f"cast(({expression}) * 100 AS hugeint)"


def _half_up(numerator: str, denominator: str) -> str:
    return f"((2 * ({numerator}) + ({denominator})) // (2 * ({denominator})))"


def _months(later: str, earlier: str) -> str:
    span = f"age(cast({later} AS timestamp), cast({earlier} AS timestamp))"
    return f"cast(date_part('year', {span}) * 12 + date_part('month', {span}) AS bigint)"


def _years(later: str, earlier: str) -> str:
    return f"cast(date_part('year', age(cast({later} AS timestamp), cast({earlier} AS timestamp))) AS bigint)"


YEAR = "cast(year(order_date) AS bigint)"
MONTH = "cast(month(order_date) AS bigint)"
MONTH_START = "cast(date_trunc('month', order_date) AS date)"
YEAR_START = "cast(date_trunc('year', order_date) AS date)"

ACTIVITY = f"""{_money('sum(sales_amount)')} AS total_sales,
       count(DISTINCT customer_key) AS total_customers,
       cast(sum(quantity) AS bigint) AS total_quantity"""


def _per_period(periods: dict[str, str], measures: str) -> str:
    columns = ", ".join(f"{expression} AS {name}" for name, expression in periods.items())
    keys = ", ".join(periods.values())
    return _with() + f"SELECT {columns},\n       {measures}\nFROM sales WHERE order_date IS NOT NULL GROUP BY {keys}"


def _running(period: str, name: str, reset: str = "") -> str:
    return (
        _with(
            f"""sums AS (SELECT {period} AS period, sum(sales_amount) AS total
  FROM sales WHERE order_date IS NOT NULL GROUP BY {period})"""
        )
        + f"""SELECT period AS order_date, {_money('total')} AS total_sales,
       {_money(f'sum(total) OVER ({reset} ORDER BY period)')} AS {name}
FROM sums"""
    )


PRICES = f"""prices AS (
  SELECT {YEAR_START} AS period, sum(sales_amount) AS total,
         {_half_up(_cents('sum(price)'), 'count(price)')} AS mean_cents
  FROM sales WHERE order_date IS NOT NULL GROUP BY {YEAR_START})"""

# The label texts here and below are those of salestide/functions/labels.py.
RANGES = """ranges AS (
  SELECT *, CASE WHEN cost < 100 THEN 'Below 100' WHEN cost BETWEEN 100 AND 500 THEN '100-500'
                 WHEN cost BETWEEN 500 AND 1000 THEN '500-1000' ELSE 'Above 1000' END AS cost_range
  FROM products)"""

SPENDING = """spending AS (
  SELECT c.customer_key, sum(sales_amount) AS spent, min(order_date) AS first_order,
         max(order_date) AS last_order, date_diff('day', min(order_date), max(order_date)) AS days
  FROM sales s LEFT JOIN customers c ON s.customer_key = c.customer_key
  GROUP BY c.customer_key)"""

LABELLED = f"""labelled AS (
  SELECT *, CASE WHEN spent > {SPEND_LIMIT} AND days >= {TENURE_DAYS} THEN 'VIP'
                 WHEN spent <= {SPEND_LIMIT} AND days >= {TENURE_DAYS} THEN 'Regular'
                 ELSE 'New' END AS customer_seg
  FROM spending)"""

YEARLY = """yearly AS (
  SELECT year(order_date) AS order_year, product_name, sum(sales_amount) AS current
  FROM sales s LEFT JOIN products p ON s.product_key = p.product_key
  WHERE order_date IS NOT NULL GROUP BY year(order_date), product_name)"""

COMPARED = f"""compared AS (
  SELECT *, {_half_up(_cents('sum(current) OVER w'), '100 * count(current) OVER w')} AS mean,
         lag(current) OVER (PARTITION BY product_name ORDER BY order_year) AS previous
  FROM yearly WINDOW w AS (PARTITION BY product_name))"""

PERF_COLUMNS = {
    "order_year": "cast(order_year AS bigint)",
    "product_name": "product_name",
    "current_year_sales": _money("current"),
    "product_avg_sales": _money("mean"),
    "diff_avg_sales": _money("current - mean"),
    "avg_change": "CASE WHEN current > mean THEN 'Above Average' WHEN current < mean THEN 'Below Average' ELSE 'AVG' END",
    "py_sales": _money("previous"),
    "diff_py": _money("current - previous"),
    "py_change": "CASE WHEN current > previous THEN 'Increase' WHEN current < previous THEN 'Decrease' ELSE 'no change' END",
}


def _performance(last: str) -> str:
    names = list(PERF_COLUMNS)
    columns = ",\n       ".join(f"{PERF_COLUMNS[n]} AS {n}" for n in names[: names.index(last) + 1])
    return _with(YEARLY, COMPARED) + f"SELECT {columns}\nFROM compared"


BASE = f"""base AS (
  SELECT order_number, product_key, order_date, sales_amount, quantity, c.customer_key, customer_number,
         concat(first_name, ' ', last_name) AS customer_name,
         {_years(f"date '{AS_OF}'", 'birthdate')} AS age
  FROM sales s LEFT JOIN customers c ON s.customer_key = c.customer_key
  WHERE order_date IS NOT NULL)"""

TOTALS = f"""totals AS (
  SELECT customer_key, customer_number, customer_name, age,
         count(DISTINCT order_number) AS total_orders, sum(sales_amount) AS sales,
         cast(sum(quantity) AS bigint) AS total_quantity,
         count(DISTINCT product_key) AS total_products, max(order_date) AS last_order_date,
         {_months('max(order_date)', 'min(order_date)')} AS lifespan
  FROM base GROUP BY customer_key, customer_number, customer_name, age)"""

REPORT = f"""SELECT customer_key, customer_number, customer_name, age,
       CASE WHEN age < 20 THEN 'Under 20' WHEN age BETWEEN 20 AND 29 THEN '20-29'
            WHEN age BETWEEN 30 AND 39 THEN '30-39' WHEN age BETWEEN 40 AND 49 THEN '40-49'
            ELSE '50 and above' END AS age_group,
       CASE WHEN lifespan >= {TENURE_MONTHS} AND sales > {SPEND_LIMIT} THEN 'VIP'
            WHEN lifespan >= {TENURE_MONTHS} AND sales < {SPEND_LIMIT} THEN 'Regular'
            ELSE 'New' END AS customer_segment,
       {_months(f"date '{AS_OF}'", 'last_order_date')} AS recency_months,
       CASE WHEN sales = 0 THEN 0 ELSE {_money(_half_up(_cents('sales'), 'total_orders'))} / 100 END AS avg_order_value,
       CASE WHEN lifespan = 0 THEN {_money('sales')}
            ELSE {_money(_half_up(_cents('sales'), 'lifespan'))} / 100 END AS avg_monthly_spend,
       total_orders, {_money('sales')} AS total_sales, total_quantity, total_products,
       last_order_date, lifespan
FROM totals"""

HUNDREDTHS = _half_up(f"{_cents('total')} * 10000", _cents("sum(total) OVER ()"))

SQL: dict[str, str] = {
    "trend_order_lines": _with()
    + f"SELECT order_date, {_money('sales_amount')} AS sales_amount FROM sales WHERE order_date IS NOT NULL",
    "trend_daily": _per_period({"order_date": "order_date"}, f"{_money('sum(sales_amount)')} AS total_sales"),
    "trend_yearly": _per_period({"order_year": YEAR}, ACTIVITY),
    "trend_month_of_year": _per_period({"order_month": MONTH}, ACTIVITY),
    "trend_year_month": _per_period({"order_year": YEAR, "order_month": MONTH}, ACTIVITY),
    "trend_month_start": _per_period({"order_month_start": MONTH_START}, ACTIVITY),
    "cum_month_of_year": _per_period({"sales_month": MONTH}, f"{_money('sum(sales_amount)')} AS total_sales"),
    # The period is grouped in a CTE: named order_date, it would hide the column.
    "cum_month_totals": _with(
        f"""sums AS (SELECT {MONTH_START} AS period, sum(sales_amount) AS total
  FROM sales WHERE order_date IS NOT NULL GROUP BY {MONTH_START})"""
    )
    + f"SELECT period AS order_date, {_money('total')} AS total_sales FROM sums",
    "cum_running_month": _running(MONTH_START, "running_total_sales"),
    "cum_ytd_month": _running(MONTH_START, "running_total_sales", "PARTITION BY year(period)"),
    "cum_running_year": _running(YEAR_START, "running_total_sale_by_year"),
    "cum_year_avg_price": _with(PRICES)
    + f"SELECT period AS order_date, {_money('total')} AS total_sum, {_money('mean_cents')} / 100 AS avg_price FROM prices",
    "cum_running_year_avg_price": _with(PRICES)
    + f"""SELECT period AS order_date, {_money('total')} AS total_sales,
       {_money('sum(total) OVER w')} AS running_total_sales, {_money('mean_cents')} / 100 AS avg_price,
       {_money(_half_up('sum(mean_cents) OVER w', 'count(mean_cents) OVER w'))} / 100 AS running_avg_price
FROM prices WINDOW w AS (ORDER BY period)""",
    "seg_product_cost_range": _with(RANGES)
    + f"SELECT product_key, product_name, {_money('cost')} AS cost, cost_range FROM ranges",
    "seg_product_cost_range_counts": _with(RANGES)
    + "SELECT cost_range, count(product_key) AS total_products FROM ranges GROUP BY cost_range",
    "seg_customer_spending": _with(SPENDING)
    + f"""SELECT customer_key, {_money('spent')} AS total_spending, first_order, last_order, days AS life_span
FROM spending""",
    "seg_customer_detail": _with(SPENDING, LABELLED)
    + f"SELECT customer_key, {_money('spent')} AS total_spending, days AS life_span, customer_seg FROM labelled",
    "seg_customer_labels": _with(SPENDING, LABELLED) + "SELECT customer_key, customer_seg FROM labelled",
    "seg_customer_counts": _with(SPENDING, LABELLED)
    + "SELECT customer_seg, count(customer_key) AS total_customers FROM labelled GROUP BY customer_seg",
    "share_by_category": _with(
        """categories AS (SELECT category, sum(sales_amount) AS total
  FROM sales s LEFT JOIN products p ON s.product_key = p.product_key GROUP BY category)""",
        f"shares AS (SELECT *, sum(total) OVER () AS overall, {HUNDREDTHS} AS hundredths FROM categories)",
    )
    + f"""SELECT category, {_money('total')} AS total_sales, {_money('overall')} AS overall_sales,
       concat(hundredths // 100, '.', lpad(cast(hundredths % 100 AS varchar), 2, '0'), '%') AS percentage_of_total
FROM shares""",
    "perf_yearly_product": _performance("current_year_sales"),
    "perf_vs_avg": _performance("product_avg_sales"),
    "perf_vs_avg_diff": _performance("diff_avg_sales"),
    "perf_vs_avg_label": _performance("avg_change"),
    "perf_prev_year": _performance("py_sales"),
    "perf_yoy": _performance("py_change"),
    "report_base": _with(BASE)
    + f"""SELECT order_number, product_key, order_date, {_money('sales_amount')} AS sales_amount,
       cast(quantity AS bigint) AS quantity, customer_key, customer_number, customer_name, age FROM base""",
    "report_customer_agg": _with(BASE, TOTALS)
    + f"""SELECT customer_key, customer_number, customer_name, age, total_orders, {_money('sales')} AS total_sales,
       total_quantity, total_products, last_order_date, lifespan FROM totals""",
    "report_customer": _with(BASE, TOTALS) + REPORT,
    "report_customer_today": (_with(BASE, TOTALS) + REPORT).replace(f"date '{AS_OF}'", "current_date"),
    "report_top_customers": _with(BASE, TOTALS, f"report AS ({REPORT})")
    + "SELECT * FROM report ORDER BY total_sales DESC, customer_key ASC NULLS LAST LIMIT 20",
    "load_dim_customers": _with()
    + """SELECT customer_key, cast(NULL AS bigint) AS customer_id, customer_number, first_name, last_name,
       cast(NULL AS varchar) AS country, cast(NULL AS varchar) AS marital_status,
       cast(NULL AS varchar) AS gender, birthdate, cast(NULL AS date) AS create_date
FROM customers""",
    "load_dim_products": _with()
    + f"""SELECT product_key, cast(NULL AS bigint) AS product_id,
       concat('"', p_brand, '", size ', p_size) AS product_number, product_name,
       cast(NULL AS varchar) AS category_id, category, cast(NULL AS varchar) AS subcategory,
       CASE p_size % 3 WHEN 0 THEN true WHEN 1 THEN false END AS maintenance,
       {_money('cost')} AS cost, CASE WHEN p_size % 5 = 0 THEN '' ELSE 'n/a' END AS product_line,
       cast(NULL AS date) AS start_date
FROM products JOIN part ON product_key = p_partkey""",
    "load_fact_sales": _with()
    + f"""SELECT order_number, product_key, customer_key, order_date, shipping_date,
       cast(NULL AS date) AS due_date, {_money('sales_amount')} AS sales_amount,
       cast(quantity AS bigint) AS quantity, {_money('price')} AS price,
       cast(year(order_date) AS bigint) AS order_year
FROM sales""",
    "load_unknown_keys": _with()
    + """SELECT 'customer_key' AS key_name, customer_key AS key_value, count(*) AS lines FROM sales
WHERE customer_key NOT IN (SELECT customer_key FROM customers) GROUP BY customer_key
UNION ALL
SELECT 'product_key', product_key, count(*) FROM sales
WHERE product_key NOT IN (SELECT product_key FROM products) GROUP BY product_key""",
}
