"""Load tables and run analyses from the command line or ``spark-submit``.

    python -m salestide load --warehouse W --customers C.csv --products P.csv --sales S.csv
    python -m salestide run perf_yoy report_customer --warehouse W --output R
    python -m salestide publish gold.report_customer --warehouse W
    python -m salestide list
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salestide.functions import labels
from salestide.plans import reports
from salestide.plans.catalog import ANALYSES, Options
from salestide.session import builder
from salestide.sources.checks import repeated_keys, unknown_keys
from salestide.sources.csv_load import load_star
from salestide.sources.star import open_star, register_star


def _arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="salestide")
    commands = parser.add_subparsers(dest="command", required=True)

    load = commands.add_parser("load", help="replace the tables with the content of CSV files")
    load.add_argument("--warehouse", required=True)
    for table in ("customers", "products", "sales"):
        load.add_argument(f"--{table}", required=True, help="CSV file or folder")
    load.add_argument(
        "--multi-line",
        action=argparse.BooleanOptionalAction,
        help="whether quotes hold line breaks; unless given, the files are searched for them",
    )

    run = commands.add_parser("run", help="run analyses on the loaded tables")
    run.add_argument("names", nargs="+", choices=list(ANALYSES), metavar="NAME")
    run.add_argument("--warehouse", required=True)
    run.add_argument("--output", help="folder for Parquet results; without it rows are shown")
    run.add_argument("--rows", type=int, help="show only so many rows; all by default")

    publish = commands.add_parser(
        "publish", help="store the customer report in the session's catalog, beside the tables"
    )
    publish.add_argument("name", help="database and table, such as gold.report_customer")
    publish.add_argument("--warehouse", required=True)
    publish.add_argument("--view", action="store_true", help="a lasting view that follows later loads and the date")

    for command in (run, publish):
        command.add_argument("--as-of", help="day for ages and recency, the current date by default")
        command.add_argument("--spend-limit", type=int, default=labels.SPEND_LIMIT)
        command.add_argument("--tenure-days", type=int, default=labels.TENURE_DAYS)
        command.add_argument("--tenure-months", type=int, default=labels.TENURE_MONTHS)

    commands.add_parser("list", help="name the analyses")
    return parser


def _show(rows: DataFrame, count: int | None) -> None:
    """All rows as tab-separated lines, one partition at a time, or a table of a few."""
    if count is not None:
        rows.show(count, truncate=False)
        return
    print("\t".join(rows.columns))
    for row in rows.toLocalIterator():
        print("\t".join("" if value is None else str(value) for value in row))


def _report_faults(spark: SparkSession, warehouse: str) -> None:
    """Keys that the loaded tables share or lack. The analyses accept both."""
    star = open_star(spark, warehouse)
    for dimension, key in ((star.customers, "customer_key"), (star.products, "product_key")):
        repeated = repeated_keys(dimension, key).count()
        unknown = unknown_keys(star.sales, dimension, key)
        keys, lines = unknown.agg(F.count("*"), F.sum("lines")).first()
        print(f"{key}: {repeated} repeated, {keys} unknown in {lines or 0} lines")


def main(words: list[str] | None = None) -> None:
    given = _arguments().parse_args(words)
    if given.command == "list":
        print("\n".join(ANALYSES))
        return

    spark = builder("salestide").getOrCreate()
    if given.command == "load":
        files = {
            "dim_customers": given.customers,
            "dim_products": given.products,
            "fact_sales": given.sales,
        }
        load_star(spark, files, given.warehouse, multi_line=given.multi_line)
        _report_faults(spark, given.warehouse)
        return

    options = Options(given.as_of, given.spend_limit, given.tenure_days, given.tenure_months)
    star = open_star(spark, given.warehouse)
    if given.command == "publish":
        database = given.name.rpartition(".")[0] or "default"
        register_star(spark, given.warehouse, database)
        if given.view:
            limits = {"spend_limit": given.spend_limit, "tenure_months": given.tenure_months}
            reports.publish_lasting_view(spark, given.warehouse, given.name, **limits)
            return
        reports.publish_table(ANALYSES["report_customer"](star, options), given.name)
        return
    for name in given.names:
        result = ANALYSES[name](star, options)
        if given.output:
            result.write.mode("overwrite").parquet(f"{given.output}/{name}")
        else:
            print(name)
            _show(result, given.rows)


if __name__ == "__main__":
    main()
