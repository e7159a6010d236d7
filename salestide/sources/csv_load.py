"""CSV files to typed Parquet tables.

Every field is read as text and converted here, so a bad value stops the load with a
message instead of turning into NULL, whatever the session's ANSI setting is.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salestide.sources import schema

# Accepted spellings of a boolean, upper and lower case alike.
TRUE_TEXT = ("true", "tru", "tr", "t", "yes", "ye", "y", "on", "1")
FALSE_TEXT = ("false", "fals", "fal", "fa", "f", "no", "n", "off", "of", "0")

# A whole date and nothing else; a cast alone would also take 2010, 2010-12 or a time.
DATE = "^[0-9]{4,}-[0-9]{1,2}-[0-9]{1,2}$"

# What the parser hands over for a blank field. A character that text does not hold
# keeps a blank (NULL) and "" (empty text) apart.
NULL_MARK = "\u0001"


def _stop(raw: Column, problem: str) -> Column:
    return F.raise_error(F.concat(F.lit(f"{problem}: "), raw))


def _boolean(raw: Column) -> Column:
    word = F.lower(F.trim(raw))
    return F.when(word.isin(*TRUE_TEXT), True).when(word.isin(*FALSE_TEXT), False)


def typed_column(field: T.StructField) -> Column:
    """A text column converted to its declared type; NULL stays NULL."""
    raw = F.col(field.name)
    if isinstance(field.dataType, T.VarcharType):
        # Blanks beyond the declared length are cut off, anything else is an error.
        limit = field.dataType.length
        value = F.when(F.length(F.rtrim(raw)) <= limit, F.substring(raw, 1, limit))
        problem = f"{field.name} is longer than {limit} characters"
    else:
        value = raw.try_cast(field.dataType)
        if isinstance(field.dataType, T.BooleanType):
            value = _boolean(raw)
        elif isinstance(field.dataType, T.DateType):
            value = F.when(F.trim(raw).rlike(DATE), F.trim(raw).try_cast(field.dataType))
        problem = f"{field.name} is not a valid {field.dataType.simpleString()}"
    checked = F.when(raw.isNull() | value.isNotNull(), value).otherwise(_stop(raw, problem))
    return checked.alias(field.name)


def breaks_inside_quotes(spark: SparkSession, path: str) -> bool:
    """Whether a quoted field of a CSV file or folder may hold a line break.

    A line that ends inside quotes holds an odd number of them, since a quote within quotes is
    doubled. The lines are read in parallel, and the search ends at the first such line.
    """
    line = F.col("value")
    quotes = F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))
    return not spark.read.text(path).filter(quotes % 2 == 1).isEmpty()


def read_csv(
    spark: SparkSession, path: str, columns: T.StructType, multi_line: bool | None = None
) -> DataFrame:
    """Typed rows of a CSV file or folder with a header line.

    Columns match by position, a blank field is NULL, ``""`` is empty text and a
    doubled quote stands for one quote. ``multi_line`` allows line breaks inside
    quotes, at the price of one task per file; unless given, the files are searched
    for such breaks first. A break of two characters inside quotes is read as one
    line feed.
    """
    if multi_line is None:
        multi_line = breaks_inside_quotes(spark, path)
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in columns.fields])
    raw = spark.read.csv(
        path,
        schema=text,
        header=True,
        mode="FAILFAST",
        quote='"',
        escape='"',
        nullValue=NULL_MARK,
        multiLine=multi_line,
    )
    return raw.select(*[typed_column(field) for field in columns.fields])


def write_table(rows: DataFrame, warehouse: str, name: str) -> None:
    """Replace one table. Sales are stored by order year.

    ``rebalance`` gathers each year into files of AQE's advisory size and splits a
    year that holds far more rows than the others.
    """
    target = f"{warehouse}/{name}"
    if name == schema.SALES_TABLE:
        by_year = rows.withColumn(schema.ORDER_YEAR, F.year("order_date"))
        writer = by_year.hint("rebalance", schema.ORDER_YEAR).write.partitionBy(schema.ORDER_YEAR)
    else:
        writer = rows.write
    writer.mode("overwrite").parquet(target)


def _swap(spark: SparkSession, staged: Mapping[str, str]) -> None:
    """Put staged folders in the place of tables, given as ``{table folder: staged folder}``.

    Every old folder is moved aside before its successor moves in, and deleted at the end. If a
    move fails, all moves made so far are taken back, the last one first.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs
    undo: list[tuple[str, str]] = []

    def move(source: str, target: str) -> None:
        path = hadoop.Path(source)
        files = path.getFileSystem(spark._jsc.hadoopConfiguration())
        if not files.rename(path, hadoop.Path(target)):
            raise OSError(f"{source} could not be moved to {target}")
        undo.append((target, source))

    def exists(name: str) -> bool:
        path = hadoop.Path(name)
        return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)

    old = []
    try:
        for target, new in staged.items():
            if exists(target):
                move(target, f"{new}-old")
                old.append(f"{new}-old")
            move(new, target)
    except Exception:
        for source, target in list(reversed(undo)):
            move(source, target)
        raise
    for name in old:
        _drop(spark, name)


def _drop(spark: SparkSession, name: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def load_star(
    spark: SparkSession,
    files: Mapping[str, str],
    warehouse: str,
    tables: Mapping[str, T.StructType] = schema.TABLES,
    multi_line: bool | None = None,
) -> None:
    """Load CSV files, given as ``{table name: path}``, replacing what was there.

    All tables are written beside the old ones first. A bad value in any of them, or a move that
    fails, stops the load with all old tables as they were and nothing left beside them.
    """
    mark = f".new-{uuid.uuid4().hex}"
    staged = {f"{warehouse}/{name}": f"{warehouse}/{mark}/{name}" for name in tables if name in files}
    try:
        for name, columns in tables.items():
            if name in files:
                _write_staged(spark, files[name], columns, f"{warehouse}/{mark}", name, multi_line)
        _swap(spark, staged)
    finally:
        _drop(spark, f"{warehouse}/{mark}")


def _write_staged(
    spark: SparkSession, file: str, columns: T.StructType, folder: str, name: str, multi_line: bool | None
) -> None:
    try:
        write_table(read_csv(spark, file, columns, multi_line), folder, name)
    except Exception as problem:
        if "MALFORMED" in str(problem) and multi_line is False:
            hint = "a quoted line break needs multi_line (no --no-multi-line)"
            raise ValueError(f"{file} has a malformed row; {hint}") from problem
        raise
