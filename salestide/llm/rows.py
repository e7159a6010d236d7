"""Small helpers for operators that must keep every column they are given."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()


def fresh(rows: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of the rows has it, whatever the case."""
    taken = {column.lower() for column in rows.columns}
    while name.lower() in taken:
        name += "_"
    return name


def named(rows: DataFrame, **columns: str) -> DataFrame:
    """Only the given columns, under the operator's own names: ``named(docs, id="doc_id")``."""
    return rows.select(*[rows[given].alias(own) for own, given in columns.items()])


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    return F.translate(text, UPPER, LOWER)
