"""Places of regular expression matches, in DataFrame functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = "struct<start:int,end:int,found:string>"


def spans(text: Column, pattern: Column | str) -> Column:
    """All matches, left to right and without overlap, as an array of ``SPAN``.

    Places are code points from 0, the end exclusive. The text between the matches, as
    ``split`` gives it, says where each one begins. ``text`` must be a column.
    """
    given = F.lit(pattern) if isinstance(pattern, str) else pattern
    found = F.regexp_extract_all(text, given, F.lit(0))
    between = F.split(text, given, -1)
    nothing = F.struct(
        F.lit(0).alias("at"), F.array().cast(f"array<{SPAN}>").alias("spans")
    )

    def add(state: Column, pair: Column) -> Column:
        start = state["at"] + F.length(pair["between"])
        end = start + F.length(pair["found"])
        one = F.struct(start.alias("start"), end.alias("end"), pair["found"].alias("found"))
        more = F.when(pair["found"].isNull(), state["spans"])
        return F.struct(
            end.alias("at"), more.otherwise(F.array_append(state["spans"], one)).alias("spans")
        )

    pairs = F.arrays_zip(between.alias("between"), found.alias("found"))
    placed = F.aggregate(pairs, nothing, add, lambda state: state["spans"])
    return F.when(F.size(found) > 0, placed).otherwise(F.array().cast(f"array<{SPAN}>"))
