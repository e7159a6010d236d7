"""Exact decimal ratios, rounded half away from zero.

Spark cuts the scale of a wide decimal quotient to 6-8 digits. Rounding that again
can tip a value over the half, and ``avg`` on a decimal has the same flaw. Here the
quotient is split into its whole part and its remainder, which are both exact.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_ratio(numerator: Column, denominator: Column, places: int) -> Column:
    """``numerator / denominator`` rounded once, to ``places`` digits.

    Pass plain columns: each one is used several times. A zero denominator raises
    under ANSI mode, as a division would.
    """
    scaled = numerator * F.lit(10**places).cast("decimal(18,0)")
    rest = scaled % denominator
    whole = ((scaled - rest) / denominator).cast("decimal(38,0)")
    away_from_zero = F.signum(scaled) * F.signum(denominator)
    step = F.when(F.abs(rest) * 2 >= F.abs(denominator), away_from_zero).otherwise(0)
    units = whole + step.cast("decimal(1,0)")
    return (units / F.lit(10**places)).cast(f"decimal(38,{places})")


def round_mean(total: Column, count: Column, places: int) -> Column:
    """Mean from a sum and a count of the same values; NULL when there were none."""
    return round_ratio(total, F.nullif(count, F.lit(0)).cast("decimal(20,0)"), places)
