"""Business labels. Thresholds are arguments; the defaults are the usual ones.

In every rule the last label also takes NULL input.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Default thresholds and label texts.
COST_EDGES = (100, 500, 1000)
SPEND_LIMIT = 5000
TENURE_DAYS = 365
TENURE_MONTHS = 12
VIP, REGULAR, NEW = "VIP", "Regular", "New"
AGE_GROUPS = {20: "Under 20", 30: "20-29", 40: "30-39", 50: "40-49"}
OLDEST = "50 and above"
AGAINST_MEAN = ("Above Average", "Below Average", "AVG")
AGAINST_PREVIOUS = ("Increase", "Decrease", "no change")


def cost_range(cost: Column, edges: tuple[int, int, int] = COST_EDGES) -> Column:
    """A value on an edge belongs to the range below it, except on the lowest edge."""
    low, middle, high = edges
    return (
        F.when(cost < low, f"Below {low}")
        .when(cost <= middle, f"{low}-{middle}")
        .when(cost <= high, f"{middle}-{high}")
        .otherwise(f"Above {high}")
    )


def segment_by_days(
    spending: Column, days: Column, spend_limit=SPEND_LIMIT, tenure_days=TENURE_DAYS
) -> Column:
    """Long-standing customers split at the spend limit, the limit itself being Regular."""
    loyal = days >= tenure_days
    return (
        F.when(loyal & (spending > spend_limit), VIP)
        .when(loyal & (spending <= spend_limit), REGULAR)
        .otherwise(NEW)
    )


def segment_by_months(
    spending: Column, months: Column, spend_limit=SPEND_LIMIT, tenure_months=TENURE_MONTHS
) -> Column:
    """As ``segment_by_days``, but a spend of exactly the limit is New."""
    loyal = months >= tenure_months
    return (
        F.when(loyal & (spending > spend_limit), VIP)
        .when(loyal & (spending < spend_limit), REGULAR)
        .otherwise(NEW)
    )


def age_group(age: Column) -> Column:
    """The first group whose limit the age is below."""
    found = [F.when(age < limit, name) for limit, name in AGE_GROUPS.items()]
    return F.coalesce(*found, F.lit(OLDEST))


def by_sign(difference: Column, names: tuple[str, str, str]) -> Column:
    """Names for a positive difference, a negative one, and none."""
    positive, negative, none = names
    return F.when(difference > 0, positive).when(difference < 0, negative).otherwise(none)
