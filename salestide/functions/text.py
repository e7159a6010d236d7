"""Text building."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def join_text(*parts: Column) -> Column:
    """Parts put side by side, NULL parts counting as empty text."""
    return F.concat_ws("", *[part.cast("string") for part in parts])
