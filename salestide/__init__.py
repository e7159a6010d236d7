"""Sales analytics over a star schema, written as plain Spark DataFrame jobs."""

from salestide.sources.star import Star

__all__ = ["Star"]
