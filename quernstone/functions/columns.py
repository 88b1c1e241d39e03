"""Column expressions used by several queries."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def money(column: str) -> Column:
    """A double as an exact decimal with two places, so that sums don't depend on their order."""
    return F.col(column).cast("decimal(18,2)")


def dot(a: Column, b: Column) -> Column:
    """The inner product of two arrays, in double precision."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)
