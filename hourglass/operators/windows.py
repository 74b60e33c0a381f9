"""Ordinals and running totals over ordered period lists.

The frames these run on are already reduced to periods (months, years, snapshot dates):
hundreds of rows. A global window puts them in one partition, which is right at that size
and wrong on a fact; callers reduce first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def ordinal(df: DataFrame, order: Sequence[str], name: str = "rn") -> DataFrame:
    """`ROW_NUMBER() OVER (ORDER BY order)` as bigint."""
    w = Window.orderBy(*[F.col(c).asc_nulls_first() for c in order])
    return df.withColumn(name, F.row_number().over(w).cast("long"))


def running_total(df: DataFrame, order: str, value: str, name: str) -> DataFrame:
    """`(SELECT SUM(ISNULL(b.v,0)) FROM t b WHERE b.id <= a.id)`: a window sum, O(n log n),
    instead of the triangular self-join."""
    w = Window.orderBy(F.col(order)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn(name, F.sum(F.coalesce(F.col(value), F.lit(0))).over(w))
