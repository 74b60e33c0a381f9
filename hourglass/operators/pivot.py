"""Dynamic pivot: the column list comes from the data."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame


def month_steps(start: dt.date | None, end: dt.date | None) -> list[dt.date]:
    """`WHILE @d <= @end ... @d = DATEADD(mm, 1, @d)`: iterated monthly steps.

    Iterating (not `start + k months`) reproduces the drift 31 Jan -> 28 Feb -> 28 Mar.
    A NULL bound yields no steps. Bounded by the number of months between two snapshot
    dates, so the list is small.
    """
    if start is None or end is None:
        return []
    out, d = [], start
    while d <= end:
        out.append(d)
        y, m = (d.year + (d.month // 12), d.month % 12 + 1)
        last = (dt.date(y + (m // 12), m % 12 + 1, 1) - dt.timedelta(days=1)).day
        d = dt.date(y, m, min(d.day, last))
    return out


def dynamic_pivot(
    df: DataFrame,
    group: Sequence[Column],
    pivot_col: str,
    values: Sequence,
    agg: Column,
    labels: Sequence[str] | None = None,
) -> DataFrame:
    """`PIVOT (agg FOR pivot_col IN (values))` with the value list always given, so Spark
    skips its own distinct-values job and `spark.sql.pivotMaxValues` never truncates."""
    out = df.groupBy(*group).pivot(pivot_col, list(values)).agg(agg)
    if labels is not None:
        n_group = len(out.columns) - len(values)
        renamed = out.columns[:n_group] + list(labels)
        out = out.toDF(*renamed)
    return out
