"""Snapshot month matrix: one row, one column per month step from the first to the last
snapshot, holding the snapshot's ordinal."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourglass.functions import mdy
from hourglass.operators import dynamic_pivot, month_steps, ordinal


def snapshot_ordinals(df: DataFrame, date_col: str = "SNAPSHOT_DATE") -> DataFrame:
    """Distinct snapshot dates numbered in date order (NULL first). Distinct dates are
    few (one per snapshot), so the global ordering runs on a small frame."""
    return ordinal(df.select(date_col).distinct(), [date_col], "RowNum")


def snapshot_month_matrix(df: DataFrame, project: str = "73113", date_col: str = "SNAPSHOT_DATE",
                          match: str = "exact") -> DataFrame:
    """The report's pivot. Steps are iterated month additions from the first snapshot
    (31 Jan -> 28 Feb -> 28 Mar); a step's column holds the ordinal of the snapshot taken
    exactly at midnight of that day (`match='exact'`), or of the snapshot in that month
    (`match='month'`). No steps (no data, or a NULL first date) -> an empty result."""
    aa = snapshot_ordinals(df, date_col)
    row = aa.agg(
        F.max(F.when(F.col("RowNum") == 1, F.col(date_col))).alias("start"),
        F.count(date_col).alias("n"),
    ).collect()[0]
    start, n = row["start"], row["n"]
    end = None
    if n:
        end = aa.where(F.col("RowNum") == n).select(date_col).collect()[0][0]
    to_date = (lambda v: v.date() if isinstance(v, dt.datetime) else v)
    steps = month_steps(to_date(start), to_date(end)) if start is not None and end is not None else []
    if start is not None and isinstance(start, dt.datetime) and end is not None and start > end:
        steps = []
    if not steps:
        schema = T.StructType([T.StructField("ProjectNumber", T.StringType(), False)])
        return df.sparkSession.createDataFrame([], schema)
    labels = [s.strftime("%m/%d/%Y") for s in steps]
    d = F.col(date_col)
    if match == "month":
        values = {}
        for s, lab in zip(steps, labels):
            values.setdefault((s.year, s.month), lab)
        lbl = F.lit(None).cast("string")
        for (y, m), lab in values.items():
            lbl = F.when((F.year(d) == y) & (F.month(d) == m), F.lit(lab)).otherwise(lbl)
    else:
        lbl = F.when(F.to_timestamp(F.to_date(d)).cast("timestamp_ntz") == d.cast("timestamp_ntz"), mdy(d))
    src = aa.withColumn("lbl", lbl)
    out = dynamic_pivot(src, [F.lit(project).alias("ProjectNumber")], "lbl", labels,
                        F.avg("RowNum").cast("long"), labels=labels)
    return out
