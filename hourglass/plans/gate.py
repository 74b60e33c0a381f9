"""Source gate: Live/Daily sources unless the period is a processed weekly snapshot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def processed_weekly(snapshot_period: DataFrame) -> DataFrame:
    return snapshot_period.where((F.col("PeriodType") == "Weekly") & (F.col("ActivityIsProcessed") == 1)).select(
        F.col("SnapshotDate").cast("date").alias("d"))


def use_live_sources(snapshot_period: DataFrame, period) -> bool:
    """`@period NOT IN (processed weekly dates)` evaluated with three-valued logic.

    TRUE -> Live/Daily; FALSE or UNKNOWN -> Weekly.
    """
    row = processed_weekly(snapshot_period).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("d") == F.lit(period).cast("date")).alias("hit"),
        F.count_if(F.col("d").isNull()).alias("nulls"),
    ).collect()[0]
    if row["n"] == 0:
        return True
    if period is None:
        return False
    return row["hit"] == 0 and row["nulls"] == 0


def gate_frame(probes: DataFrame, probe_col: str, snapshot_period: DataFrame) -> DataFrame:
    """The gate for many candidate periods at once: adds `branch` ('Daily' or 'Weekly').

    The processed list is reduced to distinct dates and joined (not collected); a one-row
    summary carries the emptiness and NULL facts NOT IN needs.
    """
    dates = processed_weekly(snapshot_period).distinct()
    summary = dates.agg(F.count(F.lit(1)).alias("_n"), F.count_if(F.col("d").isNull()).alias("_nulls"))
    hits = dates.where(F.col("d").isNotNull()).select(F.col("d").alias("_hit"))
    p = F.col(probe_col).cast("date")
    j = probes.join(hits, p == F.col("_hit"), "left").crossJoin(F.broadcast(summary))
    not_in: Column = (F.col("_n") == 0) | (p.isNotNull() & F.col("_hit").isNull() & (F.col("_nulls") == 0))
    return j.select(*probes.columns, F.when(not_in, "Daily").otherwise("Weekly").alias("branch"))
