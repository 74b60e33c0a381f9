"""Named sources and scans.

`ProjectSources` carries the report's source views as DataFrames (schemas in FIXTURES.md).
On a cluster these are parquet/Delta tables partitioned by `Snapshot_Date`; the scans below
filter on that column so Spark prunes partitions and pushes the rest into the reader.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from dataclasses import dataclass, fields

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass
class ProjectSources:
    # dimensions
    snapshot_period: DataFrame | None = None
    time_phase_period: DataFrame | None = None
    date_dim: DataFrame | None = None
    work_week: DataFrame | None = None
    project_master: DataFrame | None = None
    project_master_ext: DataFrame | None = None
    fin_source_system: DataFrame | None = None
    resource_code_weekly: DataFrame | None = None
    # schedule facts
    activity_l2_daily: DataFrame | None = None
    activity_l2_weekly: DataFrame | None = None
    activity_l3_daily: DataFrame | None = None
    activity_l3_weekly: DataFrame | None = None
    time_phase_daily: DataFrame | None = None
    time_phase_weekly: DataFrame | None = None
    time_phase_baseline: DataFrame | None = None
    time_phase_baseline_weekly: DataFrame | None = None
    resource_assignment_l3_weekly: DataFrame | None = None
    wbs_monthly: DataFrame | None = None
    # actual-hour feeds
    weekly_burden: DataFrame | None = None
    wbs_lookup: DataFrame | None = None
    actual_hour: DataFrame | None = None
    fin_transaction: DataFrame | None = None
    timesheet: DataFrame | None = None

    @classmethod
    def from_paths(cls, spark: SparkSession, paths: dict[str, str], fmt: str = "parquet") -> "ProjectSources":
        names = {f.name for f in fields(cls)}
        return cls(**{k: spark.read.format(fmt).load(v) for k, v in paths.items() if k in names})


def snapshot_scan(df: DataFrame, dates, col: str = "Snapshot_Date") -> DataFrame:
    """Rows of one or several snapshots (`= @p` / `= @p OR = @last`); NULL dates select nothing."""
    if isinstance(dates, (dt.date, str)) or dates is None:
        dates = [dates]
    wanted = [d for d in dates if d is not None]
    if not wanted:
        return df.where(F.lit(False))
    return df.where(F.col(col).isin(wanted))


def window_scan(df: DataFrame, start, end, col: str = "Snapshot_Date") -> DataFrame:
    """`col >= start AND col <= end` (the resource profile's last-8-days window)."""
    return df.where((F.col(col) >= F.lit(start)) & (F.col(col) <= F.lit(end)))


def live_scan(df: DataFrame, col: str = "Snapshot_Period") -> DataFrame:
    return df.where(F.col(col) == F.lit("Live"))


def stage(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """`SELECT ... INTO #t` in memory: a relation that is read more than once before its caller
    unpersists it. Columns are pruned first (a staged `SELECT *` would keep every column);
    partitions that do not fit spill, and a lost executor's blocks are computed again. For
    relations of frames that are handed out before they run, see `sources.staging`."""
    if columns is not None:
        df = df.select(*columns)
    return df.persist(StorageLevel.MEMORY_AND_DISK)
