"""Period calendar: roll-up table, period resolver, fiscal-week map, year axis, clamp,
dense month spine.

All of these run on dimension-sized frames (days, weeks, months, snapshot periods), never
on facts. Scalars that steer plan shape (previous periods, bounds) are collected to the
driver by one small aggregate each.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourglass.functions import left, min2, max2, right
from hourglass.operators import ordinal, range_join_days, running_total
from hourglass.params import NARROW_MODES, REPORT_BASE_YEAR, WIDE_MODES, ResolvedPeriods

# Monthly snapshot names that close a quarter, and the quarter they close.
QUARTER_MONTHS = (("March", "Q1"), ("June", "Q2"), ("September", "Q3"), ("December", "Q4"))


def period_rollup_table(sp: DataFrame) -> DataFrame:
    """All snapshot periods, plus quarters and years derived from Monthly rows (one scan).

    Each input row is exploded into up to three (period, type) arms; the quarter and year
    arms exist only for Monthly rows whose name starts with a quarter-closing month.
    """
    name = F.col("SnapshotPeriod")
    year4 = right(name, 4)
    quarter = None
    for month, q in QUARTER_MONTHS:
        cond = name.startswith(month)
        quarter = F.when(cond, F.concat(year4, F.lit(q))) if quarter is None else quarter.when(cond, F.concat(year4, F.lit(q)))
    year = F.when(name.startswith("December"), year4)
    monthly = F.col("PeriodType") == "Monthly"
    arms = F.array(
        F.struct(name.alias("p"), F.col("PeriodType").alias("t"), F.lit(True).alias("k")),
        F.struct(quarter.alias("p"), F.lit("Quarter").alias("t"), (monthly & quarter.isNotNull()).alias("k")),
        F.struct(year.alias("p"), F.lit("Year").alias("t"), (monthly & year.isNotNull()).alias("k")),
    )
    return (sp.select(F.explode(arms).alias("a"), "SnapshotDate", "ActivityIsProcessed")
            .where(F.col("a.k"))
            .select(F.col("a.p").alias("SnapshotPeriod"), "SnapshotDate", F.col("a.t").alias("PeriodType"),
                    "ActivityIsProcessed"))


def resolve_periods(rollup: DataFrame, work_week: DataFrame, period_type: str, period: dt.date) -> ResolvedPeriods:
    """The seven scalars of the EV report (period, previous two, and their work weeks). Two
    aggregates over dimensions: the snapshots of the type before `period` (one date each, so
    the set is calendar-sized), then the work weeks."""
    d = F.col("SnapshotDate").cast("date")
    before = rollup.where((F.col("PeriodType") == period_type) & (d < F.lit(period).cast("date"))).agg(
        F.slice(F.sort_array(F.collect_set(d), asc=False), 1, 2).alias("d")).collect()[0]["d"]
    last, last2 = [*before, None, None][:2]
    start = F.col("WWStartDate")
    row = work_week.agg(*[F.max(F.when(start <= F.lit(x).cast("date"), F.col("WorkWeek"))).alias(name)
                          for x, name in ((period, "pw"), (last, "l1w"), (last2, "l2w"))]).collect()[0]
    return ResolvedPeriods(period, last, last2, row["pw"], row["l1w"], row["l2w"])


def fiscal_week_map(date_dim: DataFrame, work_week: DataFrame, half_open: bool = False) -> DataFrame:
    """Fiscal week -> work week by the fiscal week's last date in a closed 8-day window.

    A last date equal to the next week's start falls in two windows (two rows), as in the
    report; `half_open=True` gives one match.
    """
    ends = date_dim.groupBy("FiscalWeek").agg(F.max("Date").alias("Date"))
    joined = range_join_days(ends, "Date", work_week.select("WorkWeek", "WWStartDate"), "WWStartDate", 7,
                             how="left", half_open=half_open)
    return joined.select("FiscalWeek", "WorkWeek")


def clamp_year_month(fm: Column, report: str, min_year, max_year) -> tuple[Column, Column]:
    """(Year, Month) of a `YYYYMM` code clamped to the report's year axis.

    Modes 1-4 lift years before the base to (base, '01'); modes 0/5 lift years below the
    axis minimum to (min, '01') and years above the maximum to (max, '01'). A NULL bound
    clamps nothing on its side. Other modes pass the code through.
    """
    y, m = left(fm, 4), right(fm, 2)
    if report in NARROW_MODES:
        base = F.lit(REPORT_BASE_YEAR[report])
        return F.when(y < base, base).otherwise(y), F.when(y < base, F.lit("01")).otherwise(m)
    if report in WIDE_MODES:
        lo, hi = F.lit(min_year).cast("string"), F.lit(max_year).cast("string")
        year = F.when(y < lo, lo).when(y > hi, hi).otherwise(y)
        month = F.when(y < lo, F.lit("01")).when(y > hi, F.lit("01")).otherwise(m)
        return year, month
    return y, m


def year_axis(dates: DataFrame, report: str, base_year: str, date_col: str = "Date") -> DataFrame:
    """Distinct calendar years in the mode's range, numbered from 1 (Year string, rn bigint)."""
    years = dates.select(F.year(date_col).alias("y")).distinct()
    b = int(base_year)
    if report in WIDE_MODES:
        years = years.where((F.col("y") >= b - 3) & (F.col("y") <= b + 10))
    elif report in NARROW_MODES:
        years = years.where((F.col("y") >= b) & (F.col("y") <= b + 10))
    else:
        years = years.where(F.lit(False))
    return ordinal(years, ["y"]).select(F.col("y").cast("string").alias("Year"), "rn")


def axis_bounds(axis: DataFrame) -> tuple[Column, Column]:
    """(year of rn 1, year of rn 7) as scalar subqueries: NULL when the axis is shorter; Spark
    raises when the axis holds such a number twice. Nothing runs before the caller's action."""
    first, last = (axis.where(F.col("rn") == n).select("Year").scalar() for n in (1, 7))
    return first, last


def spine_bounds(graph_start: str, graph_end: str, data_min, data_max) -> tuple[Column, Column]:
    """`CASE WHEN gs < MIN THEN gs ELSE MIN END` and its max twin (NULL-sensitive)."""
    return (min2(F.lit(graph_start), F.lit(data_min).cast("string")),
            max2(F.lit(graph_end), F.lit(data_max).cast("string")))


def dense_month_spine(calendar: DataFrame, hours: DataFrame, lo: Column, hi: Column) -> DataFrame:
    """Every fiscal month in [lo, hi] with its hours (0 where absent), numbered, with a
    running total. `hours` has (FM, Hours), one row per FM."""
    months = calendar.select("FiscalMonth").where(F.col("FiscalMonth").between(lo, hi)).distinct()
    spine = months.join(hours, months.FiscalMonth == hours.FM, "left").select(
        F.col("FiscalMonth").alias("FM"), F.coalesce(F.col("Hours"), F.lit(0)).cast("decimal(17,6)").alias("Hours"))
    spine = ordinal(spine, ["FM"], "id")
    return running_total(spine, "id", "Hours", "Cumm_Hrs").select(
        "id", "FM", "Hours", F.col("Cumm_Hrs").cast("decimal(38,6)").alias("Cumm_Hrs"))


def previous_periods_all(rollup: DataFrame, period_type: str, work_week: DataFrame) -> DataFrame:
    """The period resolver for every snapshot of a type at once.

    Per snapshot date: the previous and second-previous snapshot (strictly before) and the
    work week of each (`MAX(WorkWeek) WHERE WWStartDate <= d`). Runs on the distinct
    snapshot dates (a dimension); the week lookups are as-of running maxima over the
    date-ordered union of dates and work weeks, so no (date, week) pairs are formed."""
    from pyspark.sql import Window

    from hourglass.operators import asof_max

    dates = (rollup.where(F.col("PeriodType") == period_type).select(F.col("SnapshotDate").cast("date").alias("SnapshotDate"))
             .where(F.col("SnapshotDate").isNotNull()).distinct())
    w = Window.orderBy("SnapshotDate")
    out = dates.select("SnapshotDate", F.lag("SnapshotDate", 1).over(w).alias("last_period"),
                       F.lag("SnapshotDate", 2).over(w).alias("last2_period"))
    for col, name in (("SnapshotDate", "period_week"), ("last_period", "last_period_week"),
                      ("last2_period", "last2_period_week")):
        out = asof_max(out, col, work_week, "WWStartDate", "WorkWeek", name)
    return out
