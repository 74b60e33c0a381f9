"""The typed ledger of the EV report: one long table of (project, activity, PIEPCCC, work
week, Type) rows with Hours and HoursLTD.

One pipeline serves both variants of the report; `Branch` carries their differences
(Live/Daily or Weekly sources). Arms that the report computes by re-reading the same join
(Forecast, Remaining and the two burn-rate levels) share one join and one partial
aggregate here.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourglass.functions import concat_null, first_char_in, in_list, isnull, lacks_suffix
from hourglass.functions.nulls import LITERALS, parameter_table
from hourglass.operators import (append_typed, first_source_rows, join_to_few, keys_in_no_list, pre_aggregated_join, sum_of,
                                 top1_per_group, two_level_ratio)
from hourglass.params import ReportParams, ResolvedPeriods
from hourglass.plans.calendar import fiscal_week_map
from hourglass.sources.catalog import ProjectSources, live_scan, snapshot_scan
from hourglass.sources.comparison import FEED_KEY, WRITTEN
from hourglass.sources.staging import Staging

LEDGER_SCHEMA = T.StructType([
    T.StructField("ProjectNumber", T.StringType()),
    T.StructField("Activity_ID", T.StringType()),
    T.StructField("Activity_Name", T.StringType()),
    T.StructField("PIEPCCC", T.StringType()),
    T.StructField("WorkWeek", T.StringType()),
    T.StructField("Hours", T.DecimalType(19, 6)),
    T.StructField("HoursLTD", T.DecimalType(19, 6)),
    T.StructField("Type", T.StringType()),
])

# Ledger Type tags written by the report.
PLANNED, BUDGET, ACTUAL = "Planned", "Budget", "Actual"
FORECAST, FORECAST_LAST, BURN = "Forecast", "Forecast Last", "Forecast burned rate"
REMAINING, REMAINING_LAST, FORECAST_L3, EARNED = "Remaining", "Remaining Last", "Forecast L3", "Earned"
# Timesheet statuses that count as actual hours, and the finance source system whose
# transactions count (fixed values of the report).
TIMESHEET_STATUSES = ("APPROVED", "NEGATED", "PENDING")
FINANCE_SOURCE = "Tempus"
LABOUR = "RT_Labor"
L3_TYPES = ("TT_Task", "TT_LOE")

KEYS = ["ProjectNumber", "Activity_ID", "Activity_Name", "PIEPCCC", "WorkWeek"]


@dataclass
class Branch:
    """Source choices of one report variant."""

    src: ProjectSources
    params: ReportParams
    periods: ResolvedPeriods
    live: bool

    def need(self, name: str) -> DataFrame:
        """A source view, or a clear error naming it when the caller did not supply it."""
        df = getattr(self.src, name)
        if df is None:
            branch = "Live/Daily" if self.live else "Weekly"
            raise ValueError(f"the {branch} report needs the source view '{name}'")
        return df

    # L2 activities "now": Live rows, or the weekly snapshot at the period
    def l2_now(self) -> DataFrame:
        if self.live:
            return live_scan(self.need("activity_l2_daily"))
        return snapshot_scan(self.need("activity_l2_weekly"), self.periods.period)

    def l2_last(self) -> DataFrame:
        return snapshot_scan(self.need("activity_l2_weekly"), self.periods.last_period)

    def tp_last(self) -> DataFrame:
        return snapshot_scan(self.need("time_phase_weekly"), self.periods.last_period)

    def baseline(self) -> DataFrame:
        if self.live:
            return self.need("time_phase_baseline")
        return snapshot_scan(self.need("time_phase_baseline_weekly"), self.periods.period)


#: columns of the L2 activities that any arm of the report reads
ACTIVITY_COLS = ["Snapshot_Date", "Activity_Key", "Activity_ID", "Activity_Name", "Activity_Type", "BR_ProjectNumber", "BR_PIEPCCC",
                 "BR_CM_ACTIVITY_LEVEL_Val", "BR_NR_EXECUTION_WINDOWS_Val", "BR_NR_LOE_WORK_Val", "BR_L2WorkPackage",
                 "BR_Percent_Complete", "ApprBL_Budgeted_Labor_Units", "RecBL_Budgeted_Labor_Units", "OrigBL_Budgeted_Labor_Units", "Finish", "Activity_ID" + WRITTEN, "Activity_Name" + WRITTEN]
#: what an activity row feeds, as bits of `arms`: the arms of this period (finish dates and
#: actual hours take its rows as they are), the scoped arms, the scoped arms without the
#: TT_WBS condition, the package map, the weekly burden
NOW, SCOPED, SCOPED_ANY_TYPE, MAPPED, BURDENED = 1, 2, 4, 8, 16
ARMS = "arms"


def _feeds(df: DataFrame, arm: int) -> Column | None:
    """Whether a row feeds the arm, where one pass has tagged the rows."""
    return F.col(ARMS).bitwiseAND(F.lit(arm)) != 0 if ARMS in df.columns else None


def _listed(df: DataFrame, column: str, values, flag: str) -> DataFrame:
    """`column IN (@multi)` as a flag. A long list is joined, as a subquery may only stand in
    a filter; its values are made distinct, so that no row is repeated."""
    if values is None or isinstance(values, str) or (not isinstance(values, DataFrame) and len(values) <= LITERALS):
        return df.withColumn(flag, F.coalesce(in_list(column, values), F.lit(False)))
    named = parameter_table(values).toDF("_value").distinct().withColumn(flag, F.lit(True))
    return df.join(named, F.col(column) == F.col("_value"), "left").withColumn(flag, F.coalesce(flag, F.lit(False))).drop("_value")


def tagged_activities(df: DataFrame, p: ReportParams, now: Column) -> DataFrame:
    """The L2 activity rows that feed any arm of the report, with the arms they feed as bits:
    every condition of the arms is evaluated here, once per row."""
    df = _listed(_listed(df, "BR_ProjectNumber", p.projects, "_project"), "BR_PIEPCCC", p.piepccc, "_pie")
    windowed = F.coalesce(lacks_suffix("BR_NR_EXECUTION_WINDOWS_Val"), F.lit(False))
    scoped = windowed & F.col("_project") & F.col("_pie") & F.coalesce(F.col("BR_CM_ACTIVITY_LEVEL_Val") == "2", F.lit(False))
    wbs = scoped & F.coalesce(F.col("Activity_Type") == "TT_WBS", F.lit(False))
    bits = [(NOW, now), (SCOPED, wbs), (SCOPED_ANY_TYPE, scoped), (MAPPED, F.col("_project")), (BURDENED, F.col("_project") & F.col("_pie"))]
    arms = None
    for bit, fed in bits:
        here = F.when(fed, bit).otherwise(0)
        arms = here if arms is None else arms.bitwiseOR(here)
    return df.select("*", arms.alias(ARMS)).where(F.col(ARMS) != 0).drop("_project", "_pie")


def share_activities(br: Branch, staging: Staging) -> Branch:
    """The branch with its L2 activities read once: the rows of this and the last period that
    feed any arm are tagged in one pass and stored, and all arms read what is stored. Weekly:
    one scan of two partitions; Live: the Live rows of the daily view and one partition of
    the weekly view."""
    per, s = br.periods, br.src
    extra = ["Snapshot_Period"] if br.live else []

    def part(df: DataFrame, now: Column, name: str, more: list[str]) -> DataFrame:
        cols = [c for c in [*ACTIVITY_COLS, *more] if c in df.columns]
        return staging.store(tagged_activities(df.select(*cols), br.params, now), name, partition_by="Snapshot_Date")

    if br.live:
        return replace(br, src=replace(s, activity_l2_daily=part(live_scan(br.need("activity_l2_daily")), F.lit(True), "activities-live", extra),
                                       activity_l2_weekly=part(br.l2_last(), F.lit(False), "activities-last", [])))
    both = snapshot_scan(br.need("activity_l2_weekly"), [per.period, per.last_period])
    return replace(br, src=replace(s, activity_l2_weekly=part(both, F.col("Snapshot_Date") == F.lit(per.period), "activities", [])))


def scope(df: DataFrame, p: ReportParams, wbs_only: bool = True, level: bool = True) -> DataFrame:
    """The report's L2 filter: level '2', TT_WBS, window code not ending in C, PIEPCCC and
    project lists. Rows that one pass has tagged already are told by their tag."""
    tag = _feeds(df, SCOPED if wbs_only else SCOPED_ANY_TYPE)
    if tag is not None and level:
        return df.where(tag)
    cond = lacks_suffix("BR_NR_EXECUTION_WINDOWS_Val") & in_list("BR_PIEPCCC", p.piepccc) & in_list(
        "BR_ProjectNumber", p.projects)
    if level:
        cond = cond & (F.col("BR_CM_ACTIVITY_LEVEL_Val") == "2")
    if wbs_only:
        cond = cond & (F.col("Activity_Type") == "TT_WBS")
    return df.where(cond)


def _arm(df: DataFrame, hours: Column, hours_ltd: Column, type_: str, week: Column | None = None) -> DataFrame:
    return df.select(
        F.col("ProjectNumber"), F.col("Activity_ID"), F.col("Activity_Name"), F.col("PIEPCCC"),
        (week if week is not None else F.col("WorkWeek")).alias("WorkWeek"),
        hours.alias("Hours"), hours_ltd.alias("HoursLTD"), F.lit(type_).alias("Type"))


def _stacked(g: DataFrame, arms: list[tuple[str, str, Column]], carry: tuple[str, ...] = ()) -> DataFrame:
    """Several ledger arms from one aggregate: each group row is exploded into one row per
    arm present in it (type tag, hours). Because every arm's column is consumed by the same
    plan, the aggregate (and the scan and join under it) runs once; separate filtered
    copies would each be pruned to their own column and computed again. `carry` keeps
    extra grouping columns for consumers that need them."""
    parts = F.array(*[F.struct(F.lit(tag).alias("t"), F.col(hours).cast("decimal(38,6)").alias("h"), present.alias("k"))
                      for tag, hours, present in arms])
    out = g.select(*KEYS, *carry, F.explode(parts).alias("_a")).where(F.col("_a.k"))
    return out.select(*KEYS, F.col("_a.h").alias("Hours"), F.lit(0).alias("HoursLTD"), F.col("_a.t").alias("Type"),
                      *carry)


def _act_cols(a: DataFrame) -> list[Column]:
    return [a.BR_ProjectNumber.alias("ProjectNumber"), a.Activity_ID, a.Activity_Name, a.BR_PIEPCCC.alias("PIEPCCC")]


# --------------------------------------------------------------------------------- maps

def work_package_map(br: Branch) -> DataFrame:
    """One L2 activity per (snapshot, L2 package): highest LOE flag, then lowest Activity_ID.

    Daily: Live rows and last week's rows are ranked separately and both kept; Weekly: the
    period's and last period's rows in one scan."""
    order = [("BR_NR_LOE_WORK_Val", True), ("Activity_ID", False)]
    cols = ["Snapshot_Date", "BR_L2WorkPackage", "Activity_ID", "Activity_Name", "BR_NR_LOE_WORK_Val"]
    if br.live:
        arms = [live_scan(br.src.activity_l2_daily), br.l2_last()]
    else:
        arms = [snapshot_scan(br.src.activity_l2_weekly, [br.periods.period, br.periods.last_period])]
    out = None
    for a in arms:
        proj = _feeds(a, MAPPED)
        if proj is None:
            proj = in_list("BR_ProjectNumber", br.params.projects)
        ranked = top1_per_group(a.where(proj).select(*cols), ["Snapshot_Date", "BR_L2WorkPackage"], order)
        out = ranked if out is None else out.unionByName(ranked)
    return out.withColumn("WorkPackage", concat_null(F.col("Activity_ID"), " - ", F.col("Activity_Name")))


def baseline_types(requested: str) -> tuple[str, str]:
    """The requested type and its fallback: 'Approved' for 'Recovery' and 'Homer' otherwise."""
    return requested, "Approved" if requested == "Recovery" else "Homer"


def baseline_selection(baseline: DataFrame, requested: str) -> DataFrame:
    """One baseline type per project among {requested, fallback}, highest name first.

    `max` per project equals the report's ROW_NUMBER ... ORDER BY BaselineType DESC = 1, as a
    partial aggregate."""
    return (baseline.where(F.col("BaselineType").isin(*baseline_types(requested)))
            .groupBy("Project_ID").agg(F.max("BaselineType").alias("BaselineType")))


# --------------------------------------------------------------------------- ledger arms

def planned_and_budget(br: Branch) -> list[DataFrame]:
    """Planned (chosen baseline) and Budget (Approved) hours per L2 activity and week.

    One scan of the baseline: its rows of the types in question are summed by activity,
    project, type and week, and both the choice of a type per project (over all rows, as
    `baseline_selection` makes it) and the labour hours are read off that aggregate. Both
    reads have one shape, so that its exchange runs once: they read all of its columns, the
    activity's key goes out as an aggregate and projects are compared null-safely, so that no
    join's null filter is pushed into one of them. One join to the activities and one aggregate with
    a conditional sum per arm, stacked into ledger rows; a group yields an arm row only if
    the arm had rows in it.
    """
    acts = scope(br.l2_now(), br.params, wbs_only=not br.live)
    a = acts.select("Activity_Key", "BR_ProjectNumber", "Activity_ID", "Activity_Name", "BR_PIEPCCC")
    offered = baseline_types(br.params.baseline_type)
    labour = F.col("BR_Resource_Type") == LABOUR
    bl = (br.baseline().where(F.col("BaselineType").isin(*dict.fromkeys([*offered, "Approved"])))
          .groupBy("Activity_Key", "Project_ID", "BaselineType", "BR_WorkWeek")
          .agg(F.sum(F.when(labour, F.col("Planned_Hours"))).alias("Planned_Hours"), F.count_if(labour).alias("n"),
               F.max("Activity_Key").alias("b_key")).drop("Activity_Key"))
    # types by project first, with a buffer that a hash table holds: the greatest struct would sort the whole aggregate
    present = bl.groupBy(F.col("Project_ID").alias("b_project"), F.col("BaselineType").alias("b_type")).agg(
        F.max(F.xxhash64("Planned_Hours", "n", "b_key", "BR_WorkWeek")).alias("_read"))
    pb = present.groupBy("b_project").agg(F.max(F.when(F.col("b_type").isin(*offered), F.struct("b_type", "_read"))).alias("_best"))
    shuffles = int(bl.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = bl.where(F.col("n") > 0).repartition(shuffles, "b_key")  # not merged into a few by compressed size
    j = join_to_few(dealt.join(a.hint("shuffle_hash"), F.col("b_key") == F.col("Activity_Key")), pb,
                    F.col("Project_ID").eqNullSafe(F.col("b_project")), how="left")
    is_planned = F.coalesce((F.col("BaselineType") == F.col("_best.b_type")) & F.col("Project_ID").isNotNull(), F.lit(False))
    is_budget = F.col("BaselineType") == "Approved"
    g = j.where(is_planned | is_budget).groupBy(*_act_cols(j), F.col("BR_WorkWeek").alias("WorkWeek")).agg(
        sum_of(j, "Planned_Hours", is_planned).alias("planned"), F.count_if(is_planned).alias("n_planned"),
        sum_of(j, "Planned_Hours", is_budget).alias("budget"), F.count_if(is_budget).alias("n_budget"))
    return [_stacked(g, [(PLANNED, "planned", F.col("n_planned") > 0), (BUDGET, "budget", F.col("n_budget") > 0)])]


L3_PART = "_l3"  # internal tag: L3 hours carried through the shared time-phase pass


def _l3_scope(l3: DataFrame, p: ReportParams) -> DataFrame:
    return l3.where((F.col("BR_IsOPGSupport") == 0) & in_list("BR_ProjectNumber", p.projects)
                    & lacks_suffix("BR_NR_EXECUTION_WINDOWS_Val") & in_list("BR_PIEPCCC", p.piepccc)
                    & F.col("Activity_Type").isin(*L3_TYPES))


def _credit_l3(l3_hours: DataFrame, package_map: DataFrame) -> DataFrame:
    """L3 hours (project, PIEPCCC, package, snapshot, week) credited to the mapped L2 package."""
    m = package_map.select(F.col("Snapshot_Date").alias("m_date"), F.col("BR_L2WorkPackage").alias("m_pkg"),
                           F.col("Activity_ID").alias("m_id"), F.col("Activity_Name").alias("m_name"))
    j = l3_hours.join(m, (F.col("pkg") == F.col("m_pkg")) & (F.col("Snapshot_Date") == F.col("m_date")), "left")
    act_id = isnull("m_id", concat_null(F.col("ProjectNumber"), F.col("PIEPCCC"), "xxxx"))
    g = j.groupBy("ProjectNumber", act_id.alias("Activity_ID"), isnull("m_name", "Not Available").alias("Activity_Name"),
                  "WorkWeek", "PIEPCCC").agg(F.sum("Hours").alias("h"))
    return _arm(g, F.col("h"), F.lit(0), FORECAST_L3)


def _burn(forecast_rows: DataFrame, p: ReportParams) -> DataFrame:
    fc = forecast_rows.withColumnRenamed("Hours", "h")
    burn = two_level_ratio(
        fc, ["ProjectNumber", "Activity_ID", "Activity_Name", "PIEPCCC"], ["ProjectNumber", "PIEPCCC"], "h",
        "WorkWeek", {"Activity_ID": "dummy", "Activity_Name": "dummy"}, out="rate")
    return _arm(burn, F.col("rate"), F.lit(0), BURN, week=F.lit(p.burn_week))


def weekly_time_phase_arms(br: Branch, package_map: DataFrame | None = None) -> dict[str, list[DataFrame]]:
    """Weekly branch: Forecast, Remaining, their Last twins, the burn rate and the L3
    roll-up from ONE read of the time-phase fact (this and last period's partitions).

    The fact is joined once to the union of this and last period's L2 activities and this
    period's L3 activities (tagged by level, on activity and snapshot), summed once, and
    every arm is stacked out of that aggregate; consumers read the stacked rows, so the
    aggregate's exchange is shared instead of the fact being read per arm."""
    p, per = br.params, br.periods
    both = [per.period, per.last_period]
    null_s = F.lit(None).cast("string")
    l2 = scope(snapshot_scan(br.need("activity_l2_weekly"), both), p).select(
        "Activity_Key", "Snapshot_Date", "BR_ProjectNumber", "Activity_ID", "Activity_Name", "BR_PIEPCCC",
        null_s.alias("pkg"), F.lit(2).alias("lvl"))
    l3 = _l3_scope(snapshot_scan(br.need("activity_l3_weekly"), per.period), p).select(
        "Activity_Key", "Snapshot_Date", "BR_ProjectNumber", null_s.alias("Activity_ID"), null_s.alias("Activity_Name"),
        "BR_PIEPCCC", F.col("BR_L2WorkPackage").alias("pkg"), F.lit(3).alias("lvl"))
    tp = snapshot_scan(br.need("time_phase_weekly"), both).where(F.col("BR_Resource_Type") == LABOUR)
    j = pre_aggregated_join(tp, l2.unionByName(l3), ["Activity_Key", "Snapshot_Date"],
                          ["Activity_Key", "Snapshot_Date", "BR_WorkWeek"], ["Planned_Hours", "Remaining_Hours"])
    g = j.groupBy(*_act_cols(j), F.col("BR_WorkWeek").alias("WorkWeek"), "Snapshot_Date", "pkg", "lvl").agg(
        sum_of(j, "Planned_Hours").alias("f"), sum_of(j, "Remaining_Hours").alias("r"))
    is_l2 = F.col("lvl") == 2
    now, last = F.col("Snapshot_Date") == F.lit(per.period), F.col("Snapshot_Date") == F.lit(per.last_period)
    stacked = _stacked(g, [(FORECAST, "f", is_l2 & now), (REMAINING, "r", is_l2 & now), (FORECAST_LAST, "f", is_l2 & last),
                           (REMAINING_LAST, "r", is_l2 & last), (L3_PART, "f", F.col("lvl") == 3)],
                       carry=("Snapshot_Date", "pkg"))
    ledger_rows = stacked.where(F.col("Type") != L3_PART).select(*KEYS, "Hours", "HoursLTD", "Type")
    burn = _burn(stacked.where(F.col("Type") == FORECAST), p)
    pm = package_map if package_map is not None else work_package_map(br)
    l3_arm = _credit_l3(stacked.where(F.col("Type") == L3_PART), snapshot_scan(pm, per.period))
    return {"forecast": [ledger_rows], "burn": [burn], "l3": [l3_arm]}


def live_time_phase_arms(br: Branch, package_map: DataFrame | None = None) -> dict[str, list[DataFrame]]:
    """Live/Daily branch: this period's Forecast and Remaining, the burn rate and the L3
    roll-up from ONE read of the daily time-phase fact; the "Last" arms read the weekly
    fact at the last period.

    The daily rows dated the period meet the Live L2 activities on the activity alone (as
    the report joins them); the Live daily rows meet the Live L3 activities on activity
    and snapshot. Both are one join on the activity key with a residual condition per
    level, summed once and stacked."""
    p, per = br.params, br.periods
    null_s = F.lit(None).cast("string")
    l2 = scope(live_scan(br.need("activity_l2_daily")), p).select(
        "Activity_Key", F.lit(None).cast("date").alias("a_date"), "BR_ProjectNumber", "Activity_ID", "Activity_Name",
        "BR_PIEPCCC", null_s.alias("pkg"), F.lit(2).alias("lvl"))
    l3 = _l3_scope(live_scan(br.need("activity_l3_daily")), p).select(
        "Activity_Key", F.col("Snapshot_Date").alias("a_date"), "BR_ProjectNumber", null_s.alias("Activity_ID"),
        null_s.alias("Activity_Name"), "BR_PIEPCCC", F.col("BR_L2WorkPackage").alias("pkg"), F.lit(3).alias("lvl"))
    tp = br.need("time_phase_daily").where(
        ((F.col("Snapshot_Date") == F.lit(per.period)) | (F.col("Snapshot_Period") == "Live"))
        & (F.col("BR_Resource_Type") == LABOUR))
    acts = l2.unionByName(l3).withColumnRenamed("Activity_Key", "a_key")
    on = (F.col("Activity_Key") == F.col("a_key")) & (
        ((F.col("lvl") == 2) & (F.col("Snapshot_Date") == F.lit(per.period)))
        | ((F.col("lvl") == 3) & (F.col("Snapshot_Period") == "Live") & (F.col("Snapshot_Date") == F.col("a_date"))))
    j = pre_aggregated_join(tp, acts, on, ["Activity_Key", "Snapshot_Date", "Snapshot_Period", "BR_WorkWeek"],
                          ["Planned_Hours", "Remaining_Hours"])
    g = j.groupBy(*_act_cols(j), F.col("BR_WorkWeek").alias("WorkWeek"), "Snapshot_Date", "pkg", "lvl").agg(
        sum_of(j, "Planned_Hours").alias("f"), sum_of(j, "Remaining_Hours").alias("r"))
    is_l2 = F.col("lvl") == 2
    stacked = _stacked(g, [(FORECAST, "f", is_l2), (REMAINING, "r", is_l2), (L3_PART, "f", F.col("lvl") == 3)],
                       carry=("Snapshot_Date", "pkg"))
    now_rows = stacked.where(F.col("Type") != L3_PART).select(*KEYS, "Hours", "HoursLTD", "Type")
    burn = _burn(stacked.where(F.col("Type") == FORECAST), p)
    pm = package_map if package_map is not None else work_package_map(br)
    l3_arm = _credit_l3(stacked.where(F.col("Type") == L3_PART), pm)
    # last period: weekly fact and weekly activities, one pass
    a = scope(br.l2_last(), p).select("Activity_Key", "BR_ProjectNumber", "Activity_ID", "Activity_Name", "BR_PIEPCCC")
    jl = pre_aggregated_join(br.tp_last().where(F.col("BR_Resource_Type") == LABOUR), a, "Activity_Key",
                           ["Activity_Key", "BR_WorkWeek"], ["Planned_Hours", "Remaining_Hours"])
    gl = jl.groupBy(*_act_cols(jl), F.col("BR_WorkWeek").alias("WorkWeek")).agg(
        sum_of(jl, "Planned_Hours").alias("f"), sum_of(jl, "Remaining_Hours").alias("r"))
    last_rows = _stacked(gl, [(FORECAST_LAST, "f", F.lit(True)), (REMAINING_LAST, "r", F.lit(True))])
    return {"forecast": [now_rows, last_rows], "burn": [burn], "l3": [l3_arm]}


def time_phase_arms(br: Branch, package_map: DataFrame | None = None) -> dict[str, list[DataFrame]]:
    """The time-phased ledger arms of either branch (Forecast family, burn rate, L3)."""
    if br.live:
        return live_time_phase_arms(br, package_map)
    return weekly_time_phase_arms(br, package_map)


def forecast_remaining_burn(br: Branch) -> list[DataFrame]:
    """Forecast, Remaining, their Last twins and the burn rate (from the shared pass)."""
    arms = time_phase_arms(br)
    return arms["forecast"] + arms["burn"]


def l3_rollup(br: Branch, package_map: DataFrame | None = None) -> DataFrame:
    """L3 forecast credited to the mapped L2 package, else `project+PIEPCCC+'xxxx'`
    (from the shared pass)."""
    return time_phase_arms(br, package_map)["l3"][0]


# ------------------------------------------------------------------------ actuals cascade

def _feed_key(feed: DataFrame, wbs: str) -> tuple[Column, list[str]]:
    """`Project + wbs` of a feed's rows, and the columns it is made of: the normalised key that
    stands beside them, where there is one."""
    if FEED_KEY in feed.columns:
        return F.col(FEED_KEY), ["Project", wbs, FEED_KEY]
    return concat_null(F.col("Project"), F.col(wbs)), ["Project", wbs]


def actuals_cascade(br: Branch) -> list[DataFrame]:
    """Actual hours from four feeds, with the report's priorities.

    1 weekly burden through the WBS lookup (date <= period);
    2 actual-hour feed, only for projects without a source-1 row;
    3 finance transactions of FINANCE_SOURCE and 4 timesheets, only for projects absent
      from the whole actual-hour feed and from the WBS lookup (NOT IN, NULL-aware).
    1 and 2 drop hours without an L2 activity; 3 and 4 keep them as 'Not Available'.
    """
    s, p, per = br.src, br.params, br.periods
    cal = s.time_phase_period.select(F.col("Date").alias("tpp_date"), F.col("WorkWeek").alias("tpp_week"))
    aa = br.l2_now()

    # 1. weekly burden
    burdened = _feeds(aa, BURDENED)
    if burdened is None:
        burdened = in_list("BR_ProjectNumber", p.projects) & in_list("BR_PIEPCCC", p.piepccc)
    a1 = aa.where(burdened).select(
        "Activity_ID", "BR_ProjectNumber", "Activity_Name", "BR_PIEPCCC")
    inv = s.weekly_burden.where(F.col("week_ending") <= F.lit(per.period))
    # the lookup meets the activities first, so that the hours are shuffled for one join only
    lookup = s.wbs_lookup.join(a1, (F.col("Activity_ID") == F.col("wp")) & (F.col("BR_ProjectNumber") == F.col("project_no")))
    j1 = (pre_aggregated_join(inv, lookup, F.col("line_code") == F.col("alter_cost_c1_"),
                            ["alter_cost_c1_", "week_ending"], ["Total_Hours"], dealt_by=["alter_cost_c1_"])
          .join(cal, F.col("tpp_date") == F.col("week_ending")))
    rows1 = j1.select(F.lit(1).alias("source"), *_act_cols(j1), F.col("tpp_week").alias("WorkWeek"), F.col("Total_Hours").alias("h"))

    # 2. actual-hour feed; a project with source-1 rows takes those alone. Project numbers of
    # both are never NULL here (they were joined on), so the smaller source decides.
    pm = s.project_master.where(in_list("ProjectNumber", p.projects)).select(F.col("ProjectNumber").alias("pm_project"))
    ah = s.actual_hour.where(first_char_in("wbs", p.piepccc))
    a2 = aa.select(F.col("Activity_ID").alias("a_id"), F.col("Activity_Name").alias("a_name"),
                   F.col("BR_PIEPCCC").alias("a_pie"))
    key, made_of = _feed_key(ah, "wbs")
    j2 = (pre_aggregated_join(ah, a2, F.col("a_id") == key, [*made_of, "date00"], ["Hours"], dealt_by=[key])
          .join(pm, F.col("pm_project") == F.col("Project"))
          .join(cal.where(F.col("tpp_date") <= F.lit(per.period)), F.col("tpp_date") == F.col("date00")))
    rows2 = j2.select(F.lit(2).alias("source"), F.col("Project").alias("ProjectNumber"), F.col("a_id").alias("Activity_ID"),
                      F.col("a_name").alias("Activity_Name"), F.col("a_pie").alias("PIEPCCC"), F.col("tpp_week").alias("WorkWeek"),
                      F.col("Hours").alias("h"))
    both = rows1.unionByName(rows2)
    g12 = both.groupBy("source", *KEYS).agg(sum_of(both, "h").alias("h"))
    named = F.when(F.col("source") == 2, isnull("Activity_Name", "Not Available")).otherwise(F.col("Activity_Name"))
    src12 = _arm(first_source_rows(g12, "ProjectNumber", "source", "h").withColumn("Activity_Name", named),
                 F.col("h"), F.lit(0), ACTUAL)

    # projects allowed for sources 3 and 4
    pm34 = keys_in_no_list(pm, "pm_project", [
        (s.actual_hour, "Project"), (s.wbs_lookup.select(isnull("project_no", "N/A").alias("pn")), "pn")])
    a34 = aa.select(F.col("Activity_ID").alias("a_id"), F.col("BR_ProjectNumber").alias("a_project"),
                    F.col("Activity_Name").alias("a_name"), F.col("BR_PIEPCCC").alias("a_pie"))

    # 3. finance transactions
    fw = fiscal_week_map(s.date_dim, s.work_week).select(F.col("FiscalWeek").alias("fw_week"), F.col("WorkWeek").alias("fw_ww"))
    fss = s.fin_source_system.where(F.col("FinSourceSystemDesc") == FINANCE_SOURCE).select("FinSourceSystem_Key")
    ft = s.fin_transaction.where(first_char_in("Local", p.piepccc)).join(
        fss, F.col("FinSourceSystem_Key") == F.col("FinSourceSystem_FKey"))
    j3 = (pre_aggregated_join(ft, a34, (F.col("a_id") == F.col("WorkPackage")) & (F.col("a_project") == F.col("Project")),
                            ["Project", "WorkPackage", "FiscalWeek"], ["HoursQuantity"], how="left",
                            dealt_by=["WorkPackage", "Project"])
          # one row per fiscal week of the calendar, two at most: shuffled by it, the hours would lie in as many
          # partitions as it has weeks
          .join(F.broadcast(fw.where(F.col("fw_ww") <= F.lit(per.period_week))), F.col("fw_week") == F.col("FiscalWeek")))
    j3 = join_to_few(j3, pm34, F.col("pm_project") == F.col("Project"))
    g3 = j3.groupBy("Project", "WorkPackage", "a_name", "fw_ww", "a_pie").agg(sum_of(j3, "HoursQuantity").alias("h"))
    src3 = g3.select(F.col("Project").alias("ProjectNumber"), F.col("WorkPackage").alias("Activity_ID"),
                     isnull("a_name", "Not Available").alias("Activity_Name"), F.col("a_pie").alias("PIEPCCC"),
                     F.col("fw_ww").alias("WorkWeek"), F.col("h").alias("Hours"), F.lit(0).alias("HoursLTD"),
                     F.lit(ACTUAL).alias("Type"))

    # 4. timesheets
    onc = s.timesheet.where(first_char_in("WBS", p.piepccc) & F.col("Approval_Status").isin(*TIMESHEET_STATUSES))
    key, made_of = _feed_key(onc, "WBS")
    j4 = (pre_aggregated_join(onc, a34, (F.col("a_id") == key) & (F.col("a_project") == F.col("Project")),
                            [*made_of, "TS_Date"], ["Hrs"], how="left",
                            dealt_by=[key, "Project"])
          .join(cal.where(F.col("tpp_week") <= F.lit(per.period_week)), F.col("tpp_date") == F.col("TS_Date")))
    j4 = join_to_few(j4, pm34, F.col("pm_project") == F.col("Project"))
    g4 = j4.groupBy("Project", key.alias("a_id"), "a_name", "tpp_week", "a_pie").agg(sum_of(j4, "Hrs").alias("h"))
    src4 = g4.select(F.col("Project").alias("ProjectNumber"), F.col("a_id").alias("Activity_ID"),
                     isnull("a_name", "Not Available").alias("Activity_Name"), F.col("a_pie").alias("PIEPCCC"),
                     F.col("tpp_week").alias("WorkWeek"), F.col("h").alias("Hours"), F.lit(0).alias("HoursLTD"),
                     F.lit(ACTUAL).alias("Type"))
    return [src12, src3, src4]


def build_ledger(br: Branch, earned: DataFrame | None = None) -> DataFrame:
    """All ledger arms conformed to the declared ledger schema and unioned."""
    tp_arms = time_phase_arms(br)
    arms = planned_and_budget(br) + actuals_cascade(br) + tp_arms["forecast"] + tp_arms["burn"] + tp_arms["l3"]
    if earned is not None:
        arms.append(earned)
    return append_typed(arms, LEDGER_SCHEMA)

