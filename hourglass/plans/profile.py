"""Resource profile: labour hours per month for chosen resources, this week's snapshot
against last week's, on a gap-free month axis with a cumulative series.

Only the first two steps touch facts (the time-phase join and the attribute re-join); they
are aggregated before anything else happens. Everything after `bb` runs on the profile
itself: months x resources, small.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourglass.functions import concat_null, in_list, lacks_suffix_like, left, right, spaces
from hourglass.operators import template_row, union_distinct, update_from_join
from hourglass.params import ProfileParams
from hourglass.plans.calendar import (axis_bounds, clamp_year_month, dense_month_spine, spine_bounds, year_axis)
from hourglass.sources.catalog import ProjectSources, window_scan
from hourglass.sources.comparison import compared_params, compared_sources
from hourglass.sources.staging import Staging

ATTRS = ["ResourceCode", "BR_CM_RESOURCE_GROUP_Val", "Resource_ID", "Resource_Name", "BR_ProgramWBS", "BR_UnitWBS",
         "BR_BundleWBS", "Bundle", "ProjectNumber", "ProjectTitle", "Project", "Vendor", "BR_VendorDescription"]
BB_COLS = ["RecordType", "Snapshot_Date", "FM", "Year", "Month"] + ATTRS + ["Hours"]
FINAL_COLS = ["RecordType", "Snapshot_Date", "FM", "FM_Mod", "rn", "Year", "Month"] + ATTRS + ["Hours"]
L3_TYPES = ("TT_Task", "TT_LOE")
#: source views that the profile reads; without a current week, `snapshot_period` too
PROFILE_VIEWS = ("time_phase_period", "time_phase_weekly", "resource_assignment_l3_weekly", "resource_code_weekly")


def resource_hours(src: ProjectSources, pp: ProfileParams) -> DataFrame:
    """Labour hours per (snapshot, week, fiscal month, activity, assignment, resource) for
    the snapshots in [CW - 7, CW] and the chosen scope."""
    ra = window_scan(src.resource_assignment_l3_weekly, pp.cw - dt.timedelta(days=7), pp.cw)
    ra = ra.where(F.col("Activity_Type").isin(*L3_TYPES) & (F.col("BR_CM_ACTIVITY_LEVEL_Val") == "3")
                  & lacks_suffix_like("BR_NR_EXECUTION_WINDOWS_Val") & in_list("BR_NR_OUTAGE_SEGMENT_Val", pp.outage_segments)
                  & in_list("BR_ProjectNumber", pp.projects) & in_list("BR_PIEPCCC", pp.piepccc)
                  & in_list("Resource_ID", pp.resources))
    tp = window_scan(src.time_phase_weekly, pp.cw - dt.timedelta(days=7), pp.cw)
    tp = tp.where((F.col("BR_Resource_Type") == "RT_Labor") & (F.col("Planned_Hours") > 0))
    keys = ["Activity_Key", "Snapshot_Date", "ResourceAssign_Key"]
    j = ra.select(*keys, "Resource_ID").join(tp.select(*keys, "BR_WorkWeek", "BR_FiscalMonth", "Planned_Hours"), keys)
    return j.groupBy("Snapshot_Date", F.col("BR_WorkWeek").alias("WW"), F.col("BR_FiscalMonth").alias("FiscalMonth"),
                     "Activity_Key", "ResourceAssign_Key", "Resource_ID").agg(F.sum("Planned_Hours").alias("Hours"))


def monthly_profile(src: ProjectSources, pp: ProfileParams, hours: DataFrame, min_year, max_year) -> DataFrame:
    """`#BB`: hours per snapshot, fiscal month (clamped to the year axis) and resource, with
    project and resource-code attributes. The attribute tables are re-joined after the
    aggregate; duplicate attribute rows multiply hours, as in the report."""
    keys = ["Activity_Key", "Snapshot_Date", "ResourceAssign_Key"]
    m = window_scan(src.resource_assignment_l3_weekly, pp.cw - dt.timedelta(days=7), pp.cw).select(
        *keys, "BR_ProgramWBS", "BR_UnitWBS", "BR_BundleWBS", "BR_BundleTitleShort", "BR_ProjectNumber",
        "BR_ProjectTitleShort", "BR_ProjectTitleLong", "BR_Vendor", "BR_VendorDescription")
    r = src.resource_code_weekly.select("Snapshot_Date", "Resource_ID", "Resource_Name", "BR_CM_RESOURCE_GROUP_Name",
                                        "BR_CM_RESOURCE_GROUP_Val")
    year, month = clamp_year_month(F.col("FiscalMonth"), pp.report, min_year, max_year)
    j = hours.join(m, keys).join(r, ["Snapshot_Date", "Resource_ID"])
    g = j.groupBy(
        F.when(F.col("Snapshot_Date") == F.lit(pp.cw), "CW").otherwise("LW").alias("RecordType"),
        "Snapshot_Date", F.col("FiscalMonth").alias("FM"), year.alias("Year"), month.alias("Month"),
        F.col("BR_CM_RESOURCE_GROUP_Name").alias("ResourceCode"), "BR_CM_RESOURCE_GROUP_Val", "Resource_ID",
        "Resource_Name", "BR_ProgramWBS", "BR_UnitWBS", "BR_BundleWBS", F.col("BR_BundleTitleShort").alias("Bundle"),
        F.col("BR_ProjectNumber").alias("ProjectNumber"), F.col("BR_ProjectTitleShort").alias("ProjectTitle"),
        concat_null(F.col("BR_ProjectNumber"), " - ", F.col("BR_ProjectTitleLong")).alias("Project"),
        F.col("BR_Vendor").alias("Vendor"), "BR_VendorDescription",
    ).agg(F.sum("Hours").alias("Hours"))
    return g.select(*BB_COLS)


@dataclass
class ProfileParts:
    axis: DataFrame
    bounds: tuple
    bb: DataFrame
    data_bounds: tuple
    spine: DataFrame
    template: DataFrame
    years: DataFrame
    final: DataFrame


def current_week(snapshot_period: DataFrame):
    """CW when the caller gives none: the latest processed Weekly snapshot (one aggregate)."""
    return snapshot_period.where((F.col("PeriodType") == "Weekly") & (F.col("ActivityIsProcessed") == 1)).agg(
        F.max(F.col("SnapshotDate").cast("date"))).collect()[0][0]


def resource_profile_parts(src: ProjectSources, pp: ProfileParams, staging: Staging | None = None) -> ProfileParts:
    """All steps of the profile. `#BB` is stored in `staging`, which the caller closes after the
    parts have run; without one it lasts until the application ends."""
    src, pp = compared_sources(src, pp.comparison), compared_params(pp)
    if pp.cw is None:
        pp = replace(pp, cw=current_week(src.snapshot_period))
    if pp.cw is None:
        raise ValueError("no processed Weekly snapshot to use as the current week")
    cal = src.time_phase_period
    axis = year_axis(cal, pp.report, pp.base_year)
    min_year, max_year = axis_bounds(axis)
    # `#BB` is read four times (bounds, spine, template, union) and sits on the two fact
    # joins: stored in the shared folder rather than pinning executor memory.
    staging = staging or Staging.of_application(cal.sparkSession)
    bb = staging.store(monthly_profile(src, pp, resource_hours(src, pp), min_year, max_year), "monthly-profile")
    code = F.concat("Year", "Month")
    mn, mx = bb.agg(F.min(code)).scalar(), bb.agg(F.max(code)).scalar()
    lo, hi = spine_bounds(pp.graph_start, pp.graph_end, mn, mx)

    cw_hours = bb.where(F.col("RecordType") == "CW").groupBy(F.concat("Year", "Month").alias("FM")).agg(
        F.sum("Hours").alias("Hours"))
    spine = dense_month_spine(cal, cw_hours, lo, hi)

    template = template_row(bb).select(
        F.lit("CW").alias("RecordType"), "Snapshot_Date", "FM", spaces(4).alias("Year"), spaces(2).alias("Month"),
        *ATTRS, F.lit(0).alias("Hours"))

    months = cal.select("FiscalMonth")
    temp_yr = months.where(F.col("FiscalMonth").between(F.lit(mn), F.lit(mx))).select(
        left("FiscalMonth", 4).alias("Year")).distinct().select("Year", F.lit(0).alias("rn"))
    graph_yr = months.where(F.col("FiscalMonth").between(lo, hi)).select(
        left("FiscalMonth", 4).alias("Year")).distinct().select("Year", F.lit(0).alias("rn"))
    years = update_from_join(union_distinct(temp_yr, graph_yr), axis.withColumn("rn", F.col("rn").cast("int")), "Year", "rn")

    t1 = F.broadcast(template.drop("Year", "Month", "Hours"))
    detail = bb.select(F.concat("Year", "Month").alias("FM_Mod"), *BB_COLS)
    zero = spine.select(F.col("FM").alias("FM_Mod")).crossJoin(t1).select(
        "FM_Mod", "RecordType", "Snapshot_Date", "FM", left("FM_Mod", 4).alias("Year"), right("FM_Mod", 2).alias("Month"),
        *ATTRS, F.lit(0).alias("Hours"))
    cumulative = spine.select(F.col("FM").alias("FM_Mod"), "Cumm_Hrs").crossJoin(t1).select(
        "FM_Mod", F.lit("CU").alias("RecordType"), "Snapshot_Date", "FM", left("FM_Mod", 4).alias("Year"),
        right("FM_Mod", 2).alias("Month"), *ATTRS, F.col("Cumm_Hrs").alias("Hours"))
    dec = "decimal(38,6)"
    union = (detail.withColumn("Hours", F.col("Hours").cast(dec))
             .unionByName(zero.withColumn("Hours", F.col("Hours").cast(dec)))
             .unionByName(cumulative.withColumn("Hours", F.col("Hours").cast(dec))))
    final = union.join(years.select("Year", F.col("rn").cast("long").alias("rn")), "Year", "left").select(*FINAL_COLS)
    return ProfileParts(axis, (min_year, max_year), bb, (mn, mx), spine, template, years, final)


def resource_profile(src: ProjectSources, pp: ProfileParams, staging: Staging | None = None) -> DataFrame:
    return resource_profile_parts(src, pp, staging).final
