"""Earned value (snapshot delta) and the EV project report (conditional-sum pivot)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourglass.functions import concat_null, isnull
from hourglass.operators import conditional_sums, sum_of
from hourglass.params import ReportParams, ResolvedPeriods
from hourglass.plans.calendar import period_rollup_table, resolve_periods
from hourglass.plans.gate import use_live_sources
from hourglass.plans.ledger import EARNED, Branch, build_ledger, scope, share_activities
from hourglass.sources.catalog import ProjectSources, live_scan, snapshot_scan
from hourglass.sources.comparison import WRITTEN, compared_params, compared_sources
from hourglass.sources.staging import Staging

DEC = "decimal(19,6)"
# Budget column per requested baseline (Daily branch, current rows).
BUDGET_COLUMN = {"Approved": "ApprBL_Budgeted_Labor_Units", "Recovery": "RecBL_Budgeted_Labor_Units",
                 "Original": "OrigBL_Budgeted_Labor_Units"}

# Source views that the arms of the Weekly and of the Live/Daily report read; what resolves the
# periods and the branch is `BRANCH_VIEWS`, what only the pivot reads is `REPORT_VIEWS`.
BRANCH_VIEWS = ("snapshot_period", "work_week")
REPORT_VIEWS = ("project_master_ext",)
_FEEDS = ("time_phase_period", "date_dim", "project_master", "fin_source_system", "weekly_burden", "wbs_lookup", "actual_hour",
          "fin_transaction", "timesheet")
ARM_VIEWS = {
    "planned": (("activity_l2_weekly", "time_phase_baseline_weekly"), ("activity_l2_daily", "time_phase_baseline")),
    "actuals": (("activity_l2_weekly", *_FEEDS), ("activity_l2_daily", *_FEEDS)),
    "time_phase": (("activity_l2_weekly", "activity_l3_weekly", "time_phase_weekly"),
                   ("activity_l2_daily", "activity_l2_weekly", "activity_l3_daily", "time_phase_daily", "time_phase_weekly")),
    "earned": (("activity_l2_weekly", "time_phase_period"), ("activity_l2_daily", "activity_l2_weekly", "time_phase_period")),
}


def views_of(live: bool, *arms: str) -> set[str]:
    """Names of the source views that these arms of the ledger read in one branch."""
    return set(BRANCH_VIEWS).union(*[ARM_VIEWS[a][live] for a in arms])


def work_packages(br: Branch) -> DataFrame:
    """Both snapshots' L2 activities with their budget and percent complete."""
    p, per = br.params, br.periods
    cols = ["Snapshot_Date", "Activity_Key", "Activity_ID", "Activity_Name", "BR_ProjectNumber", "BR_PIEPCCC",
            "BR_Percent_Complete"]
    if br.live:
        last = scope(br.l2_last(), p).select(*cols, F.col("ApprBL_Budgeted_Labor_Units").alias("budget"))
        col = BUDGET_COLUMN.get(p.baseline_type)
        budget = F.col(col) if col else F.lit(None).cast(DEC)
        now = scope(live_scan(br.src.activity_l2_daily), p).select(*cols, budget.alias("budget"))
        return last.unionByName(now)
    both = snapshot_scan(br.src.activity_l2_weekly, [per.period, per.last_period])
    return scope(both, p).select(*cols, F.col("ApprBL_Budgeted_Labor_Units").alias("budget"))


def earned_value_rows(wp: DataFrame, current_date, last_date) -> DataFrame:
    """Per-activity (Snapshot_Date, attributes, Earned_LTD, Earned_Last_LTD) rows.

    Rows out, as the report's full outer join through its one-row mapping gives them:
      matched   -> (current date, cur, last)
      new       -> (current date, cur, 0)
      dropped   -> (current date, 0, last)          a negative delta
      and every row not dated `current_date` again as (its date, value, 0), which
      includes each previous-snapshot row.
    So over all rows sum(delta) = current total. Earned = budget * percent / 100, NULLs as 0.
    """
    ev = (isnull("budget", 0) * isnull("BR_Percent_Complete", 0) / 100)
    base = wp.select("Snapshot_Date", "Activity_Key", "Activity_ID", "Activity_Name",
                     F.col("BR_PIEPCCC").alias("PIEPCCC"), F.col("BR_ProjectNumber").alias("ProjectNumber"),
                     ev.alias("ev"))
    attrs = ["Activity_ID", "Activity_Name", "PIEPCCC", "ProjectNumber"]
    cd, ld = F.lit(current_date).cast("date"), F.lit(last_date).cast("date")
    d, row = F.col("Snapshot_Date"), F.struct(*attrs, "ev")
    is_cur, is_last = F.coalesce(d == cd, F.lit(False)), F.coalesce(d == ld, F.lit(False))
    rest = F.coalesce(d.isNotNull() & (cd.isNull() | (d != cd)), F.lit(False))
    # one pass over both snapshots folds an activity's states into one row; a NULL key meets
    # nothing, so each such row is folded by itself
    lone = F.when(F.col("Activity_Key").isNull(), F.monotonically_increasing_id())
    folded = base.groupBy("Activity_Key", lone.alias("_lone")).agg(
        F.collect_list(F.when(is_cur, row)).alias("cur"), F.collect_list(F.when(is_last, row)).alias("last"),
        F.collect_list(F.when(rest, F.struct(d, *attrs, "ev"))).alias("rest"))
    none = F.lit(None).cast(row_type(base, attrs))
    one = lambda c: F.when(F.size(c) == 0, F.array(none)).otherwise(F.col(c))
    zero = F.lit(0).cast(base.schema["ev"].dataType)
    # a repeated key joins each of its current rows with each of its previous ones
    pairs = F.flatten(F.transform(one("cur"), lambda a: F.transform(one("last"), lambda b: F.struct(
        cd.alias("Snapshot_Date"), *[F.coalesce(a[c], b[c]).alias(c) for c in attrs],
        F.coalesce(a["ev"], zero).alias("Earned_LTD"), F.coalesce(b["ev"], zero).alias("Earned_Last_LTD")))))
    met = (F.size("cur") > 0) | (F.size("last") > 0)
    again = F.transform(F.col("rest"), lambda r: F.struct(
        r["Snapshot_Date"].alias("Snapshot_Date"), *[r[c].alias(c) for c in attrs], r["ev"].alias("Earned_LTD"), zero.alias("Earned_Last_LTD")))
    if current_date is None:
        made = again
    else:
        made = F.concat(F.when(met, pairs).otherwise(F.slice(pairs, 1, 0)), again)
    return folded.select(F.explode(made).alias("r")).select("r.*")


def row_type(df: DataFrame, attrs: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, df.schema[c].dataType) for c in (*attrs, "ev")])


def earned_arm(br: Branch, calendar: DataFrame) -> DataFrame:
    """Ledger rows of type Earned: delta and LTD per activity and work week."""
    per = br.periods
    cur = per.period + dt.timedelta(days=br.params.live_offset_days) if br.live and per.period else per.period
    v = earned_value_rows(work_packages(br), cur, per.last_period)
    dd = calendar.select(F.col("Date").alias("dd_date"), F.col("WorkWeek"))
    j = v.join(dd, F.col("dd_date") == F.col("Snapshot_Date"), "left")
    g = j.groupBy("ProjectNumber", "Activity_ID", "Activity_Name", "WorkWeek", "PIEPCCC").agg(
        F.sum(F.col("Earned_LTD") - F.col("Earned_Last_LTD")).alias("Hours"), F.sum("Earned_LTD").alias("HoursLTD"))
    return g.select("ProjectNumber", "Activity_ID", "Activity_Name", "PIEPCCC", "WorkWeek", "Hours", "HoursLTD",
                    F.lit(EARNED).alias("Type"))


def grouping_label(group: str):
    """The report's `Grouping` column for the chosen @rpGroup."""
    labels = {
        "Project": F.col("ProjectTitleLong"),
        "Bundle": F.col("BundleTitleLong"),
        "Vendor": F.col("VendorDescription"),
        "Strat III": concat_null("Strat III: ", isnull("ProjectAttribute_STRATUM_III", "Not Available")),
        "Strat IV": concat_null("Strat IV: ", isnull("ProjectAttribute_STRATUM_IV", "Not Available")),
    }
    return labels.get(group, F.lit("N/A"))


def measures(per: ResolvedPeriods, live: bool = True):
    """(name, condition, value column) of the 22 report measures, in the report's order: the
    Weekly branch has LTD_FC3 before LTD_AV."""
    t, w = F.col("Type"), F.col("WorkWeek")
    p, l1, l2 = F.lit(per.period_week), F.lit(per.last_period_week), F.lit(per.last2_period_week)
    week = (w > l1) & (w <= p)
    out = [
        ("Week_PV", (t == "Planned") & week, "Hours"),
        ("Week_FC", (t == "Forecast") & week, "Hours"),
        ("Week_EV", (t == "Earned") & week, "Hours"),
        ("Week_AV", (t == "Actual") & week, "Hours"),
        ("Week_AVLast", (t == "Actual") & (w > l2) & (w <= l1), "Hours"),
        ("Week_FC3", (t == "Forecast Last L3") & week, "Hours"),
        ("LTD_PV", (t == "Planned") & (w <= p), "Hours"),
        ("LTD_FC", (t == "Forecast") & (w <= p), "Hours"),
        ("LTD_EV", (t == "Earned") & (w == p), "HoursLTD"),
        ("LTD_AV", (t == "Actual") & (w <= p), "Hours"),
        ("LTD_AVLast", (t == "Actual") & (w <= l1), "Hours"),
        ("LTD_FC3", (t == "Forecast L3") & (w <= p), "Hours"),
        ("LC_PV", t == "Planned", "Hours"),
        ("LC_FC", t == "Forecast", "Hours"),
        ("LC_FCLast", t == "Forecast Last", "Hours"),
        ("LC_EV", t == "Earned", "Hours"),
        ("LC_FC3", t == "Forecast L3", "Hours"),
        ("LC_RV", t == "Remaining", "Hours"),
        ("LC_RVLast", t == "Remaining Last", "Hours"),
        ("LC_BV", t == "Budget", "Hours"),
        ("LC_TV", t == "Target", "Hours"),
        ("Burn", t == "Forecast burned rate", "Hours"),
    ]
    if not live:
        names = [m[0] for m in out]
        out.insert(names.index("LTD_AV"), out.pop(names.index("LTD_FC3")))
    return out


REPORT_KEYS = ["ProjectNumber", "BundleTitleLong", "ProgramWBS", "ProjectTitleCombined", "VendorDescription",
               "Activity_ID", "Activity_Name", "PIEPCCC", "Grouping"]
#: those of them that the ledger has
ACTIVITY_KEYS = ["ProjectNumber", "Activity_ID", "Activity_Name", "PIEPCCC"]


def project_report(ledger: DataFrame, br: Branch, sort: bool = True) -> DataFrame:
    """Ledger -> one row per (project attributes, activity, PIEPCCC) with 22 measures and
    the activity's latest finish. Where activities are compared by keys, an activity of this
    period is shown as it is written, the first of several spellings.

    The ledger's rows are dealt by activity over all shuffle partitions before they are summed: a sum of
    22 decimals per activity on each side of a shuffle holds nearly every activity that a task meets, and
    tasks of the arms are merged by their compressed size. They are summed to one row per activity before
    they meet the projects and the finish dates, so that no ledger row is sorted or hashed for these joins;
    a match more repeats an activity's sums as it repeats its rows. The summed rows are dealt once more, as
    the final sort reads its input twice, once for its ranges. Activities that agree in what the report is
    sorted by come by their keys, so that they share no one range of the final sort."""
    s, p = br.src, br.params
    mpl = s.project_master_ext.where(F.col("IsCurrent") == 1).select(
        F.col("ProjectNumber").alias("m_project"), "BundleTitleLong", "ProgramWBS",
        concat_null(F.col("ProjectNumber"), " - ", F.col("ProjectTitleLong")).alias("ProjectTitleCombined"),
        "VendorDescription", grouping_label(p.group).alias("Grouping"))
    now = br.l2_now()
    shown = [c for c in ("Activity_ID", "Activity_Name") if c + WRITTEN in now.columns]
    first = [F.min(c + WRITTEN).alias(c + WRITTEN) for c in shown]
    fin = now.select(F.col("Activity_ID").alias("f_id"), F.col("BR_ProjectNumber").alias("f_project"), "Finish", *[c + WRITTEN for c in shown])
    if p.safe_finish:
        fin = fin.groupBy("f_id", "f_project").agg(F.max("Finish").alias("Finish"), *first)
    n = int(ledger.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    wanted = measures(br.periods, br.live)
    summed = conditional_sums(ledger.repartition(n, "Activity_ID", "ProjectNumber"), ACTIVITY_KEYS, wanted)
    j = (summed.join(mpl, F.col("m_project") == F.col("ProjectNumber"), "left")
         .join(fin.hint("shuffle_hash"), (F.col("f_id") == F.col("Activity_ID")) & (F.col("f_project") == F.col("ProjectNumber")), "left"))
    out = j.groupBy(*REPORT_KEYS).agg(*[sum_of(j, name).alias(name) for name, _, _ in wanted], F.max("Finish").alias("finish"), *first)
    if shown:
        written = {c: F.coalesce(F.col(c + WRITTEN), F.col(c)).alias(c) for c in shown}
        out = out.select(*[written.get(c, F.col(c)) for c in out.columns if not c.endswith(WRITTEN)])
    if sort:
        out = out.repartition("Activity_ID", "PIEPCCC").orderBy(F.col("Week_AV").asc_nulls_first(), F.col("LC_RV").desc_nulls_last(), *REPORT_KEYS)
    return out


def resolved_branch(src: ProjectSources, params: ReportParams, live: bool | None = None) -> Branch:
    """Periods resolved and sources picked, for functions that build single arms; strings are
    compared as the parameters say."""
    src, params = compared_sources(src, params.comparison), compared_params(params)
    rollup = period_rollup_table(src.snapshot_period)
    periods = resolve_periods(rollup, src.work_week, params.period_type, params.period)
    if live is None:
        live = use_live_sources(src.snapshot_period, params.period)
    return Branch(src, params, periods, live)


def ev_report(src: ProjectSources, params: ReportParams, live: bool | None = None, sort: bool = True,
              staging: Staging | None = None) -> DataFrame:
    """The whole EV project report: resolve periods, pick sources, build the ledger, pivot.

    The L2 activities are read once and stored in `staging`, which the caller closes after
    the report has run; without one they last until the application ends."""
    br = resolved_branch(src, params, live)
    br = share_activities(br, staging or Staging.of_application(src.snapshot_period.sparkSession))
    return project_report(build_ledger(br, earned=earned_arm(br, br.src.time_phase_period)), br, sort=sort)


def ledger_only(src: ProjectSources, params: ReportParams, live: bool | None = None, staging: Staging | None = None) -> DataFrame:
    """The ledger of the report, all arms."""
    br = resolved_branch(src, params, live)
    br = share_activities(br, staging or Staging.of_application(src.snapshot_period.sparkSession))
    return build_ledger(br, earned=earned_arm(br, br.src.time_phase_period))
