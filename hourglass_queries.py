"""Spark side of every registered query: library operators applied to the driver tables
(directly, or through the stand-in source views of `hourglass.sources.standins`).

Every query reads whole tables. Report parameters are fixed values shared with
`hourglass_oracles.py`: EV period 2000-01-01 (Weekly branch), profile CW 2000-01-01 with report
mode '0' and as-of year 2000, graph 199601..200112.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import fields, replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourglass.functions import (add_days, add_months, add_weeks, concat_null, fiscal_month_code, isnull, lacks_suffix,
                                 lacks_suffix_like, left, mdy, number_text, right, spaces, work_week_code, year_text)
from hourglass.functions.nulls import in_list
from hourglass.operators import (append_typed, asof_max_by_ranges, conditional_sums, null_aware_anti_join, ordinal, ordinal_by_ranges,
                                 range_join_days, running_total, running_total_by_ranges, top1_per_group, update_from_join)
from hourglass.params import ProfileParams, ReportParams, ResolvedPeriods
from hourglass.plans import calendar as cal_plans
from hourglass.plans.earned import (ARM_VIEWS, BRANCH_VIEWS, REPORT_VIEWS, earned_value_rows, ev_report, ledger_only, measures, resolved_branch, views_of,
                                    work_packages)
from hourglass.plans.gate import gate_frame, use_live_sources
from hourglass.plans.ledger import (LEDGER_SCHEMA, actuals_cascade, baseline_selection,
                                    forecast_remaining_burn, l3_rollup, planned_and_budget, scope, work_package_map)
from hourglass.plans.matrix import snapshot_month_matrix
from hourglass.plans.profile import PROFILE_VIEWS, resource_profile, resource_profile_parts
from hourglass.sources import standins
from hourglass.sources.catalog import ProjectSources, snapshot_scan
from hourglass.sources.comparison import CASE_BLIND, KEYS, SPELLINGS
from hourglass.sources.staging import Staging

D = "decimal(19,6)"
D38 = "decimal(38,6)"
EV_PARAMS = ReportParams(period_type="Weekly", period=dt.date(2000, 1, 1), projects=None, piepccc=None,
                         baseline_type="Approved", group="Bundle")
PROFILE_PARAMS = ProfileParams(cw=dt.date(2000, 1, 1), projects=None, report="0", outage_segments=None, piepccc=None,
                               resources=None, graph_start="199601", graph_end="200112", as_of=dt.date(2000, 6, 30))
# Weeks of the minimal-slice pivot (report parameters of that query).
PIVOT_WEEKS = ResolvedPeriods(None, None, None, "1999WW26", "1999WW13", "1998WW52")


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _cast(df: DataFrame, cols, to: str) -> DataFrame:
    return df.select(*[F.col(c).cast(to).alias(c) if c in cols else F.col(c) for c in df.columns])


# ------------------------------------------------------------------------- EV context

def _src(spark: SparkSession, d: str, *views: str) -> ProjectSources:
    """The stand-in views that a query reads, and no others."""
    return standins.build(spark, d, views=views)


def _arms_src(spark: SparkSession, d: str, params: ReportParams, arms, *more: str) -> ProjectSources:
    """The views that these arms of a report read; the snapshots tell its branch."""
    return standins.build(spark, d, views=(*BRANCH_VIEWS, *more),
                          then=lambda src: views_of(use_live_sources(src.snapshot_period, params.period), *arms))


def _ledger_src(spark: SparkSession, d: str, params: ReportParams) -> ProjectSources:
    return _arms_src(spark, d, params, ARM_VIEWS)


def _report_src(spark: SparkSession, d: str, params: ReportParams) -> ProjectSources:
    return _arms_src(spark, d, params, ARM_VIEWS, *REPORT_VIEWS)


def _profile_src(spark: SparkSession, d: str) -> ProjectSources:
    return _src(spark, d, *PROFILE_VIEWS)


def _ev(spark: SparkSession, d: str, *arms: str, params: ReportParams = EV_PARAMS):
    src = _arms_src(spark, d, params, arms) if arms else standins.build(spark, d)
    br = resolved_branch(src, params)
    return br.src, br


def _ledger(frames) -> DataFrame:
    return append_typed(frames, LEDGER_SCHEMA)


def q_period_rollup_table(spark, d):
    return cal_plans.period_rollup_table(_src(spark, d, "snapshot_period").snapshot_period)


def q_asof_period_lookup(spark, d):
    src = _src(spark, d, "snapshot_period", "work_week")
    rollup = cal_plans.period_rollup_table(src.snapshot_period)
    return cal_plans.previous_periods_all(rollup, "Weekly", src.work_week)


def q_fiscal_week_map(spark, d):
    src = _src(spark, d, "date_dim", "work_week")
    return cal_plans.fiscal_week_map(src.date_dim, src.work_week)


def q_calendar_range_join(spark, d):
    src = _src(spark, d, "work_week")
    o = _t(spark, d, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("o_orderdate"))
    return range_join_days(o, "o_orderdate", src.work_week, "WWStartDate", 7, how="left").select(
        "o_orderkey", "o_orderdate", "WorkWeek")


def q_work_package_map(spark, d):
    src = _src(spark, d, "activity_l2_weekly")
    cols = ["Snapshot_Date", "BR_L2WorkPackage", "Activity_ID", "Activity_Name", "BR_NR_LOE_WORK_Val"]
    return top1_per_group(src.activity_l2_weekly.select(*cols), ["Snapshot_Date", "BR_L2WorkPackage"],
                          [("BR_NR_LOE_WORK_Val", True), ("Activity_ID", False)])


def q_baseline_selection(spark, d):
    src = _src(spark, d, "time_phase_baseline")
    arms = [baseline_selection(src.time_phase_baseline, req).select(F.lit(req).alias("requested"), "*")
            for req in ("Approved", "Recovery", "Original")]
    return reduce(DataFrame.unionByName, arms)


def q_planned_hours(spark, d):
    _, br = _ev(spark, d, "planned")
    return _ledger(planned_and_budget(br))


def q_forecast_hours(spark, d):
    _, br = _ev(spark, d, "time_phase")
    arms = [a for a in forecast_remaining_burn(br)]
    return _ledger(arms).where(F.col("Type") != "Forecast burned rate")


def q_burn_rate(spark, d):
    _, br = _ev(spark, d, "time_phase")
    return _ledger(forecast_remaining_burn(br)).where(F.col("Type") == "Forecast burned rate")


def q_l3_to_l2_rollup(spark, d):
    _, br = _ev(spark, d, "time_phase")
    return _ledger([l3_rollup(br, work_package_map(br))])


def q_actuals_cascade(spark, d):
    _, br = _ev(spark, d, "actuals")
    return _ledger(actuals_cascade(br))


def q_earned_value_delta(spark, d):
    _, br = _ev(spark, d, "earned")
    v = earned_value_rows(work_packages(br), br.periods.period, br.periods.last_period)
    return _cast(v, ["Earned_LTD", "Earned_Last_LTD"], D)


def _report_measures(out: DataFrame) -> DataFrame:
    measures = [c for c in out.columns if c.startswith(("Week_", "LTD_", "LC_")) or c == "Burn"]
    return _cast(out, measures, D38)


def q_typed_ledger_append(spark, d):
    return ledger_only(_ledger_src(spark, d, EV_PARAMS), EV_PARAMS)


def q_ev_project_report(spark, d):
    return _report_measures(ev_report(_report_src(spark, d, EV_PARAMS), EV_PARAMS))


def q_conditional_measure_pivot(spark, d):
    """Minimal slice: a two-type ledger from lineitem + part pivoted into horizon measures."""
    li = _t(spark, d, "lineitem")
    p = _t(spark, d, "part")
    typ = F.when(F.col("l_returnflag") == "A", "Actual").when(F.col("l_returnflag") == "N", "Planned").otherwise("Forecast")
    led = li.join(p, li.l_partkey == p.p_partkey).select(
        F.col("p_type").alias("ProjectNumber"), F.col("p_brand").alias("Activity_ID"), F.col("p_brand").alias("Activity_Name"),
        right(F.col("p_size").cast("string"), 1).alias("PIEPCCC"), work_week_code("l_shipdate").alias("WorkWeek"),
        F.col("l_quantity").cast(D).alias("Hours"), F.col("l_extendedprice").cast(D).alias("HoursLTD"), typ.alias("Type"))
    out = conditional_sums(led, ["ProjectNumber", "Activity_ID", "PIEPCCC"], measures(PIVOT_WEEKS))
    return _cast(out, [c for c in out.columns if c not in ("ProjectNumber", "Activity_ID", "PIEPCCC")], D38)


def q_snapshot_scoped_scan(spark, d):
    src = _src(spark, d, "time_phase_weekly")
    tp = snapshot_scan(src.time_phase_weekly, [dt.date(2000, 1, 1), dt.date(1999, 12, 25)])
    out = tp.groupBy("Snapshot_Date", "BR_WorkWeek").agg(F.sum("Planned_Hours").alias("Hours"), F.count(F.lit(1)).alias("n"))
    return _cast(out, ["Hours"], D38)


def q_staged_relation_reuse(spark, d):
    src = _src(spark, d, "time_phase_weekly")
    # both reads want sums: what is staged is the fact at their common grain, not the fact
    grain = src.time_phase_weekly.groupBy("BR_WorkWeek", "BR_FiscalMonth").agg(
        F.sum("Planned_Hours").alias("Planned_Hours"), F.sum("Remaining_Hours").alias("Remaining_Hours"))
    staged = Staging.of_application(spark).store(grain, "week-month-hours")
    a = staged.groupBy(F.col("BR_WorkWeek").alias("period")).agg(F.sum("Planned_Hours").alias("Hours")).select(
        F.lit("week").alias("grain"), "period", "Hours")
    b = staged.groupBy(F.col("BR_FiscalMonth").alias("period")).agg(F.sum("Remaining_Hours").alias("Hours")).select(
        F.lit("month").alias("grain"), "period", "Hours")
    return _cast(a.unionByName(b), ["Hours"], D38)


def q_update_from_join(spark, d):
    src = _src(spark, d, "time_phase_period")
    axis = cal_plans.year_axis(src.time_phase_period, "0", "2000")
    years = src.time_phase_period.select(left("FiscalMonth", 4).alias("Year")).distinct().select("Year", F.lit(0).alias("rn"))
    out = update_from_join(years, axis.withColumn("rn", F.col("rn").cast("int")), "Year", "rn")
    return out.select("Year", F.col("rn").cast("long").alias("rn"))


def q_param_multivalue_filter(spark, d):
    src = _src(spark, d, "activity_l2_weekly")
    a = src.activity_l2_weekly.where(in_list("BR_ProjectNumber", ("ECONOMY", "PROMO", "LARGE"))
                                     & in_list("BR_PIEPCCC", ("2", "5", "6")))
    return a.groupBy("Snapshot_Date", "BR_ProjectNumber", "BR_PIEPCCC").agg(F.count(F.lit(1)).alias("n"))


def q_labour_scope_filter(spark, d):
    src = _src(spark, d, "activity_l2_weekly", "time_phase_weekly")
    a = scope(src.activity_l2_weekly, EV_PARAMS).select("Activity_Key", "Snapshot_Date", "BR_ProjectNumber")
    tp = src.time_phase_weekly.where(F.col("BR_Resource_Type") == "RT_Labor")
    out = tp.join(a, ["Activity_Key", "Snapshot_Date"]).groupBy("Snapshot_Date", "BR_ProjectNumber").agg(
        F.sum("Planned_Hours").alias("Hours"))
    return _cast(out, ["Hours"], D38)


def q_suffix_exclusion(spark, d):
    src = _src(spark, d, "activity_l2_weekly")
    v = src.activity_l2_weekly.groupBy("BR_NR_EXECUTION_WINDOWS_Val").agg(F.count(F.lit(1)).alias("n"))
    return v.select("BR_NR_EXECUTION_WINDOWS_Val", "n", lacks_suffix("BR_NR_EXECUTION_WINDOWS_Val").alias("kept_right"),
                    lacks_suffix_like("BR_NR_EXECUTION_WINDOWS_Val").alias("kept_like"))


MODES = ("0", "1", "2", "3", "4", "5", "9")


def _year_filter_rows(spark, d):
    src = _src(spark, d, "time_phase_period")
    arms = []
    for mode in MODES:
        base = ProfileParams(report=mode, as_of=dt.date(2000, 6, 30)).base_year
        arms.append(cal_plans.year_axis(src.time_phase_period, mode, base).select(F.lit(mode).alias("mode"), "Year", "rn"))
    return reduce(DataFrame.unionByName, arms)


def q_mode_switched_year_filter(spark, d):
    return _year_filter_rows(spark, d).select("mode", "Year")


def q_year_axis(spark, d):
    src = _src(spark, d, "time_phase_period")
    return cal_plans.year_axis(src.time_phase_period, "0", "1998")


def q_nth_year_bounds(spark, d):
    y = _year_filter_rows(spark, d)
    return y.groupBy("mode").agg(F.max(F.when(F.col("rn") == 1, F.col("Year"))).alias("minYear"),
                                 F.max(F.when(F.col("rn") == 7, F.col("Year"))).alias("maxYear"))


def q_distinct_years(spark, d):
    src = _src(spark, d, "time_phase_period")
    return src.time_phase_period.select(left("FiscalMonth", 4).alias("Year")).distinct()


def q_union_distinct_years(spark, d):
    parts = resource_profile_parts(_profile_src(spark, d), PROFILE_PARAMS)
    return parts.years.select("Year", F.col("rn").cast("long").alias("rn"))


CLAMPS = (("a", "0", "1997", None), ("b", "0", "1996", "1999"), ("c", "3", None, None), ("d", "9", "1996", "1999"))


def q_clamp_year_month(spark, d):
    src = _src(spark, d, "time_phase_weekly")
    fm = src.time_phase_weekly.select(F.col("BR_FiscalMonth").alias("FM")).distinct()
    arms = []
    for tag, mode, lo, hi in CLAMPS:
        y, m = cal_plans.clamp_year_month(F.col("FM"), mode, lo, hi)
        arms.append(fm.select(F.lit(tag).alias("setting"), "FM", y.alias("Year"), m.alias("Month")))
    return reduce(DataFrame.unionByName, arms)


def q_minmax_period(spark, d):
    parts = resource_profile_parts(_profile_src(spark, d), PROFILE_PARAMS)
    return parts.bb.agg(F.min(F.concat("Year", "Month")).alias("MIN"), F.max(F.concat("Year", "Month")).alias("MAX"))


def q_resource_hours_by_month(spark, d):
    parts = resource_profile_parts(_profile_src(spark, d), PROFILE_PARAMS)
    return _cast(parts.bb, ["Hours"], D38)


def q_dense_month_spine(spark, d):
    parts = resource_profile_parts(_profile_src(spark, d), PROFILE_PARAMS)
    return _cast(parts.spine, ["Hours", "Cumm_Hrs"], D38)


def q_running_total(spark, d):
    o = _t(spark, d, "orders")
    monthly = o.groupBy(fiscal_month_code("o_orderdate").alias("FM")).agg(F.count(F.lit(1)).alias("n"),
                                                                          F.sum(F.col("o_totalprice").cast(D)).alias("amount"))
    monthly = ordinal(monthly, ["FM"], "id")
    out = running_total(running_total(monthly, "id", "n", "cum_n"), "id", "amount", "cum_amount")
    return _cast(out, ["amount", "cum_amount"], D38)


def q_template_row(spark, d):
    parts = resource_profile_parts(_profile_src(spark, d), PROFILE_PARAMS)
    return _cast(parts.template, ["Hours"], D38)


def q_profile_union(spark, d):
    return resource_profile(_profile_src(spark, d), PROFILE_PARAMS)


def q_star_join_inner(spark, d):
    li, o, c, n = (_t(spark, d, x) for x in ("lineitem", "orders", "customer", "nation"))
    j = li.join(o, li.l_orderkey == o.o_orderkey).join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
    out = j.groupBy("n_name", fiscal_month_code("o_orderdate").alias("FM")).agg(
        F.sum(F.col("l_quantity").cast(D)).alias("Hours"), F.count(F.lit(1)).alias("n"))
    return _cast(out, ["Hours"], D38)


def q_outer_join_filtered_right(spark, d):
    c, o = _t(spark, d, "customer"), _t(spark, d, "orders")
    f = o.where(F.col("o_orderstatus") == "F").select("o_custkey", "o_orderkey")
    j = c.join(f, c.c_custkey == f.o_custkey, "left")
    return j.groupBy("c_custkey").agg(F.count("o_orderkey").alias("n_f_orders"))


def q_computed_key_join(spark, d):
    src, br = _ev(spark, d, "actuals")
    a = br.l2_now().select("Activity_ID", "Activity_Name")
    ah = src.actual_hour
    j = ah.join(a, F.col("Activity_ID") == concat_null(F.col("Project"), F.col("wbs")))
    out = j.groupBy("Activity_ID", "Activity_Name").agg(F.sum("Hours").alias("Hours"))
    return _cast(out, ["Hours"], D38)


def q_null_aware_anti_join(spark, d):
    c, o = _t(spark, d, "customer"), _t(spark, d, "orders")
    cust = c.select("c_custkey")
    f = o.where(F.col("o_orderstatus") == "F").select("o_custkey")
    with_null = o.select(F.when(F.col("o_orderstatus") == "P", F.lit(None)).otherwise(F.col("o_custkey")).alias("o_custkey"))
    guarded = with_null.select(F.coalesce("o_custkey", F.lit(-1).cast("long")).alias("o_custkey"))
    empty = f.where(F.lit(False))
    arms = [
        null_aware_anti_join(cust, "c_custkey", f, "o_custkey").select(F.lit("plain").alias("variant"), "c_custkey"),
        null_aware_anti_join(cust, "c_custkey", with_null, "o_custkey").select(F.lit("null_in_list").alias("variant"), "c_custkey"),
        null_aware_anti_join(cust, "c_custkey", guarded, "o_custkey").select(F.lit("guarded").alias("variant"), "c_custkey"),
        null_aware_anti_join(cust, "c_custkey", empty, "o_custkey").select(F.lit("empty_list").alias("variant"), "c_custkey"),
    ]
    return reduce(DataFrame.unionByName, arms)


def q_snapshot_month_matrix(spark, d):
    return snapshot_month_matrix(_src(spark, d, "wbs_monthly").wbs_monthly, project="73113")


def q_source_gate(spark, d):
    src = _src(spark, d, "snapshot_period")
    o = _t(spark, d, "orders")
    probes = o.select(F.trunc(F.to_date("o_orderdate"), "month").alias("period")).distinct().unionByName(
        src.snapshot_period.where(F.col("PeriodType") == "Weekly").select(F.col("SnapshotDate").alias("period"))).distinct()
    return gate_frame(probes, "period", src.snapshot_period)


def q_string_key_functions(spark, d):
    p = _t(spark, d, "part")
    return p.select(
        "p_partkey",
        concat_null(F.col("p_type"), " - ", F.col("p_name")).alias("title"),
        concat_null(F.col("p_type"), F.when(F.col("p_size") > 40, F.col("p_brand"))).alias("null_prop"),
        left("p_brand", 5).alias("brand_left"), right("p_brand", 2).alias("brand_right"),
        number_text("p_retailprice").alias("price_text"), spaces(4).alias("blank4"),
        lacks_suffix("p_name", "t").alias("not_t"),
    )


def q_date_functions(spark, d):
    o = _t(spark, d, "orders")
    od = F.to_date("o_orderdate")
    return o.select(
        "o_orderkey", mdy("o_orderdate").alias("mdy"), add_days(od, 1).alias("next_day"), add_weeks(od, 1).alias("next_week"),
        add_months(od, 1).alias("next_month"), add_months(F.last_day(od), 1).alias("eom_next_month"),
        year_text("o_orderdate").alias("year"), work_week_code("o_orderdate").alias("work_week"),
        fiscal_month_code("o_orderdate").alias("fiscal_month"))


def q_cast_functions(spark, d):
    p = _t(spark, d, "part")
    y = year_text(F.lit(dt.date(2000, 6, 30)))
    return p.select(
        "p_partkey", F.col("p_size").cast("string").alias("size_text"),
        (y.cast("int") - 3).alias("year_minus_3"), (y.cast("int") + F.col("p_size")).alias("year_plus_size"),
        F.col("p_retailprice").cast(D).alias("price_dec"), F.col("p_size").cast("long").alias("size_long"))


def q_null_defaults(spark, d):
    p = _t(spark, d, "part")
    t = F.when(F.col("p_type") != "PROMO", F.col("p_type"))
    b = F.when(F.col("p_brand") != "Brand#1", F.col("p_brand"))
    return p.select("p_partkey", isnull(t, "Not Available").alias("type_or_na"),
                    F.coalesce(b, t, F.lit("none")).alias("first_non_null"),
                    isnull(F.when(F.col("p_size") > 10, F.col("p_size")), 0).alias("size_or_zero"))


LIVE_PARAMS = ReportParams(period_type="Weekly", period=dt.date(2001, 1, 1), projects=None, piepccc=None,
                           baseline_type="Approved", group="Bundle")


def q_ledger_live(spark, d):
    return ledger_only(_ledger_src(spark, d, LIVE_PARAMS), LIVE_PARAMS)


def q_ev_project_report_live(spark, d):
    return _report_measures(ev_report(_report_src(spark, d, LIVE_PARAMS), LIVE_PARAMS))


RECOVERY_STRAT3 = ReportParams(period_type="Weekly", period=dt.date(2000, 1, 1), projects=None, piepccc=None,
                               baseline_type="Recovery", group="Strat III")


def q_ev_project_report_recovery_strat3(spark, d):
    return _report_measures(ev_report(_report_src(spark, d, RECOVERY_STRAT3), RECOVERY_STRAT3))


def q_fiscal_week_map_half_open(spark, d):
    src = _src(spark, d, "date_dim", "work_week")
    return cal_plans.fiscal_week_map(src.date_dim, src.work_week, half_open=True)


def q_snapshot_month_matrix_by_month(spark, d):
    return snapshot_month_matrix(_src(spark, d, "wbs_monthly").wbs_monthly, project="73113", match="month")


def q_snapshot_month_matrix_gaps(spark, d):
    """Snapshots on month ends, with gaps (every July, the whole of 1998): the steps drift to the
    28th, and months without a snapshot stay empty."""
    taken = F.to_date("o_orderdate")
    ends = _t(spark, d, "orders").where((F.month(taken) != 7) & (F.year(taken) != 1998)).select(
        F.last_day(taken).cast("timestamp_ntz").alias("SNAPSHOT_DATE"))
    return snapshot_month_matrix(ends, project="73113", match="month")


# ------------------------------------------------------------- reports with parameters set
# The fixed values below are repeated in the SQL of the oracles.
PROJECTS = ("ECONOMY", "MEDIUM", "PROMO", "LARGE", "NO SUCH PROJECT")
PIEPCCC = ("0", "2", "3", "5", "6")
LISTED = replace(EV_PARAMS, projects=PROJECTS, piepccc=PIEPCCC, group="Vendor")
LISTED_LIVE_RECOVERY = replace(LIVE_PARAMS, projects=PROJECTS, piepccc=PIEPCCC, baseline_type="Recovery", group="Strat IV")
LIVE_ORIGINAL = replace(LIVE_PARAMS, baseline_type="Original", group="Project")
QUARTER = replace(EV_PARAMS, period_type="Quarter", group="none of the labels")
LISTED_PROFILE = replace(PROFILE_PARAMS, projects=PROJECTS, piepccc=PIEPCCC, outage_segments=("0", "2", "3"),
                         resources=("R1", "R2", "R8", "R12", "R20"))


def q_actuals_cascade_listed(spark, d):
    return _ledger(actuals_cascade(_ev(spark, d, "actuals", params=LISTED)[1]))


def q_ev_project_report_listed(spark, d):
    return _report_measures(ev_report(_report_src(spark, d, LISTED), LISTED))


def q_ev_project_report_live_recovery_listed(spark, d):
    return _report_measures(ev_report(_report_src(spark, d, LISTED_LIVE_RECOVERY), LISTED_LIVE_RECOVERY))


def q_ev_project_report_live_original(spark, d):
    return _report_measures(ev_report(_report_src(spark, d, LIVE_ORIGINAL), LIVE_ORIGINAL))


def q_ev_project_report_quarter(spark, d):
    return _report_measures(ev_report(_report_src(spark, d, QUARTER), QUARTER))


def q_resource_hours_by_month_listed(spark, d):
    return _cast(resource_profile_parts(_profile_src(spark, d), LISTED_PROFILE).bb, ["Hours"], D38)


def q_profile_union_listed(spark, d):
    return resource_profile(_profile_src(spark, d), LISTED_PROFILE)


def q_param_long_list(spark, d):
    """A list of 100,000 values and one given as a table: semi-joins, not literals."""
    src = _src(spark, d, "activity_l2_weekly")
    keys = tuple(str(k) for k in range(0, 200_000, 2))
    named = _t(spark, d, "part").where(F.col("p_size") > 40).select("p_type").distinct()
    a = src.activity_l2_weekly.where(in_list(F.col("Activity_Key").cast("string"), keys) & in_list("BR_ProjectNumber", named))
    return a.groupBy("Snapshot_Date", "BR_ProjectNumber").agg(F.count(F.lit(1)).alias("n"))


# ------------------------------------------------------ one global order over a whole fact

def q_ordinal_on_fact(spark, d):
    o = _t(spark, d, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("day"))
    return ordinal_by_ranges(o, ["day", "o_orderkey"])


def q_running_total_on_fact(spark, d):
    li = _t(spark, d, "lineitem").groupBy(F.to_date("l_shipdate").alias("day"), "l_partkey").agg(F.sum(F.col("l_quantity").cast(D)).alias("qty"))
    return _cast(running_total_by_ranges(li, ["day", "l_partkey"], "qty", "so_far"), ["qty", "so_far"], D38)


def q_asof_on_fact(spark, d):
    """The dearest order so far, for every shipment."""
    li = _t(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_shipdate")
    return asof_max_by_ranges(li, "l_shipdate", _t(spark, d, "orders"), "o_orderdate", "o_totalprice", "dearest")


# ------------------------------------------------- comparison without case and trailing blanks

#: compared columns that stand inside a computed key, where blanks count
INSIDE = ("Project",)
CASE_BLIND_EV = replace(EV_PARAMS, projects=tuple(p.lower() + " " for p in PROJECTS), piepccc=PIEPCCC, baseline_type="APPROVED ",
                        group="vendor", comparison=CASE_BLIND)
CASE_BLIND_PROFILE = replace(LISTED_PROFILE, projects=tuple(p.title() for p in PROJECTS), resources=("r1", "r2 ", "R8", "r12", "R20"),
                             comparison=CASE_BLIND)


def _misspelled(df: DataFrame) -> DataFrame:
    """A source view in which a third of the rows have their compared texts in lower case, and
    a third with blanks behind them."""
    draw = F.pmod(F.xxhash64(*df.columns), F.lit(3))
    texts = [f.name for f in df.schema.fields if f.dataType.simpleString() == "string" and (f.name in KEYS or f.name in SPELLINGS)]

    def written(c: str):
        blanks = F.col(c) if c in INSIDE else F.concat(F.col(c), F.lit("  "))
        return F.when(draw == 0, F.lower(c)).when(draw == 1, blanks).otherwise(F.col(c)).alias(c)

    return df.select(*[written(c) if c in texts else F.col(c) for c in df.columns])


def _misspelled_sources(src: ProjectSources) -> ProjectSources:
    views = {f.name: getattr(src, f.name) for f in fields(src)}
    return replace(src, **{n: _misspelled(df) for n, df in views.items() if df is not None})


def _keyed(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*[F.upper(F.rtrim(c)).alias(c) if c in columns else F.col(c) for c in df.columns])


def q_ledger_case_blind(spark, d):
    params = replace(CASE_BLIND_EV, projects=None, piepccc=None)
    out = ledger_only(_misspelled_sources(_ledger_src(spark, d, params)), params)
    return _keyed(out, "ProjectNumber", "Activity_ID", "Activity_Name", "PIEPCCC", "WorkWeek")


def q_ev_project_report_case_blind(spark, d):
    out = _report_measures(ev_report(_misspelled_sources(_report_src(spark, d, CASE_BLIND_EV)), CASE_BLIND_EV))
    return _keyed(out, "ProjectNumber", "ProjectTitleCombined", "Activity_ID", "Activity_Name", "PIEPCCC")


def q_resource_hours_by_month_case_blind(spark, d):
    return _cast(resource_profile_parts(_misspelled_sources(_profile_src(spark, d)), CASE_BLIND_PROFILE).bb, ["Hours"], D38)


QUERIES = {
    name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}
