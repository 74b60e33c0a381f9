import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from sorted_rows import rows
from hourglass.params import ReportParams, ResolvedPeriods
from hourglass.plans.earned import earned_value_rows, grouping_label, project_report
from hourglass.plans.ledger import LEDGER_SCHEMA, Branch
from hourglass.sources.catalog import ProjectSources

D = dt.date


def test_grouping_labels(spark):
    pm = spark.createDataFrame([("P1", "Bund", "Title", "Vend", None, "IV")],
                               "ProjectNumber string, BundleTitleLong string, ProjectTitleLong string, VendorDescription string, "
                               "ProjectAttribute_STRATUM_III string, ProjectAttribute_STRATUM_IV string")
    got = {g: pm.select(grouping_label(g)).collect()[0][0] for g in ("Project", "Bundle", "Vendor", "Strat III", "Strat IV", "x")}
    assert got == {"Project": "Title", "Bundle": "Bund", "Vendor": "Vend", "Strat III": "Strat III: Not Available",
                   "Strat IV": "Strat IV: IV", "x": "N/A"}


def _report_sources(spark):
    s = ProjectSources()
    s.project_master_ext = spark.createDataFrame(
        [("P1", "B", "PG", "T", "V", None, None, 1)],
        "ProjectNumber string, BundleTitleLong string, ProgramWBS string, ProjectTitleLong string, VendorDescription string, "
        "ProjectAttribute_STRATUM_III string, ProjectAttribute_STRATUM_IV string, IsCurrent int")
    # two L2 rows with the same (activity, project): the report's join multiplies the sums
    s.activity_l2_weekly = spark.createDataFrame(
        [(D(2017, 6, 2), "A1", "P1", D(2017, 9, 1)), (D(2017, 6, 2), "A1", "P1", D(2017, 10, 1))],
        "Snapshot_Date date, Activity_ID string, BR_ProjectNumber string, Finish date")
    return s


def test_safe_finish_removes_fan_out(spark):
    s = _report_sources(spark)
    led = spark.createDataFrame([("P1", "A1", "n", "5", "2017WW22", Decimal(3), Decimal(0), "Planned")], LEDGER_SCHEMA)
    per = ResolvedPeriods(D(2017, 6, 2), D(2017, 5, 26), None, "2017WW22", "2017WW21", None)
    plain = project_report(led, Branch(s, ReportParams(), per, live=False), sort=False).collect()[0]
    safe = project_report(led, Branch(s, ReportParams(safe_finish=True), per, live=False), sort=False).collect()[0]
    assert plain["LC_PV"] == Decimal(6) and safe["LC_PV"] == Decimal(3)       # duplicate finish rows double the sums
    assert plain["finish"] == safe["finish"] == D(2017, 10, 1)
    assert plain["Week_PV"] == Decimal(6) and plain["LTD_PV"] == Decimal(6) and plain["Week_AV"] == 0


def test_live_rows_without_period_plus_one(spark):
    """If Live rows do not carry period + 1 day, nothing matches: current rows become
    full gains and previous rows come back negative; the total is still the current LTD."""
    wp = spark.createDataFrame([
        (D(2017, 6, 2), 1, "A1", "n", "P", "5", Decimal(50), Decimal(100)),     # Live row dated the period itself
        (D(2017, 5, 26), 1, "A1", "n", "P", "5", Decimal(20), Decimal(100)),
    ], "Snapshot_Date date, Activity_Key int, Activity_ID string, Activity_Name string, BR_ProjectNumber string, "
       "BR_PIEPCCC string, BR_Percent_Complete decimal(19,6), budget decimal(19,6)")
    v = earned_value_rows(wp, D(2017, 6, 3), D(2017, 5, 26))
    got = rows(v.select("Snapshot_Date", F.col("Earned_LTD").cast("double"), F.col("Earned_Last_LTD").cast("double")))
    assert got == [(D(2017, 5, 26), 20.0, 0.0), (D(2017, 6, 2), 50.0, 0.0), (D(2017, 6, 3), 0.0, 20.0)]
    assert float(v.agg(F.sum(F.col("Earned_LTD") - F.col("Earned_Last_LTD"))).collect()[0][0]) == 50.0


def test_branch_names_missing_sources(spark):
    import pytest

    per = ResolvedPeriods(D(2017, 6, 2), None, None, None, None, None)
    with pytest.raises(ValueError, match="activity_l2_daily"):
        Branch(ProjectSources(), ReportParams(), per, live=True).l2_now()


def test_profile_current_week_defaults_to_latest_processed(spark):
    from hourglass.plans.profile import current_week

    sp = spark.createDataFrame([("a", D(2017, 5, 26), "Weekly", 1), ("b", D(2017, 6, 2), "Weekly", 0),
                                ("c", D(2017, 6, 30), "Monthly", 1)],
                               "SnapshotPeriod string, SnapshotDate date, PeriodType string, ActivityIsProcessed int")
    assert current_week(sp) == D(2017, 5, 26)


def test_weekly_columns_have_l3_before_actuals():
    from hourglass.params import ResolvedPeriods
    from hourglass.plans.earned import measures

    per = ResolvedPeriods(None, None, None, "a", "b", "c")
    names = [[m[0] for m in measures(per, live) if m[0].startswith("LTD_")] for live in (False, True)]
    assert names == [["LTD_PV", "LTD_FC", "LTD_EV", "LTD_FC3", "LTD_AV", "LTD_AVLast"],
                     ["LTD_PV", "LTD_FC", "LTD_EV", "LTD_AV", "LTD_AVLast", "LTD_FC3"]]


def test_no_list_restricts_by_default():
    from hourglass.params import ProfileParams, ReportParams

    p, q = ReportParams(), ProfileParams()
    assert (p.projects, p.piepccc, q.projects, q.piepccc, q.outage_segments, q.resources) == (None,) * 6


def test_report_rows_come_in_the_final_order(spark):
    """Ascending actual hours of the week, NULL first; then descending remaining hours, NULL last."""
    s = _report_sources(spark)
    rng = [(f"A{k}", Decimal(k % 3) if k % 4 else None, Decimal(k * 7 % 5) if k % 5 else None) for k in range(24)]
    led = spark.createDataFrame(
        [("P1", a, "n", "5", "2017WW22", actual, None, "Actual") for a, actual, _ in rng]
        + [("P1", a, "n", "5", "2017WW22", left, None, "Remaining") for a, _, left in rng], LEDGER_SCHEMA)
    per = ResolvedPeriods(D(2017, 6, 2), D(2017, 5, 26), None, "2017WW22", "2017WW21", None)
    got = [(r["Week_AV"], r["LC_RV"]) for r in project_report(led, Branch(s, ReportParams(), per, live=False)).collect()]
    key = lambda r: (r[0] is not None, r[0] or 0, r[1] is None, -(r[1] or 0))
    assert len(got) == 24 and got == sorted(got, key=key)
    assert any(a == b for a, b in zip([r[0] for r in got], [r[0] for r in got][1:]))


def test_the_report_sums_and_sorts_in_tasks_of_a_share_of_the_activities(spark):
    """The ledger's narrow rows are dealt by activity, not partial sums of 22 measures; activities without
    hours agree in both columns of the final order and still come in several of its ranges."""
    own = spark.newSession()
    own.conf.set("spark.sql.shuffle.partitions", 8)
    own.conf.set("spark.sql.adaptive.enabled", "false")
    s = _report_sources(own)
    led = own.createDataFrame([("P1", f"A{k}", "n", "5", "2017WW22", Decimal(k % 2), None, "Planned") for k in range(400)], LEDGER_SCHEMA)
    per = ResolvedPeriods(D(2017, 6, 2), D(2017, 5, 26), None, "2017WW22", "2017WW21", None)
    out = project_report(led, Branch(s, ReportParams(), per, live=False))
    plan = out._jdf.queryExecution().executedPlan().toString()
    shuffles = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert any("Exchange hashpartitioning(Activity_ID" in line and "REPARTITION_BY_NUM" in line for line in shuffles)
    assert not any("BundleTitleLong" in line for line in shuffles)
    ranges = [len(p) for p in out.select("Activity_ID").rdd.glom().collect()]
    assert sum(ranges) == 400 and sum(n > 0 for n in ranges) > 1 and max(ranges) < 200


def test_long_lists_tag_the_activities_as_short_ones_do(spark):
    from hourglass.plans.ledger import tagged_activities

    acts = spark.createDataFrame(
        [(k, f"P{k % 4}" if k % 7 else None, str(k % 3), "2" if k % 5 else "3", "9C" if k % 6 == 0 else "9", "TT_WBS" if k % 2 else "TT_LOE")
         for k in range(60)],
        "k int, BR_ProjectNumber string, BR_PIEPCCC string, BR_CM_ACTIVITY_LEVEL_Val string, BR_NR_EXECUTION_WINDOWS_Val string, Activity_Type string")
    short = ReportParams(projects=("P1", "P2"), piepccc=("0", "1"))
    long = ReportParams(projects=("P1", "P2", *[f"X{k}" for k in range(1500)], "P1"), piepccc=spark.createDataFrame([("0",), ("1",), (None,)], "p string"))
    now = F.col("k") < 30
    want = rows(tagged_activities(acts, short, now), "k", "arms")
    assert rows(tagged_activities(acts, long, now), "k", "arms") == want and {a for _, a in want} >= {1, 15 + 16, 8}
