import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from sorted_rows import rows
from hourglass.params import ReportParams, ResolvedPeriods
from hourglass.plans import calendar as C
from hourglass.plans.earned import earned_value_rows
from hourglass.plans.gate import use_live_sources
from hourglass.plans.ledger import Branch, actuals_cascade, baseline_selection, work_package_map
from hourglass.plans.matrix import snapshot_month_matrix
from hourglass.sources.catalog import ProjectSources

D = dt.date
SP = "SnapshotPeriod string, SnapshotDate date, PeriodType string, ActivityIsProcessed int"


def test_period_rollup_table(spark):
    sp = spark.createDataFrame([("March 2017", D(2017, 3, 31), "Monthly", 1), ("April 2017", D(2017, 4, 30), "Monthly", 1),
                                ("December 2017", D(2017, 12, 31), "Monthly", 0), ("2017WW22", D(2017, 6, 2), "Weekly", 1)], SP)
    got = rows(C.period_rollup_table(sp), "SnapshotPeriod", "PeriodType")
    assert got == [("2017", "Year"), ("2017Q1", "Quarter"), ("2017Q4", "Quarter"), ("2017WW22", "Weekly"),
                   ("April 2017", "Monthly"), ("December 2017", "Monthly"), ("March 2017", "Monthly")]


def test_resolve_periods_with_and_without_history(spark):
    sp = spark.createDataFrame([("a", D(2017, 5, 26), "Weekly", 1), ("b", D(2017, 5, 19), "Weekly", 1),
                                ("c", D(2017, 6, 2), "Weekly", 1)], SP)
    ww = spark.createDataFrame([("2017WW20", D(2017, 5, 15)), ("2017WW21", D(2017, 5, 22)), ("2017WW22", D(2017, 5, 29))],
                               "WorkWeek string, WWStartDate date")
    r = C.resolve_periods(C.period_rollup_table(sp), ww, "Weekly", D(2017, 6, 2))
    assert (r.last_period, r.last2_period) == (D(2017, 5, 26), D(2017, 5, 19))
    assert (r.period_week, r.last_period_week, r.last2_period_week) == ("2017WW22", "2017WW21", "2017WW20")
    r0 = C.resolve_periods(C.period_rollup_table(sp), ww, "Weekly", D(2017, 5, 19))
    assert (r0.last_period, r0.last2_period, r0.last_period_week) == (None, None, None)


def test_fiscal_week_map_double_match(spark):
    dd = spark.createDataFrame([(D(2017, 1, 3), "F1"), (D(2017, 1, 9), "F1"), (D(2017, 1, 12), "F2")], "Date date, FiscalWeek string")
    ww = spark.createDataFrame([("W1", D(2017, 1, 2)), ("W2", D(2017, 1, 9))], "WorkWeek string, WWStartDate date")
    assert rows(C.fiscal_week_map(dd, ww)) == [("F1", "W1"), ("F1", "W2"), ("F2", "W2")]
    assert rows(C.fiscal_week_map(dd, ww, half_open=True)) == [("F1", "W2"), ("F2", "W2")]


def test_clamp_modes(spark):
    df = spark.createDataFrame([("201412",), ("201703",), ("203005",)], "fm string")

    def run(mode, lo, hi):
        y, m = C.clamp_year_month(F.col("fm"), mode, lo, hi)
        return [(r[0], r[1]) for r in df.select(y, m).orderBy("fm").collect()]

    assert run("1", None, None) == [("2015", "01"), ("2017", "03"), ("2030", "05")]
    assert run("0", "2016", "2022") == [("2016", "01"), ("2017", "03"), ("2022", "01")]
    assert run("0", "2016", None) == [("2016", "01"), ("2017", "03"), ("2030", "05")]


def test_year_axis_short_has_null_max(spark):
    cal = spark.createDataFrame([(D(y, 1, 1),) for y in range(2014, 2020)], "Date date")
    axis = C.year_axis(cal, "0", "2017")
    assert rows(axis) == [(str(y), i + 1) for i, y in enumerate(range(2014, 2020))]
    assert tuple(spark.range(1).select(*C.axis_bounds(axis)).collect()[0]) == ("2014", None)
    assert C.year_axis(cal, "7", "2017").count() == 0


def test_dense_spine_fills_and_accumulates(spark):
    cal = spark.createDataFrame([("201701",), ("201702",), ("201703",), ("201704",)], "FiscalMonth string")
    hours = spark.createDataFrame([("201702", Decimal("1.5")), ("201704", Decimal("2.25"))], "FM string, Hours decimal(19,6)")
    lo, hi = C.spine_bounds("201701", "201703", "201702", "201704")
    out = [(r["id"], r["FM"], float(r["Hours"]), float(r["Cumm_Hrs"])) for r in C.dense_month_spine(cal, hours, lo, hi).orderBy("id").collect()]
    assert out == [(1, "201701", 0.0, 0.0), (2, "201702", 1.5, 1.5), (3, "201703", 0.0, 1.5), (4, "201704", 2.25, 3.75)]
    lo, hi = C.spine_bounds("201701", "201703", None, None)
    assert C.dense_month_spine(cal, hours, lo, hi).count() == 0


def test_gate_three_valued(spark):
    def sp(dates):
        return spark.createDataFrame([("x", d, "Weekly", 1) for d in dates], SP)
    p = D(2017, 6, 2)
    assert use_live_sources(spark.createDataFrame([], SP), p) is True
    assert use_live_sources(sp([p]), p) is False
    assert use_live_sources(sp([D(2017, 5, 26)]), p) is True
    assert use_live_sources(sp([D(2017, 5, 26), None]), p) is False
    assert use_live_sources(sp([D(2017, 5, 26)]), None) is False


def test_baseline_selection_cases(spark):
    bl = spark.createDataFrame([("P1", "Approved"), ("P1", "Recovery"), ("P2", "Approved"), ("P2", "Homer"), ("P3", "Homer"),
                                ("P4", "Original")], "Project_ID string, BaselineType string")
    assert rows(baseline_selection(bl, "Approved")) == [("P1", "Approved"), ("P2", "Homer"), ("P3", "Homer")]
    assert rows(baseline_selection(bl, "Recovery")) == [("P1", "Recovery"), ("P2", "Approved")]


def test_earned_value_rows_cases(spark):
    wp = spark.createDataFrame([
        (D(2017, 6, 2), 1, "A1", "n1", "P", "5", Decimal(50), Decimal(100)),   # matched
        (D(2017, 5, 26), 1, "A1", "n1", "P", "5", Decimal(20), Decimal(100)),
        (D(2017, 6, 2), 2, "A2", "n2", "P", "5", Decimal(10), Decimal(10)),    # new
        (D(2017, 5, 26), 3, "A3", "n3", "P", "5", Decimal(100), None),         # dropped
    ], "Snapshot_Date date, Activity_Key int, Activity_ID string, Activity_Name string, BR_ProjectNumber string, "
       "BR_PIEPCCC string, BR_Percent_Complete decimal(19,6), budget decimal(19,6)")
    v = earned_value_rows(wp, D(2017, 6, 2), D(2017, 5, 26))
    got = rows(v.select("Snapshot_Date", "Activity_ID", F.col("Earned_LTD").cast("double"), F.col("Earned_Last_LTD").cast("double")))
    assert got == [(D(2017, 5, 26), "A1", 20.0, 0.0), (D(2017, 5, 26), "A3", 0.0, 0.0), (D(2017, 6, 2), "A1", 50.0, 20.0),
                   (D(2017, 6, 2), "A2", 1.0, 0.0), (D(2017, 6, 2), "A3", 0.0, 0.0)]
    total = v.agg(F.sum(F.col("Earned_LTD") - F.col("Earned_Last_LTD"))).collect()[0][0]
    assert float(total) == 51.0  # current LTD total
    only_cur = earned_value_rows(wp, D(2017, 6, 2), None)
    assert only_cur.where(F.col("Earned_Last_LTD") != 0).count() == 0


def _cascade_sources(spark, ah_project_null: bool):
    s = ProjectSources()
    s.time_phase_period = spark.createDataFrame([(D(2017, 5, 30), "2017WW22", "201705")], "Date date, WorkWeek string, FiscalMonth string")
    s.date_dim = spark.createDataFrame([(D(2017, 5, 30), "FW1")], "Date date, FiscalWeek string")
    s.work_week = spark.createDataFrame([("2017WW22", D(2017, 5, 29))], "WorkWeek string, WWStartDate date")
    s.project_master = spark.createDataFrame([("P1",), ("P2",), ("P3",)], "ProjectNumber string")
    s.activity_l2_weekly = spark.createDataFrame(
        [(D(2017, 6, 2), "P1A", "act", "P1", "5"), (D(2017, 6, 2), "P2A", None, "P2", "5"),
         (D(2017, 6, 2), "P3A", "Not Available", "P3", "5")],
        "Snapshot_Date date, Activity_ID string, Activity_Name string, BR_ProjectNumber string, BR_PIEPCCC string")
    s.weekly_burden = spark.createDataFrame([("L1", D(2017, 5, 30), Decimal(4))], "alter_cost_c1_ string, week_ending date, Total_Hours decimal(19,6)")
    s.wbs_lookup = spark.createDataFrame([("L1", "P1A", "P1")], "line_code string, wp string, project_no string")
    ah = [("P1", "A", D(2017, 5, 30), Decimal(1)), ("P2", "A", D(2017, 5, 30), Decimal(2))]
    if ah_project_null:
        ah.append((None, "A", D(2017, 5, 30), Decimal(9)))
    s.actual_hour = spark.createDataFrame(ah, "Project string, wbs string, date00 date, Hours decimal(19,6)")
    s.fin_transaction = spark.createDataFrame([("P3", "P3A", "FW1", "5x", 1, Decimal(3)), ("P3", "ZZ", "FW1", "5x", 1, Decimal(5))],
                                              "Project string, WorkPackage string, FiscalWeek string, Local string, FinSourceSystem_FKey long, HoursQuantity decimal(19,6)")
    s.fin_source_system = spark.createDataFrame([(1, "Tempus")], "FinSourceSystem_Key long, FinSourceSystemDesc string")
    s.timesheet = spark.createDataFrame([("P3", "A", "APPROVED", D(2017, 5, 30), Decimal(7)), ("P3", "A", "REJECTED", D(2017, 5, 30), Decimal(70))],
                                        "Project string, WBS string, Approval_Status string, TS_Date date, Hrs decimal(19,6)")
    return s


def test_actuals_cascade_priorities_and_null_project(spark):
    per = ResolvedPeriods(D(2017, 6, 2), None, None, "2017WW22", None, None)
    p = ReportParams(period=D(2017, 6, 2), projects=("P1", "P2", "P3"), piepccc=("5", "A"))
    br = Branch(_cascade_sources(spark, False), p, per, live=False)
    s12, s3, s4 = [rows(a, "ProjectNumber", "Activity_ID", "Activity_Name", "Hours") for a in actuals_cascade(br)]
    assert s12 == [("P1", "P1A", "act", Decimal("4.000000")),                    # source 2 of P1 skipped: has source-1 rows
                   ("P2", "P2A", "Not Available", Decimal("2.000000"))]
    assert s3 == [("P3", "P3A", "Not Available", Decimal("3.000000")), ("P3", "ZZ", "Not Available", Decimal("5.000000"))]
    assert s4 == [("P3", "P3A", "Not Available", Decimal("7.000000"))]
    br_null = Branch(_cascade_sources(spark, True), p, per, live=False)
    arms = actuals_cascade(br_null)
    assert arms[1].count() == 0 and arms[2].count() == 0                          # NULL project empties 3 and 4
    # parameters as tables and long lists keep the results
    many = tuple(f"P{k}" for k in range(1, 2000))
    named = spark.createDataFrame([("P1",), ("P2",), ("P3",)], "p string")
    for projects in (many, named):
        q = ReportParams(period=D(2017, 6, 2), projects=projects, piepccc=("5", "A"))
        arms = actuals_cascade(Branch(_cascade_sources(spark, False), q, per, live=False))
        assert [rows(a, "ProjectNumber", "Activity_ID", "Activity_Name", "Hours") for a in arms] == [s12, s3, s4]


def test_work_package_map_prefers_loe_then_lowest_id(spark):
    s = ProjectSources()
    s.activity_l2_weekly = spark.createDataFrame(
        [(D(2017, 6, 2), "PKG", "B", "nb", "Y", "P"), (D(2017, 6, 2), "PKG", "A", "na", "N", "P"), (D(2017, 6, 2), "PKG", "C", "nc", "Y", "P"),
         (D(2017, 5, 26), "PKG", "A", "na", None, "P"), (D(2017, 5, 26), "PKG", "Z", "nz", "N", "P")],
        "Snapshot_Date date, BR_L2WorkPackage string, Activity_ID string, Activity_Name string, BR_NR_LOE_WORK_Val string, BR_ProjectNumber string")
    per = ResolvedPeriods(D(2017, 6, 2), D(2017, 5, 26), None, None, None, None)
    m = work_package_map(Branch(s, ReportParams(projects=("P",)), per, live=False))
    assert rows(m, "Snapshot_Date", "Activity_ID", "WorkPackage") == [(D(2017, 5, 26), "Z", "Z - nz"), (D(2017, 6, 2), "B", "B - nb")]


def test_snapshot_month_matrix_drift_and_null(spark):
    ts = [dt.datetime(2017, 1, 31), dt.datetime(2017, 2, 28), dt.datetime(2017, 3, 31), dt.datetime(2017, 4, 28)]
    df = spark.createDataFrame([(t,) for t in ts], "SNAPSHOT_DATE timestamp_ntz")
    m = snapshot_month_matrix(df)
    assert m.columns == ["ProjectNumber", "01/31/2017", "02/28/2017", "03/28/2017", "04/28/2017"]
    assert tuple(m.collect()[0]) == ("73113", 1, 2, None, 4)
    by_month = snapshot_month_matrix(df, match="month").collect()[0]
    assert tuple(by_month) == ("73113", 1, 2, 3, 4)
    with_null = spark.createDataFrame([(None,)] + [(t,) for t in ts], "SNAPSHOT_DATE timestamp_ntz")
    assert snapshot_month_matrix(with_null).count() == 0
