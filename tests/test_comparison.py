"""Comparison without case and trailing blanks: keys, codes, slices, computed keys, parameters."""

import datetime as dt
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from hourglass.functions import in_list, lacks_suffix
from hourglass.params import ProfileParams, ReportParams, ResolvedPeriods
from hourglass.plans.earned import project_report
from hourglass.plans.ledger import LEDGER_SCHEMA, Branch, baseline_selection, work_package_map
from hourglass.sources import BINARY, CASE_BLIND, ProjectSources, compared_params, compared_sources
from hourglass.sources.comparison import FEED_KEY, key_of
from sorted_rows import rows

DAY = dt.date(2017, 6, 2)


def blind(**views):
    return compared_sources(ProjectSources(**views), CASE_BLIND)


def test_binary_changes_nothing(spark):
    src = ProjectSources(wbs_lookup=spark.createDataFrame([("a ",)], "line_code string"))
    assert compared_sources(src, BINARY) is src
    p = ReportParams(projects=("a ",))
    assert compared_params(p) is p
    with pytest.raises(ValueError, match="no comparison named"):
        compared_sources(src, "nocase")


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.none(), st.text("aAbB \t", max_size=4)), st.one_of(st.none(), st.text("aAbB \t", max_size=4))),
                min_size=1, max_size=12))
def test_keys_are_equal_where_padded_texts_are(spark, pairs):
    """Equal keys if and only if the texts are equal once padded to one length and lowered."""
    got = spark.createDataFrame(pairs, "a string, b string").select("a", "b", (key_of(F.col("a")) == key_of(F.col("b"))).alias("eq")).collect()
    for r in got:
        want = None if r["a"] is None or r["b"] is None else r["a"].ljust(9).lower() == r["b"].ljust(9).lower()
        assert r["eq"] == want, r


def test_codes_take_the_spelling_of_the_reports(spark):
    bl = spark.createDataFrame([("P1 ", "approved"), ("p1", "HOMER "), ("p2", "Homer"), ("P2", None), ("p3", "other")],
                               "Project_ID string, BaselineType string")
    src = blind(time_phase_baseline=bl)
    assert rows(baseline_selection(src.time_phase_baseline, "Approved")) == [("P1", "Homer"), ("P2", "Homer")]
    assert rows(baseline_selection(src.time_phase_baseline, "Recovery")) == [("P1", "Approved")]


def test_blanks_count_inside_functions(spark):
    acts = spark.createDataFrame([("12c",), ("12C ",), ("12",), (None,)], "BR_NR_EXECUTION_WINDOWS_Val string")
    src = blind(activity_l2_weekly=acts, timesheet=spark.createDataFrame([("p ", "5a "), ("p", "5A"), ("p", None)], "Project string, WBS string"))
    kept = src.activity_l2_weekly.where(lacks_suffix("BR_NR_EXECUTION_WINDOWS_Val"))
    assert rows(kept) == [("12",), ("12C ",)]                        # RIGHT('12C ', 1) is a blank, '12c' ends in C
    got = {tuple(r) for r in src.timesheet.select("Project", "WBS", FEED_KEY).collect()}
    assert got == {("P", "5A", "P 5A"), ("P", "5A", "P5A"), ("P", None, None)}


def test_package_map_merges_spellings(spark):
    cols = "Snapshot_Date date, BR_L2WorkPackage string, Activity_ID string, Activity_Name string, BR_NR_LOE_WORK_Val string, BR_ProjectNumber string"
    acts = spark.createDataFrame([(DAY, "pk", "a2", "n", "y", "p"), (DAY, "PK ", "A1", "n", "Y", "P"), (DAY, "pk", "a0", "n", "N", "P"),
                                  (DAY, "pk", "a0", "n", "Y", "q")], cols)
    p = compared_params(ReportParams(projects=("p  ",), comparison=CASE_BLIND))
    br = Branch(blind(activity_l2_weekly=acts), p, ResolvedPeriods(DAY, None, None, None, None, None), live=False)
    assert [(r["BR_L2WorkPackage"], r["Activity_ID"]) for r in work_package_map(br).collect()] == [("PK", "A1")]


def test_report_shows_what_is_written(spark):
    ext = spark.createDataFrame([("p1", "B", "PG", "T", "V", None, None, 1)], "ProjectNumber string, BundleTitleLong string, ProgramWBS string, "
                                "ProjectTitleLong string, VendorDescription string, ProjectAttribute_STRATUM_III string, "
                                "ProjectAttribute_STRATUM_IV string, IsCurrent int")
    acts = spark.createDataFrame([(DAY, "a1 ", "Dig", "P1", DAY), (DAY, "A1", "dig ", "p1 ", None)],
                                 "Snapshot_Date date, Activity_ID string, Activity_Name string, BR_ProjectNumber string, Finish date")
    led = spark.createDataFrame([("P1", "A1", "DIG", "5", "2017WW22", Decimal(3), Decimal(0), "Planned"),
                                 ("P1", "A9", "Not Available", "5", "2017WW22", Decimal(1), Decimal(0), "Actual")], LEDGER_SCHEMA)
    per = ResolvedPeriods(DAY, None, None, "2017WW22", None, None)
    br = Branch(blind(project_master_ext=ext, activity_l2_weekly=acts), ReportParams(safe_finish=True, comparison=CASE_BLIND), per, live=False)
    out = project_report(led, br, sort=False)
    assert not [c for c in out.columns if c.endswith("__written")]
    assert rows(out.select("ProjectNumber", "Activity_ID", "Activity_Name", "LC_PV", "BundleTitleLong")) == rows(spark.createDataFrame(
        [("P1", "A1", "Dig", Decimal(3), "B"), ("P1", "A9", "Not Available", Decimal(0), "B")],
        "p string, a string, n string, v decimal(38,6), b string"))


def test_parameters(spark):
    named = spark.createDataFrame([("x ",), (None,)], "v string")
    p = compared_params(ReportParams(period_type="WEEKLY ", projects=("a ", "B", None), piepccc="c", baseline_type="recovery", group="strat iii",
                                     comparison=CASE_BLIND))
    assert (p.period_type, p.projects, p.piepccc, p.baseline_type, p.group) == ("Weekly", ("A", "B", None), ("C",), "Recovery", "Strat III")
    q = compared_params(ProfileParams(resources=named, outage_segments=None, comparison=CASE_BLIND))
    assert q.outage_segments is None
    df = spark.createDataFrame([("X",), ("Y",), (None,)], "k string")
    assert rows(df.where(in_list("k", q.resources))) == [("X",)]


def test_snapshots_are_still_pruned(spark, tmp_path):
    df = spark.createDataFrame([(DAY, "p"), (dt.date(2017, 5, 26), "P")], "Snapshot_Date date, BR_ProjectNumber string")
    df.write.partitionBy("Snapshot_Date").parquet(str(tmp_path / "acts"))
    seen = blind(activity_l2_weekly=spark.read.parquet(str(tmp_path / "acts"))).activity_l2_weekly.where(F.col("Snapshot_Date") == DAY)
    assert "PartitionFilters: [isnotnull(Snapshot_Date" in seen._jdf.queryExecution().executedPlan().toString()
    assert [r["BR_ProjectNumber"] for r in seen.collect()] == ["P"]
