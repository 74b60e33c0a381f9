"""Invariants of the reports on the sf0.01 stand-ins."""

import os
import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import hourglass_queries as R
from hourglass.plans.earned import earned_arm, project_report
from hourglass.plans.ledger import build_ledger
from hourglass.plans.profile import resource_profile_parts

SF = os.environ.get("HOURGLASS_TEST_SF", "/root/testdata/sf0.01")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def ev(spark):
    src, br = R._ev(spark, SF)
    ledger = build_ledger(br, earned=earned_arm(br, src.time_phase_period))
    return src, br, ledger, project_report(ledger, br, sort=False)


def test_ledger_sums_survive_the_pivot(ev):
    _, _, ledger, report = ev
    by_type = {r["Type"]: r["h"] for r in ledger.groupBy("Type").agg(F.sum("Hours").alias("h")).collect()}
    tot = report.agg(*[F.sum(c).alias(c) for c in ("LC_PV", "LC_FC", "LC_RV", "LC_BV", "Burn", "LC_FC3")]).collect()[0]
    # report rows fan out only on duplicate finish rows; the stand-in has one L2 row per activity and snapshot
    assert tot["LC_PV"] == by_type["Planned"] and tot["LC_FC"] == by_type["Forecast"]
    assert tot["LC_RV"] == by_type["Remaining"] and tot["LC_BV"] == by_type["Budget"]
    assert tot["Burn"] == by_type["Forecast burned rate"] and tot["LC_FC3"] == by_type["Forecast L3"]


def test_lc_ev_is_current_ltd(ev):
    src, br, ledger, report = ev
    from hourglass.plans.earned import work_packages
    cur = work_packages(br).where(F.col("Snapshot_Date") == F.lit(br.periods.period))
    want = cur.agg(F.sum(F.coalesce("budget", F.lit(0)) * F.coalesce("BR_Percent_Complete", F.lit(0)) / 100)).collect()[0][0]
    got = report.agg(F.sum("LC_EV")).collect()[0][0]
    assert abs(Decimal(got) - Decimal(want)) < Decimal("0.0001") * max(1, ledger.count())


def test_profile_cumulative_ends_at_total(spark):
    parts = resource_profile_parts(R.standins.build(spark, SF), R.PROFILE_PARAMS)
    spine = parts.spine.orderBy("id").collect()
    assert spine and spine[-1]["Cumm_Hrs"] == sum(r["Hours"] for r in spine)
    n_bb, n_spine = parts.bb.count(), len(spine)
    assert parts.final.count() == n_bb + 2 * n_spine          # detail + zero rows + CU rows


def test_no_cartesian_product_on_facts_and_pruned_scans(spark, ev):
    _, _, ledger, report = ev
    plan = _plan(report)
    assert "CartesianProduct" not in plan
    assert "PartitionFilters: [isnotnull(Snapshot_Date" in plan
    # nested-loop joins only ever see one-row summaries or dimension-sized frames
    rng = _plan(R.q_calendar_range_join(spark, SF))
    assert "BroadcastNestedLoopJoin" not in rng and "CartesianProduct" not in rng


def test_top1_is_limited_before_the_shuffle(spark):
    plan = _plan(R.q_work_package_map(spark, SF))
    assert any("WindowGroupLimit" in line and "Partial" in line for line in plan.splitlines())


def _files(folder):
    return [os.path.join(d, f) for d, _, fs in os.walk(folder) for f in fs]


def test_a_closed_staging_leaves_nothing(spark):
    from hourglass.plans.earned import ev_report
    from hourglass.plans.profile import resource_profile
    from hourglass.sources.staging import Staging

    src = R.standins.build(spark, SF)
    key = lambda r: tuple(str(x) for x in r)
    with Staging(spark) as staging:
        folder = staging.folder.removeprefix("file:")
        got = ev_report(src, R.EV_PARAMS, sort=False, staging=staging).collect()
        resource_profile(src, R.PROFILE_PARAMS, staging=staging).collect()
        assert _files(folder)
    assert not os.path.exists(folder)
    assert sorted(got, key=key) == sorted(ev_report(src, R.EV_PARAMS, sort=False).collect(), key=key)


def test_a_staging_is_emptied_when_a_query_fails(spark):
    from hourglass.sources.staging import Staging

    with pytest.raises(Exception, match="stop here"):
        with Staging(spark) as staging:
            folder = staging.folder.removeprefix("file:")
            staging.store(spark.range(10), "whole")
            assert _files(folder)
            staging.store(spark.range(10).select(F.when(F.col("id") == 9, F.raise_error(F.lit("stop here"))).otherwise(F.col("id"))), "half")
    assert not os.path.exists(folder)
    with pytest.raises(ValueError, match="closed"):
        staging.store(spark.range(1), "late")


def _activity_scans(plan):
    return len(re.findall(r"Scan parquet[^\n]*activity_l2|Location: [^\n]*hourglass-standins/[^\n]*activity_l2", plan))


@pytest.mark.parametrize("params, scans", [(R.EV_PARAMS, 1), (R.LIVE_PARAMS, 2)])
def test_a_report_reads_the_activities_once(spark, params, scans):
    """Whatever runs for a report, plan building included: the views of the L2 activities are
    read by the pass that tags them and by nothing else."""
    from hourglass.plans.earned import ev_report
    from hourglass.sources.catalog import ProjectSources
    from hourglass.sources.staging import Staging

    src = R.standins.build(spark, SF)
    stored = []

    class Watched(Staging):
        def store(self, df, name, partition_by=None):
            stored.append(_plan(df))
            return super().store(df, name, partition_by)

    with Watched(spark) as staging:
        report = ev_report(src, params, staging=staging)
        assert sum(map(_activity_scans, stored)) == scans
        assert _activity_scans(_plan(report)) == 0
        report.collect()


@pytest.mark.parametrize("key, facts", [
    ("ev_project_report", ("time_phase_weekly", "time_phase_baseline_weekly", "weekly_burden", "actual_hour", "fin_transaction", "timesheet")),
    ("ev_project_report_live", ("time_phase_daily", "time_phase_weekly", "time_phase_baseline", "weekly_burden",
                                "actual_hour", "fin_transaction", "timesheet")),
])
def test_report_reads_each_fact_once(spark, key, facts):
    """Executed (final adaptive) plan of each report branch, which no job precedes but the pass
    over the activities and reads of dimensions: one scan of each time-phase fact and of each
    actual-hour feed; of the actual-hour feed a second one, of its project column alone."""
    import collections
    import contextlib
    import io
    import re

    df = R.QUERIES[key](spark, SF)
    df.collect()
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    text = buf.getvalue()
    names = {}
    for block in text.split("\n\n"):
        m = re.match(r"\((\d+)\) Scan parquet", block.strip())
        if m:
            loc = re.search(r"/([a-z0-9_]+)\]", block)
            names[m.group(1)] = loc.group(1) if loc else "?"
    final = text.split("== Initial Plan ==")[0]
    scans = collections.Counter(names.get(m.group(1)) for m in re.finditer(r"Scan parquet\s+\((\d+)\)", final))
    for fact in facts:
        assert scans[fact] == (2 if fact == "actual_hour" else 1), (fact, dict(scans))
    narrow = [b for b in text.split("\n\n") if "/actual_hour]" in b and re.search(r"ReadSchema: struct<Project:string>", b)]
    assert narrow
