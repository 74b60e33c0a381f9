"""What the project report and its source views do with a row, where the tables are large."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from hourglass.operators import conditional_sums, pre_aggregated_join
from hourglass.params import ReportParams, ResolvedPeriods
from hourglass.plans.earned import project_report
from hourglass.plans.ledger import LEDGER_SCHEMA, Branch
from hourglass.sources import standins
from hourglass.sources.catalog import ProjectSources
from sorted_rows import rows

SF = "/root/testdata/sf0.001"
D = dt.date


@pytest.mark.parametrize("seed", range(3))
def test_measures_of_folded_rows_are_the_conditional_sums(spark, seed):
    rng = random.Random(seed)
    df = spark.createDataFrame(
        [(rng.choice(["a", "b", None]), rng.choice(["x", "y", None]), rng.randrange(6) or None,
          rng.choice([None, Decimal(rng.randrange(-50, 50))]), rng.choice([None, Decimal(rng.randrange(50))])) for _ in range(200)],
        "k string, t string, w int, h decimal(19,6), l decimal(19,6)")
    t, w = F.col("t"), F.col("w")
    wanted = [("all", F.lit(True), "h"), ("none", F.lit(False), "h"), ("x", t == "x", "h"), ("early", w <= 2, "h"), ("x_late", (t == "x") & (w > 2), "l")]
    wanted += [(f"m{k}", w == k % 6, "hl"[k % 2]) for k in range(58)]
    plain = df.groupBy("k").agg(*[F.sum(F.when(c, F.col(v)).otherwise(F.lit(0))).cast("decimal(38,6)").alias(n) for n, c, v in wanted])
    got = conditional_sums(df, ["k"], wanted)
    assert got.dtypes == plain.dtypes and rows(got) == rows(plain)
    with pytest.raises(ValueError, match="63"):
        conditional_sums(df, ["k"], [*wanted, ("more", t == "y", "h")])


def test_a_value_that_is_null_in_all_its_rows_stays_null(spark):
    df = spark.createDataFrame([("a", "x", None), ("b", "x", None), ("b", "y", None)], "k string, t string, h decimal(19,6)")
    got = conditional_sums(df, ["k"], [("x", F.col("t") == "x", "h")])
    assert rows(got) == [("a", None), ("b", Decimal(0))]


def _report(spark):
    s = ProjectSources()
    s.project_master_ext = spark.createDataFrame(
        [("P1", "B", "PG", "T", "V", None, None, 1)],
        "ProjectNumber string, BundleTitleLong string, ProgramWBS string, ProjectTitleLong string, VendorDescription string, "
        "ProjectAttribute_STRATUM_III string, ProjectAttribute_STRATUM_IV string, IsCurrent int")
    s.activity_l2_weekly = spark.createDataFrame(
        [(D(2017, 6, 2), f"A{k}", "P1", D(2017, 9, 1 + j)) for k in range(40) for j in range(1 + k % 2)],
        "Snapshot_Date date, Activity_ID string, BR_ProjectNumber string, Finish date")
    led = spark.createDataFrame([("P1", f"A{k % 50}", "n", "5", f"2017WW{20 + k % 4}", Decimal(k), None, "Planned") for k in range(600)], LEDGER_SCHEMA)
    per = ResolvedPeriods(D(2017, 6, 2), D(2017, 5, 26), None, "2017WW22", "2017WW21", None)
    return led, project_report(led, Branch(s, ReportParams(), per, live=False))


def test_the_ledger_is_summed_before_it_meets_finish_dates_and_sorted_rows_are_stored(spark):
    """No ledger row is sorted or hashed for a join, and the sums under the final sort, which reads its
    input once for its ranges and once for its rows, come from a shuffle that is written once."""
    own = spark.newSession()
    own.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    own.conf.set("spark.sql.adaptive.enabled", "false")
    led, out = _report(own)
    plan = out._jdf.queryExecution().executedPlan().toString()
    lines = [line.lstrip(" :+-*()0123456789") for line in plan.splitlines()]
    ranges = next(k for k, line in enumerate(lines) if line.startswith("Exchange rangepartitioning"))
    assert lines[ranges + 1].startswith("Exchange hashpartitioning(Activity_ID")
    finish = next(line for line in lines if "f_id" in line and "Join" in line)
    assert finish.startswith("ShuffledHashJoin") and "LeftOuter, BuildRight" in finish
    joins = [k for k, line in enumerate(lines) if "Join" in line.split("[")[0].split(" ")[0]]
    dealt = next(k for k, line in enumerate(lines) if line.startswith("Exchange hashpartitioning(Activity_ID") and "REPARTITION_BY_NUM" in line)
    between = lines[joins[-1] + 1:dealt]
    assert any(line.startswith("HashAggregate") and "LC_PV" not in line for line in between) and max(joins) < dealt
    want = {f"A{a}": (1 + a % 2 if a < 40 else 1) * sum(k for k in range(600) if k % 50 == a) for a in range(50)}
    assert {r["Activity_ID"]: int(r["LC_PV"]) for r in out.collect()} == want


def test_activities_are_hashed_where_the_feeds_are_dealt(spark):
    fact = spark.createDataFrame([("a", 1, 2.0), ("a", 1, 3.0), (None, 2, 5.0)], "k string, d int, h double")
    dim = spark.createDataFrame([("a", "A"), ("a", "B"), ("c", "C")], "key string, name string")
    for how, more in (("inner", []), ("left", [(None, 2, 5.0, None, None)])):
        j = pre_aggregated_join(fact, dim, fact.k == dim.key, ["k", "d"], ["h"], how=how, dealt_by=["k"])
        plan = j._jdf.queryExecution().executedPlan().toString()
        assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan
        assert sorted(map(tuple, j.collect()), key=str) == sorted([("a", 1, 5.0, "a", "A"), ("a", 1, 5.0, "a", "B"), *more], key=str)


def test_views_that_others_decide_on_come_from_one_derivation(spark, tmp_path, monkeypatch):
    """The lines are joined to their orders once for the snapshots, which tell the branch, and for its views."""
    monkeypatch.setattr("hourglass.session.shared_folder", lambda _: str(tmp_path))
    made, derive = [], standins.derive
    monkeypatch.setattr(standins, "derive", lambda *a: made.append(a) or derive(*a))

    def then(src):
        assert src.snapshot_period.count() and src.timesheet is None
        return ["time_phase_daily", "activity_l2_daily", "timesheet"]

    src = standins.build(spark, SF, views=["snapshot_period"], then=then)
    assert len(made) == 1 and not any(df.is_cached for df in made[0][2])
    plain = derive(spark, SF)
    for name in ("snapshot_period", "time_phase_daily", "activity_l2_daily", "timesheet"):
        got, want = getattr(src, name), getattr(plain, name)
        assert got.schema.names == want.schema.names and got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    assert src.time_phase_weekly is None
    standins.build(spark, SF, views=["snapshot_period"], then=then)
    assert len(made) == 1
    with pytest.raises(ValueError, match="no source views"):
        standins.build(spark, SF, views=["snapshot_period"], then=lambda _: ["time_phase"])


def test_activities_are_staged_as_keys_and_daily_views_start_from_the_latest_rows(spark):
    staged = []
    derived = standins.derive(spark, SF, staged, {"activity_l2_daily", "activity_l2_weekly", "activity_l3_daily", "time_phase_daily"})
    try:
        assert ["Activity_Key", "Snapshot_Date"] in [df.columns for df in staged]
        for view in (derived.activity_l2_weekly, derived.activity_l3_daily, derived.activity_l2_daily):
            assert "SortMergeJoin" not in view._jdf.queryExecution().executedPlan().toString().split("InMemoryRelation")[0]
        plan = derived.time_phase_daily._jdf.queryExecution().executedPlan().toString().split("InMemoryRelation")[0]
        scan = next(line for line in plan.splitlines() if "InMemoryTableScan" in line)
        assert "Join" not in plan and "Snapshot_Date" in scan.split("], [")[-1] and " = 2" in scan  # its batches are pruned by the date
        assert not derived.time_phase_daily.exceptAll(standins.derive(spark, SF).time_phase_daily).count()
    finally:
        for df in staged:
            df.unpersist()


def test_choices_per_project_sort_no_aggregate(spark):
    """The first source and the baseline of a project are read off an aggregate by hash, and its exchange runs once."""
    from hourglass.operators import first_source_rows
    from hourglass.plans.ledger import planned_and_budget

    led = spark.createDataFrame([("a", 2, "x", 1.0), ("a", 1, "x", 2.0), ("a", 1, "y", None), ("b", 2, "x", 4.0), (None, 2, "z", 5.0)],
                                "k string, s int, v string, h double").withColumn("s", F.coalesce("s", F.lit(0))).groupBy("k", "s", "v").agg(F.sum("h").alias("h"))
    first = first_source_rows(led, "k", "s", "h")
    assert rows(first) == rows(led.where("NOT (k <=> 'a' AND s = 2)"))
    params = ReportParams(period_type="Weekly", period=D(2000, 1, 1), baseline_type="Approved")
    src = standins.build(spark, SF, views=["activity_l2_weekly", "time_phase_baseline_weekly"])
    planned = planned_and_budget(Branch(src, params, ResolvedPeriods(D(2000, 1, 1), None, None, None, None, None), live=False))[0]
    for df in (first, planned):
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        assert "ReusedExchange" in plan
        lines = [line.lstrip(" :+-*()0123456789") for line in plan.splitlines()]
        partial = [k for k, line in enumerate(lines) if line.startswith("SortAggregate(") and "functions=[partial_m" in line]
        assert partial
        for k in partial:  # what is sorted is one row per project and source, or type
            assert lines[k + 1].startswith("Sort [") and lines[k + 2].startswith("HashAggregate(keys=[")
            assert lines[k + 2].split("keys=[")[1].split("]")[0].count(",") == 1
    own = spark.newSession()
    own.conf.set("spark.sql.adaptive.enabled", "false")
    own.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    led = own.createDataFrame([("p", 1, n, n) for n in range(40)], "k string, s int, a int, h int").groupBy("k", "s", "a").agg(F.sum("h").alias("h"))
    plan = first_source_rows(led, "k", "s", "h")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan  # the rows are not shuffled to meet the choices
