"""A query derives and stores the source views that it reads, and no others."""

import datetime as dt
import os
from dataclasses import fields

import pytest
from pyspark.sql import functions as F

import hourglass_queries as R
from hourglass.plans.earned import ARM_VIEWS
from hourglass.plans.profile import PROFILE_VIEWS
from hourglass.sources import standins
from hourglass.sources.catalog import ProjectSources

SF = "/root/testdata/sf0.001"


@pytest.fixture
def empty_folder(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("hourglass.session.shared_folder", lambda _: str(tmp_path))
    return tmp_path


def _written(folder):
    return {name for _, dirs, _ in os.walk(folder) for name in dirs if name in {f.name for f in fields(ProjectSources)}}


@pytest.mark.parametrize("key, views", [
    ("nth_year_bounds", {"time_phase_period"}),
    ("update_from_join", {"time_phase_period"}),
    ("minmax_period", set(PROFILE_VIEWS)),
    ("resource_hours_by_month_case_blind", set(PROFILE_VIEWS)),
    ("actuals_cascade", {"snapshot_period", "work_week", *ARM_VIEWS["actuals"][0]}),
])
def test_a_query_stores_the_views_it_reads(spark, empty_folder, key, views):
    rows = R.QUERIES[key](spark, SF).collect()
    assert rows and _written(empty_folder) == views


def test_views_asked_for_later_join_those_that_are_there(spark, empty_folder):
    first = standins.build(spark, SF, views=["time_phase_weekly"])
    assert first.timesheet is None and _written(empty_folder) == {"time_phase_weekly"}
    both = standins.build(spark, SF, views=["time_phase_weekly", "timesheet"])
    plain = standins.derive(spark, SF)
    for name in ("time_phase_weekly", "timesheet"):
        got, want = getattr(both, name), getattr(plain, name)
        assert got.schema.names == want.schema.names and got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    with pytest.raises(ValueError, match="no source views"):
        standins.build(spark, SF, views=["time_phase"])


def test_a_partitioned_view_is_written_without_sorting_it(spark, empty_folder, monkeypatch):
    """Tasks keep a file open per snapshot; the caller's session keeps its own settings."""
    plans, written = [], standins._writing_session

    def watched(session):
        own = written(session)
        plans.append(own)
        return own

    monkeypatch.setattr(standins, "_writing_session", watched)
    before = dict(spark.conf.getAll.items())
    standins.build(spark, SF, views=["time_phase_weekly"])
    assert dict(spark.conf.getAll.items()) == before
    own = plans[0]
    assert int(own.conf.get("spark.sql.maxConcurrentOutputFileWriters")) == standins.OPEN_FILES
    assert own.conf.get("spark.sql.session.timeZone") == spark.conf.get("spark.sql.session.timeZone")


def test_views_of_one_part_key_share_one_exchange_of_the_lines(spark):
    """Joins to the parts and distinct rows by part find the staged lines dealt by part."""
    staged = []
    derived = standins.derive(spark, SF, staged, {"time_phase_baseline_weekly", "timesheet", "activity_l2_weekly"})
    try:
        staged[0].count()  # the lines
        for df in (derived.timesheet, derived.time_phase_baseline_weekly):
            df.collect()
            plan = df.hint("merge")._jdf.queryExecution().executedPlan().toString()
            assert "hashpartitioning(l_partkey" not in plan.split("InMemoryRelation")[0]
        lines = staged[0]._jdf.queryExecution().optimizedPlan().toString()
        assert "l_partkey" in lines and "hashpartitioning(l_partkey" in lines
    finally:
        for df in staged:
            df.unpersist()


def test_summed_feeds_are_dealt_over_all_shuffle_partitions(spark):
    """The joins of the feeds to the activities, and the sums after them, are not merged into a few large tasks."""
    from hourglass.operators import pre_aggregated_join

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    fact = spark.createDataFrame([("a", 1, 2.0), ("a", 1, 3.0), ("b", 2, 4.0), (None, 2, 5.0)], "k string, d int, h double")
    dim = spark.createDataFrame([("a", "A"), ("c", "C")], "key string, name string")
    dealt = pre_aggregated_join(fact, dim.hint("merge"), fact.k == dim.key, ["k", "d"], ["h"], how="left", dealt_by=["k"])
    assert dealt.rdd.getNumPartitions() == n
    assert sorted(map(tuple, dealt.collect()), key=str) == sorted([("a", 1, 5.0, "a", "A"), ("b", 2, 4.0, None, None), (None, 2, 5.0, None, None)], key=str)


def test_views_are_written_in_the_order_the_lines_are_staged_in(spark):
    """The lines are sorted by snapshot once; a join to the parts keeps that order and sorts none of them again."""
    staged = []
    derived = standins.derive(spark, SF, staged, {"time_phase_weekly", "time_phase_baseline_weekly", "timesheet", "activity_l2_weekly", "activity_l3_weekly"})
    try:
        assert {"l_orderkey", "o_orderpriority"}.isdisjoint(staged[0].columns)
        for view in (derived.time_phase_weekly, derived.time_phase_baseline_weekly, derived.activity_l2_weekly):
            parts = [[r[0] for r in p] for p in view.select("Snapshot_Date").rdd.glom().collect()]
            assert any(len(set(p)) > 1 for p in parts) and all(p == sorted(p) for p in parts)
            assert "Sort [" not in view._jdf.queryExecution().executedPlan().toString().split("InMemoryRelation")[0]
        plain = standins.derive(spark, SF)
        for name in ("time_phase_baseline_weekly", "timesheet", "activity_l2_weekly"):
            got, want = getattr(derived, name), getattr(plain, name)
            assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    finally:
        for df in staged:
            df.unpersist()


def test_snapshot_periods_read_the_lines_once(spark):
    plan = standins.derive(spark, SF).snapshot_period._jdf.queryExecution().executedPlan().toString()
    assert plan.count("lineitem.parquet") == 1


def _dates(spark, ordered, shipped, to):
    """Order and ship dates, given in UTC seconds, as columns of the type `to`."""
    def table(name, seconds):
        return spark.createDataFrame([(s,) for s in seconds], "s long").select(F.timestamp_seconds("s").cast(to).alias(name))

    return {"orders": table("o_orderdate", ordered), "lineitem": table("l_shipdate", shipped)}


@pytest.mark.parametrize("to", ["timestamp_ntz", "date", "timestamp", "string"])
def test_the_calendar_runs_from_the_first_to_the_last_day(spark, to):
    """Of local times, the day is taken of the two bounds and not of every row."""
    day = 86400
    cal = standins.calendar(_dates(spark, [None, 2 * day - 1, 4 * day], [3 * day, None, 5 * day - 1, -1], to))
    assert sorted(r.Date for r in cal.select("Date").collect()) == [dt.date(1970, 1, d) for d in (2, 3, 4, 5)]
    plan = cal._jdf.queryExecution().optimizedPlan().toString()
    assert ("cast(min(o_orderdate" in plan and "cast(max(l_shipdate" in plan) == (to == "timestamp_ntz")
    assert standins.calendar(_dates(spark, [None], [day], to)).isEmpty()


def test_the_calendar_ends_on_the_last_day_where_clocks_go_back_over_midnight(spark):
    """Of two instants, the later one can have the earlier day."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    last = int(dt.datetime(2000, 10, 29, 2, 30, 30, tzinfo=dt.timezone.utc).timestamp())
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/St_Johns")
        cal = standins.calendar(_dates(spark, [last - 86400], [last, last + 600], "timestamp"))
        assert sorted(r.Date for r in cal.select("Date").collect()) == [dt.date(2000, 10, 28), dt.date(2000, 10, 29)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
