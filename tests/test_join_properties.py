"""Property tests: the custom join operators against brute-force SQL on random inputs."""

import datetime as dt
import os

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from sorted_rows import rows
from hourglass.operators import asof_max, null_aware_anti_join, range_join_days

N = int(os.environ.get("HOURGLASS_PROPERTY_EXAMPLES", "25"))
SETTINGS = dict(max_examples=N, deadline=None, suppress_health_check=list(HealthCheck))
key = st.one_of(st.none(), st.integers(min_value=0, max_value=5))
day = st.dates(min_value=dt.date(2017, 1, 1), max_value=dt.date(2017, 1, 31))


@settings(**SETTINGS)
@given(left=st.lists(key, max_size=12), right=st.lists(key, max_size=8))
def test_null_aware_anti_join_equals_not_in(spark, left, right):
    l_df = spark.createDataFrame([(i, k) for i, k in enumerate(left)], "id int, x int")
    r_df = spark.createDataFrame([(k,) for k in right], "y int")
    got = null_aware_anti_join(l_df, "x", r_df, "y")
    l_df.createOrReplaceTempView("l_prop")
    r_df.createOrReplaceTempView("r_prop")
    want = spark.sql("SELECT id, x FROM l_prop WHERE x NOT IN (SELECT y FROM r_prop)")
    assert rows(got, "id", "x") == rows(want, "id", "x")


@settings(**SETTINGS)
@given(facts=st.lists(st.one_of(st.none(), day), max_size=12), starts=st.lists(day, max_size=6, unique=True),
       half_open=st.booleans())
def test_range_join_equals_between(spark, facts, starts, half_open):
    f_df = spark.createDataFrame([(i, d) for i, d in enumerate(facts)], "id int, d date")
    w_df = spark.createDataFrame([(f"W{i}", s) for i, s in enumerate(starts)], "wk string, s date")
    got = range_join_days(f_df, "d", w_df, "s", 7, how="left", half_open=half_open)
    f_df.createOrReplaceTempView("f_prop")
    w_df.createOrReplaceTempView("w_prop")
    upper = "d < date_add(s, 7)" if half_open else "d <= date_add(s, 7)"
    want = spark.sql(f"SELECT f.id, f.d, w.wk FROM f_prop f LEFT JOIN w_prop w ON f.d >= w.s AND {upper}")
    assert rows(got, "id", "d", "wk") == rows(want, "id", "d", "wk")


@settings(**SETTINGS)
@given(probes=st.lists(st.one_of(st.none(), day), max_size=10),
       ref=st.lists(st.tuples(st.one_of(st.none(), day), st.text(alphabet="ABW0123", min_size=1, max_size=3)), max_size=8))
def test_asof_max_equals_correlated_max(spark, probes, ref):
    p_df = spark.createDataFrame([(i, d) for i, d in enumerate(probes)], "id int, d date")
    r_df = spark.createDataFrame(ref, "s date, wk string")
    got = asof_max(p_df, "d", r_df, "s", "wk", "w")
    p_df.createOrReplaceTempView("p_prop")
    r_df.createOrReplaceTempView("ref_prop")
    want = spark.sql("SELECT p.id, p.d, (SELECT max(r.wk) FROM ref_prop r WHERE r.s <= p.d) AS w FROM p_prop p")
    assert rows(got, "id", "d", "w") == rows(want, "id", "d", "w")


@settings(**SETTINGS)
@given(data=st.lists(st.tuples(st.sampled_from(["P", "Q"]), st.one_of(st.none(), st.sampled_from(["a", "b", "c"])),
                               st.one_of(st.none(), st.sampled_from(["w1", "w2", "w3", "1999WW01", "1999WW02", "1999WW53", "2000WW01", "1999WW60",
                                                                      "1999", "1999WW", "=1999", ""])),
                               st.one_of(st.none(), st.integers(min_value=-5, max_value=9))), min_size=1, max_size=20))
def test_two_level_ratio_equals_two_group_bys(spark, data):
    from pyspark.sql import functions as F

    from hourglass.operators import two_level_ratio

    df = spark.createDataFrame(data, "p string, act string, wk string, h int").withColumn("h", F.col("h").cast("decimal(19,6)"))
    got = two_level_ratio(df, ["p", "act"], ["p"], "h", "wk", {"act": "dummy"}).select(
        "p", "act", F.col("ratio").cast("decimal(38,6)").alias("ratio"))
    groups = {g for p, act, _, _ in data for g in ((p, act), (p,))}
    members = {g: [(wk, h) for p, act, wk, h in data if (p, act)[: len(g)] == g] for g in groups}
    if any(all(wk is None for wk, _ in m) and any(h is not None for _, h in m) for m in members.values()):
        with pytest.raises(Exception, match="division by zero"):  # hours without any week
            got.collect()
        return
    df.createOrReplaceTempView("r_prop")
    want = spark.sql("""
        SELECT p, act, CAST(try_divide(sum(h), count(DISTINCT wk)) AS DECIMAL(38,6)) AS ratio FROM r_prop GROUP BY p, act
        UNION ALL
        SELECT p, 'dummy', CAST(try_divide(sum(h), count(DISTINCT wk)) AS DECIMAL(38,6)) FROM r_prop GROUP BY p""")
    assert rows(got, "p", "act", "ratio") == rows(want, "p", "act", "ratio")


@settings(**SETTINGS)
@given(data=st.lists(st.tuples(st.sampled_from([dt.date(2017, 6, 2), dt.date(2017, 5, 26), dt.date(2017, 5, 19), None]),
                               key, st.one_of(st.none(), st.integers(min_value=0, max_value=100)),
                               st.one_of(st.none(), st.integers(min_value=0, max_value=50))), max_size=14),
       no_last=st.booleans())
def test_earned_value_rows_equal_three_join_form(spark, data, no_last):
    from pyspark.sql import functions as F

    from hourglass.plans.earned import earned_value_rows

    cur, last = dt.date(2017, 6, 2), (None if no_last else dt.date(2017, 5, 26))
    wp = spark.createDataFrame(
        [(d, k, f"A{k}", "n", "P", "5", pct, units) for d, k, pct, units in data],
        "Snapshot_Date date, Activity_Key int, Activity_ID string, Activity_Name string, BR_ProjectNumber string, "
        "BR_PIEPCCC string, BR_Percent_Complete int, budget int").withColumn(
        "BR_Percent_Complete", F.col("BR_Percent_Complete").cast("decimal(19,6)")).withColumn(
        "budget", F.col("budget").cast("decimal(19,6)"))
    got = earned_value_rows(wp, cur, last).select(
        "Snapshot_Date", "Activity_ID", F.col("Earned_LTD").cast("double").alias("e"),
        F.col("Earned_Last_LTD").cast("double").alias("el"))
    wp.createOrReplaceTempView("wp_prop")
    spark.createDataFrame([(cur, last)], "cur date, prev date").createOrReplaceTempView("map_prop")
    want = spark.sql("""
        SELECT coalesce(c.Snapshot_Date, back.cur) AS Snapshot_Date, coalesce(c.Activity_ID, q.Activity_ID) AS Activity_ID,
               CAST(coalesce(c.budget, 0) * coalesce(c.BR_Percent_Complete, 0) / 100 AS DOUBLE) AS e,
               CAST(coalesce(q.budget, 0) * coalesce(q.BR_Percent_Complete, 0) / 100 AS DOUBLE) AS el
        FROM wp_prop c
        LEFT JOIN map_prop fwd ON fwd.cur = c.Snapshot_Date
        FULL OUTER JOIN wp_prop q ON q.Snapshot_Date = fwd.prev AND c.Activity_Key = q.Activity_Key
        LEFT JOIN map_prop back ON q.Snapshot_Date = back.prev
        WHERE coalesce(c.Snapshot_Date, back.cur) IS NOT NULL""")
    assert rows(got, "Snapshot_Date", "Activity_ID", "e", "el") == rows(want, "Snapshot_Date", "Activity_ID", "e", "el")


@settings(**SETTINGS)
@given(target=st.lists(st.tuples(key, st.integers(min_value=0, max_value=3)), max_size=10),
       source=st.lists(st.tuples(key, st.one_of(st.none(), st.integers(min_value=10, max_value=20))), max_size=8))
def test_update_from_join_equals_python_model(spark, target, source):
    from hourglass.operators import update_from_join

    t = spark.createDataFrame([(i, k, v) for i, (k, v) in enumerate(target)], "id int, k int, v int")
    s = spark.createDataFrame(source, "k int, v int")
    got = update_from_join(t, s, "k", "v")
    # UPDATE t SET v = s.v FROM t JOIN s ON t.k = s.k: matched rows take a source value (the smallest, which is
    # ours; T-SQL leaves the choice open); NULL keys never match; unmatched rows keep theirs
    by_key = {}
    for k, v in source:
        if k is not None:
            by_key.setdefault(k, []).append(v)
    def pick(vals):
        non_null = [x for x in vals if x is not None]
        return min(non_null) if non_null else None
    want = [(i, k, pick(by_key[k]) if k is not None and k in by_key else v) for i, (k, v) in enumerate(target)]
    assert rows(got, "id", "k", "v") == sorted(want, key=lambda r: tuple((x is None, str(x)) for x in r))


@settings(**SETTINGS)
@given(data=st.lists(st.tuples(st.one_of(st.none(), st.text(alphabet="ab", max_size=2)), key), min_size=1, max_size=10))
def test_template_row_equals_order_by_limit(spark, data):
    from hourglass.operators import template_row

    df = spark.createDataFrame(data, "s string, n int")
    df.createOrReplaceTempView("tr_prop")
    want = spark.sql("SELECT * FROM tr_prop ORDER BY s ASC NULLS FIRST, n ASC NULLS FIRST LIMIT 1").collect()
    assert template_row(df).collect() == want
