import datetime as dt
import random

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sorted_rows import rows
from hourglass.operators import (append_typed, conform, dynamic_pivot, null_aware_anti_join, range_join_days,
                                 running_total, template_row, top1_per_group, two_level_ratio, update_from_join)


def test_top1_matches_row_number_with_nulls_and_prefixes(spark):
    rnd = random.Random(7)
    vals = [None, "", "a", "ab", "abc", "b", "Y", "N", "é", "ée"]
    data = [(rnd.randint(0, 5), rnd.choice(vals), rnd.choice(vals), rnd.choice([None, 1, 2, 3]), i) for i in range(400)]
    df = spark.createDataFrame(data, "k int, s string, t string, n int, id int")
    order = [("s", True), ("n", True), ("t", False), ("id", False)]
    got = top1_per_group(df, ["k"], order)
    w = Window.partitionBy("k").orderBy(F.col("s").desc_nulls_last(), F.col("n").desc_nulls_last(),
                                        F.col("t").asc_nulls_first(), F.col("id").asc_nulls_first())
    want = df.withColumn("rn", F.row_number().over(w)).where("rn = 1").drop("rn")
    assert rows(got, *df.columns) == rows(want, *df.columns)


def test_null_aware_anti_join_three_valued(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "x int")
    no_null = spark.createDataFrame([(1,)], "y int")
    with_null = spark.createDataFrame([(1,), (None,)], "y int")
    empty = spark.createDataFrame([], "y int")
    assert rows(null_aware_anti_join(left, "x", no_null, "y")) == [(2,)]
    assert rows(null_aware_anti_join(left, "x", with_null, "y")) == []
    assert rows(null_aware_anti_join(left, "x", empty, "y")) == [(1,), (2,), (None,)]
    # same as Spark SQL's NOT IN
    left.createOrReplaceTempView("l_t")
    with_null.createOrReplaceTempView("r_t")
    assert spark.sql("SELECT x FROM l_t WHERE x NOT IN (SELECT y FROM r_t)").count() == 0


def test_update_from_join(spark):
    years = spark.createDataFrame([("2016", 0), ("2017", 0), ("2030", 0)], "Year string, rn int")
    axis = spark.createDataFrame([("2016", 1), ("2017", 2)], "Year string, rn int")
    assert rows(update_from_join(years, axis, "Year", "rn")) == [("2016", 1), ("2017", 2), ("2030", 0)]


def test_conform_is_positional_and_casts(spark):
    schema = T.StructType([T.StructField("A", T.StringType()), T.StructField("H", T.DecimalType(19, 6))])
    df = spark.createDataFrame([(1, 2.1234567)], "p int, q double")
    out = conform(df, schema)
    assert out.columns == ["A", "H"] and str(out.collect()[0]["H"]) == "2.123457"
    assert append_typed([df, df], schema).count() == 2


def test_range_join_closed_double_match_and_half_open(spark):
    weeks = spark.createDataFrame([("W1", dt.date(2017, 1, 2)), ("W2", dt.date(2017, 1, 9))], "WorkWeek string, WWStartDate date")
    facts = spark.createDataFrame([(dt.date(2017, 1, 9),), (dt.date(2017, 1, 5),), (dt.date(2016, 1, 1),)], "d date")
    closed = range_join_days(facts, "d", weeks, "WWStartDate", 7)
    assert rows(closed, "d", "WorkWeek") == [(dt.date(2016, 1, 1), None), (dt.date(2017, 1, 5), "W1"),
                                             (dt.date(2017, 1, 9), "W1"), (dt.date(2017, 1, 9), "W2")]
    half = range_join_days(facts, "d", weeks, "WWStartDate", 7, half_open=True)
    assert half.count() == 3


def test_two_level_ratio(spark):
    df = spark.createDataFrame([("P", "a", "w1", 10.0), ("P", "a", "w2", 20.0), ("P", "b", "w1", 6.0)],
                               "p string, act string, wk string, h double")
    out = two_level_ratio(df, ["p", "act"], ["p"], "h", "wk", {"act": "dummy"})
    got = {(r["p"], r["act"]): r["ratio"] for r in out.collect()}
    assert got == {("P", "a"): 15.0, ("P", "b"): 6.0, ("P", "dummy"): 18.0}


def test_running_total_and_template_row(spark):
    df = spark.createDataFrame([(1, 5), (2, None), (3, 7)], "id int, v int")
    assert [r["c"] for r in running_total(df, "id", "v", "c").orderBy("id").collect()] == [5, 5, 12]
    assert template_row(df).collect()[0]["id"] == 1


def test_dynamic_pivot_keeps_requested_columns(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "lbl string, v int")
    out = dynamic_pivot(df, [F.lit("X").alias("g")], "lbl", ["a", "b", "c"], F.max("v"))
    assert out.columns == ["g", "a", "b", "c"] and out.collect()[0]["c"] is None


def test_asof_max_ties_and_nulls(spark):
    from hourglass.operators import asof_max

    ref = spark.createDataFrame([(dt.date(2017, 1, 2), "W1"), (dt.date(2017, 1, 9), "W2"), (dt.date(2017, 1, 16), "W0")],
                                "s date, wk string")
    probes = spark.createDataFrame([(1, dt.date(2017, 1, 9)), (2, dt.date(2017, 1, 1)), (3, None), (4, dt.date(2017, 2, 1))],
                                   "id int, d date")
    got = rows(asof_max(probes, "d", ref, "s", "wk", "w"), "id", "w")
    # max code, not latest start: on 2017-02-01 the weeks W1, W2, W0 all qualify and 'W2' is the max
    assert got == [(1, "W2"), (2, None), (3, None), (4, "W2")]


def test_asof_compares_times_of_day(spark):
    from hourglass.operators import asof_max

    ref = spark.sql("SELECT * FROM VALUES (timestamp '2017-05-26 05:00', '2017WW21'), (timestamp '2017-06-02 05:00', '2017WW22') t(s, w)")
    probes = spark.sql("SELECT date '2017-06-02' AS d UNION ALL SELECT date '2017-06-03'")
    assert {str(r["d"]): r["o"] for r in asof_max(probes, "d", ref, "s", "w", "o").collect()} == {
        "2017-06-02": "2017WW21", "2017-06-03": "2017WW22"}


def test_top1_on_the_smallest_int(spark):
    from hourglass.operators import top1_per_group

    df = spark.createDataFrame([(1, -2147483648), (1, 5), (2, -2147483648), (2, None)], "k int, v int")
    out = top1_per_group(df, ["k"], [("v", True)])
    assert sorted(map(tuple, out.collect())) == [(1, 5), (2, -2147483648)]
    assert "WindowGroupLimit" in out._jdf.queryExecution().executedPlan().toString()


def test_ratio_raises_on_zero(spark):
    import pytest

    from hourglass.operators import two_level_ratio

    def ratio(value):
        df = spark.createDataFrame([("p", "a", value, None)], "p string, a string, h double, w string")
        return two_level_ratio(df, ["p", "a"], ["p"], "h", "w", {"a": "all"}).collect()

    with pytest.raises(Exception, match="division by zero"):
        ratio(1.0)
    assert {r["ratio"] for r in ratio(None)} == {None}


def test_axis_bounds_raise_on_two_rows(spark):
    import pytest

    from hourglass.plans.calendar import axis_bounds

    axis = spark.createDataFrame([("2014", 1), ("2015", 1)], "Year string, rn long")
    first, last = axis_bounds(axis)
    assert spark.range(1).select(last).collect()[0][0] is None
    with pytest.raises(Exception, match="SCALAR_SUBQUERY_TOO_MANY_ROWS"):
        spark.range(1).select(first).collect()


def test_two_level_ratio_expands_no_row_and_reads_once(spark):
    """Weeks are bits of one aggregate that both levels read: no Expand, one exchange of it."""
    df = spark.createDataFrame([("P", "a", f"{y}WW{w:02}", 1.0) for y in (1999, 2000) for w in range(60)] * 2, "p string, act string, wk string, h double")
    out = two_level_ratio(df, ["p", "act"], ["p"], "h", "wk", {"act": "dummy"})
    assert {(r["act"], r["ratio"], r["_gid"]) for r in out.collect()} == {("a", 2.0, 0), ("dummy", 2.0, 1)}
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "Expand" not in plan and "ReusedExchange" in plan
