import datetime as dt

from pyspark.sql import functions as F

from sorted_rows import rows
from hourglass.functions import (add_months, concat_null, lacks_suffix, lacks_suffix_like, left, max2, mdy, min2,
                                 number_text, right, work_week_code, fiscal_month_code, isnull)
from hourglass.operators import month_steps


def test_concat_propagates_null(spark):
    df = spark.createDataFrame([("a", "b"), ("a", None)], "x string, y string")
    out = rows(df.select(concat_null(F.col("x"), " - ", F.col("y")).alias("c")))
    assert out == [("a - b",), (None,)]


def test_suffix_rules_drop_null_and_C(spark):
    df = spark.createDataFrame([(None,), ("C",), ("12C",), ("12",), ("",)], "w string")
    out = df.select("w", lacks_suffix("w").alias("r"), lacks_suffix_like("w").alias("l")).collect()
    got = {r["w"]: (r["r"], r["l"]) for r in out}
    assert got[None] == (None, None)
    assert got["C"] == (False, False) and got["12C"] == (False, False)
    assert got["12"] == (True, True) and got[""] == (True, True)
    assert df.where(lacks_suffix("w")).count() == 2


def test_left_right_number_text(spark):
    df = spark.createDataFrame([("201707", 2017.6)], "fm string, n double")
    r = df.select(left("fm", 4).alias("y"), right("fm", 2).alias("m"), number_text("n").alias("t")).collect()[0]
    assert (r["y"], r["m"], r["t"]) == ("2017", "07", "2018")


def test_min2_max2_are_null_sensitive(spark):
    df = spark.createDataFrame([("201001", None), ("201001", "200901"), ("201001", "201101")], "a string, b string")
    out = df.select(min2("a", "b").alias("lo"), max2("a", "b").alias("hi")).collect()
    assert [(r["lo"], r["hi"]) for r in out] == [(None, None), ("200901", "201001"), ("201001", "201101")]


def test_period_codes(spark):
    df = spark.createDataFrame([(dt.date(2000, 1, 1),), (dt.date(2021, 1, 4),), (dt.date(2017, 6, 2),)], "d date")
    out = df.select(work_week_code("d").alias("w"), fiscal_month_code("d").alias("f"), mdy("d").alias("m")).collect()
    assert [(r["w"], r["f"], r["m"]) for r in out] == [
        ("1999WW52", "200001", "01/01/2000"), ("2021WW01", "202101", "01/04/2021"), ("2017WW22", "201706", "06/02/2017")]


def test_month_steps_drift_like_iterated_dateadd(spark):
    steps = month_steps(dt.date(2017, 1, 31), dt.date(2017, 4, 30))
    assert steps == [dt.date(2017, 1, 31), dt.date(2017, 2, 28), dt.date(2017, 3, 28), dt.date(2017, 4, 28)]
    assert month_steps(None, dt.date(2017, 1, 1)) == []
    df = spark.createDataFrame([(dt.date(2017, 1, 31),)], "d date")
    assert df.select(add_months("d", 1).alias("x")).collect()[0]["x"] == dt.date(2017, 2, 28)


def test_isnull_default(spark):
    df = spark.createDataFrame([(None,), ("Not Available",)], "n string")
    assert rows(df.groupBy("n").count(), "n") == [("Not Available",), (None,)]
    assert [r[0] for r in df.select(isnull("n", "Not Available")).collect()] == ["Not Available", "Not Available"]


def test_multi_value_parameters_accept_a_bare_string(spark):
    from hourglass.functions import first_char_in, in_list

    df = spark.createDataFrame([("73113", "5A"), ("7", "55"), ("99", "6")], "p string, w string")
    assert rows(df.where(in_list("p", "73113")), "p") == [("73113",)]
    assert rows(df.where(first_char_in("w", "5")), "w") == [("55",), ("5A",)]
