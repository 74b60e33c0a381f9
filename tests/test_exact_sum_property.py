"""Property test: sums by `sum_of`, and of sums by `pre_sum`, are exact over all of decimal(19,6)."""

import os
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from hourglass.operators import conditional_sums, pre_sum, sum_of

amount = st.one_of(st.none(), st.decimals(min_value=Decimal("-9999999999999.999999"), max_value=Decimal("9999999999999.999999"),
                                          places=6, allow_nan=False, allow_infinity=False))
row = st.tuples(st.integers(min_value=0, max_value=3), st.integers(min_value=0, max_value=2), st.booleans(), amount)


@settings(max_examples=int(os.environ.get("HOURGLASS_PROPERTY_EXAMPLES", "25")), deadline=None,
          suppress_health_check=list(HealthCheck))
@given(data=st.lists(row, min_size=1, max_size=40))
def test_exact_sums_equal_decimal_sums(spark, data):
    df = spark.createDataFrame(data, "g int, k int, flag boolean, h decimal(19,6)")
    cond = F.col("flag")
    got = df.groupBy("g").agg(sum_of(df, "h").alias("a"), sum_of(df, "h", cond).alias("b"))
    want = df.groupBy("g").agg(F.sum("h").cast("decimal(38,6)").alias("a"),
                               F.sum(F.when(cond, F.col("h"))).cast("decimal(38,6)").alias("b"))
    assert sorted(got.collect()) == sorted(want.collect())
    # two-phase form: pre-sum by (g, k), then the final sum by g
    pre = pre_sum(df, ["g", "k"], ["h"])
    two = pre.groupBy("g").agg(sum_of(pre, "h").alias("a"))
    assert sorted(two.collect()) == sorted(want.select("g", "a").collect())


def test_sums_beyond_a_long(spark):
    big = Decimal("9999999999999.500000")
    df = spark.createDataFrame([(1, big), (2, Decimal("5e12")), (2, Decimal("5e12"))], "k int, h decimal(19,6)")
    out = conditional_sums(df, ["k"], [("s", F.lit(True), "h")])
    assert {r["k"]: r["s"] for r in out.collect()} == {1: big, 2: Decimal("1e13")}
