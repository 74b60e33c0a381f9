"""Property test: top-1 per group (aggregate with encoded order keys) equals
ROW_NUMBER() = 1 for arbitrary strings, numbers, dates and NULLs in mixed directions."""

import datetime as dt
import os

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from sorted_rows import rows
from hourglass.operators import top1_per_group

text = st.one_of(st.none(), st.text(alphabet=st.sampled_from(list("aAzé€𝄞 -0~")), max_size=4))
num = st.one_of(st.none(), st.integers(min_value=-3, max_value=3))
day = st.one_of(st.none(), st.dates(min_value=dt.date(1999, 12, 30), max_value=dt.date(2000, 1, 2)))
row = st.tuples(st.integers(min_value=0, max_value=2), text, num, day, text)


@settings(max_examples=int(os.environ.get("HOURGLASS_PROPERTY_EXAMPLES", "25")), deadline=None, suppress_health_check=list(HealthCheck))
@given(data=st.lists(row, min_size=1, max_size=30), dirs=st.tuples(st.booleans(), st.booleans(), st.booleans()))
def test_top1_equals_row_number(spark, data, dirs):
    data = [(k, s, n, d, t, i) for i, (k, s, n, d, t) in enumerate(data)]
    df = spark.createDataFrame(data, "k int, s string, n int, d date, t string, id int")
    order = [("s", dirs[0]), ("n", dirs[1]), ("d", dirs[2]), ("id", False)]
    got = top1_per_group(df, ["k"], order)

    def spec(c, desc):
        return F.col(c).desc_nulls_last() if desc else F.col(c).asc_nulls_first()

    w = Window.partitionBy("k").orderBy(*[spec(c, d) for c, d in order])
    want = df.withColumn("rn", F.row_number().over(w)).where("rn = 1").drop("rn")
    assert rows(got, *df.columns) == rows(want, *df.columns)
