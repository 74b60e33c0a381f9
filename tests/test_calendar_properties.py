"""Property tests: calendar operators against their literal CASE forms in Spark SQL."""

import datetime as dt
import os

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sorted_rows import rows
from hourglass.plans.calendar import clamp_year_month, period_rollup_table

SETTINGS = dict(max_examples=int(os.environ.get("HOURGLASS_PROPERTY_EXAMPLES", "25")), deadline=None,
                suppress_health_check=list(HealthCheck))
names = st.one_of(st.none(), st.builds(lambda m, y: f"{m} {y}", st.sampled_from(
    ["January", "March", "June", "September", "December", "Marc", "Junebug"]), st.integers(min_value=2015, max_value=2019)))
types = st.one_of(st.none(), st.sampled_from(["Monthly", "Weekly", "Daily"]))


@settings(**SETTINGS)
@given(data=st.lists(st.tuples(names, types, st.integers(min_value=0, max_value=1)), max_size=10))
def test_period_rollup_equals_case_form(spark, data):
    sp = spark.createDataFrame([(n, dt.date(2017, 1, 1 + i), t, f) for i, (n, t, f) in enumerate(data)],
                               "SnapshotPeriod string, SnapshotDate date, PeriodType string, ActivityIsProcessed int")
    sp.createOrReplaceTempView("sp_prop")
    q = ("CASE WHEN SnapshotPeriod LIKE 'March%' THEN right(SnapshotPeriod,4) || 'Q1' "
         "WHEN SnapshotPeriod LIKE 'June%' THEN right(SnapshotPeriod,4) || 'Q2' "
         "WHEN SnapshotPeriod LIKE 'September%' THEN right(SnapshotPeriod,4) || 'Q3' "
         "WHEN SnapshotPeriod LIKE 'December%' THEN right(SnapshotPeriod,4) || 'Q4' END")
    y = "CASE WHEN SnapshotPeriod LIKE 'December%' THEN right(SnapshotPeriod,4) END"
    want = spark.sql(f"""
        SELECT SnapshotPeriod, SnapshotDate, PeriodType, ActivityIsProcessed FROM sp_prop
        UNION ALL SELECT {q}, SnapshotDate, 'Quarter', ActivityIsProcessed FROM sp_prop WHERE PeriodType = 'Monthly' AND {q} IS NOT NULL
        UNION ALL SELECT {y}, SnapshotDate, 'Year', ActivityIsProcessed FROM sp_prop WHERE PeriodType = 'Monthly' AND {y} IS NOT NULL""")
    cols = ("SnapshotPeriod", "SnapshotDate", "PeriodType", "ActivityIsProcessed")
    assert rows(period_rollup_table(sp), *cols) == rows(want, *cols)


@settings(**SETTINGS)
@given(fms=st.lists(st.one_of(st.none(), st.builds(lambda y, m: f"{y}{m:02d}", st.integers(min_value=2010, max_value=2030),
                                                   st.integers(min_value=1, max_value=12))), max_size=10),
       mode=st.sampled_from(["0", "1", "2", "3", "4", "5", "7"]),
       lo=st.one_of(st.none(), st.sampled_from(["2014", "2016", "2020"])), hi=st.one_of(st.none(), st.sampled_from(["2018", "2024"])))
def test_clamp_equals_case_form(spark, fms, mode, lo, hi):
    df = spark.createDataFrame([(i, f) for i, f in enumerate(fms)], "id int, fm string")
    y, m = clamp_year_month(F.col("fm"), mode, lo, hi)
    got = df.select("id", y.alias("Year"), m.alias("Month"))
    lo_s, hi_s = (f"'{lo}'" if lo else "CAST(NULL AS STRING)"), (f"'{hi}'" if hi else "CAST(NULL AS STRING)")
    base = {"1": "2015", "2": "2018", "3": "2020", "4": "2022"}
    yr, mo = [], []
    for md, b in base.items():
        yr.append(f"WHEN '{mode}' = '{md}' AND left(fm,4) < '{b}' THEN '{b}'")
        mo.append(f"WHEN '{mode}' = '{md}' AND left(fm,4) < '{b}' THEN '01'")
    yr += [f"WHEN '{mode}' IN ('0','5') AND left(fm,4) < {lo_s} THEN {lo_s}", f"WHEN '{mode}' IN ('0','5') AND left(fm,4) > {hi_s} THEN {hi_s}"]
    mo += [f"WHEN '{mode}' IN ('0','5') AND left(fm,4) < {lo_s} THEN '01'", f"WHEN '{mode}' IN ('0','5') AND left(fm,4) > {hi_s} THEN '01'"]
    df.createOrReplaceTempView("fm_prop")
    want = spark.sql(f"SELECT id, CASE {' '.join(yr)} ELSE left(fm,4) END AS Year, "
                     f"CASE {' '.join(mo)} ELSE right(fm,2) END AS Month FROM fm_prop")
    assert rows(got, "id", "Year", "Month") == rows(want, "id", "Year", "Month")
