"""Ordinals, running totals and as-of lookups over one global order, spread over tasks.

A window without partitions puts all rows into one task; `operators.windows` and `asof_max`
do so, and are for calendar-sized frames. Here rows are sorted into ranges of the order, one
per task, and stored in that form; a range is worked on by itself, and what the ranges
before it add (a count, a total, a largest value) is one number per range. These numbers are
all that passes through the driver, as many as there are ranges.

The ranges are stored because two readings of one range partitioning need not cut alike, and
so that a lost executor costs a task and not the sort. `staging` owns them; without one they
last until the application ends.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourglass.sources.staging import Staging

RANGE = "_range"


def in_ranges(df: DataFrame, order: Sequence[Column], staging: Staging | None, ranges: int | None = None) -> DataFrame:
    """`df` with `_range`: rows of a lower range are before those of a higher one in `order`.
    Rows equal in `order` share a range."""
    spark = df.sparkSession
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    staging = staging or Staging.of_application(spark)
    return staging.store(df.repartitionByRange(ranges, *order).withColumn(RANGE, F.spark_partition_id()), "ranges")


def _before(ranged: DataFrame, summary: Column, combine: Callable, start) -> DataFrame:
    """(`_at`, `_before`): of every range, what the ranges before it combine to."""
    found = sorted(tuple(r) for r in ranged.groupBy(RANGE).agg(summary.alias("s")).collect())
    kind = ranged.agg(summary.alias("_before")).schema["_before"].dataType.simpleString()
    sums = accumulate([start, *(s for _, s in found)], lambda a, b: b if a is None else a if b is None else combine(a, b))
    rows = [(k, s) for (k, _), s in zip(found, sums)]
    return ranged.sparkSession.createDataFrame(rows, f"_at int, _before {kind}")


def _carried(ranged: DataFrame, before: DataFrame) -> DataFrame:
    # one row per range on the right side
    return ranged.join(F.broadcast(before), F.col(RANGE) == F.col("_at"))


def ordinal_by_ranges(df: DataFrame, order: Sequence[str], name: str = "rn", staging: Staging | None = None,
                      ranges: int | None = None) -> DataFrame:
    """`ROW_NUMBER() OVER (ORDER BY order)`. NULLs come first. Rows that are equal in `order`
    are numbered in any order, and share a task: give enough columns to tell rows apart."""
    by = [F.col(c).asc_nulls_first() for c in order]
    ranged = in_ranges(df, by, staging, ranges)
    place = F.row_number().over(Window.partitionBy(RANGE).orderBy(*by))
    return _carried(ranged, _before(ranged, F.count(F.lit(1)), int.__add__, 0)).select(
        *df.columns, (F.col("_before") + place).alias(name))


def running_total_by_ranges(df: DataFrame, order: Sequence[str], value: str, name: str, staging: Staging | None = None,
                            ranges: int | None = None) -> DataFrame:
    """`SUM(ISNULL(value, 0)) OVER (ORDER BY order ROWS UNBOUNDED PRECEDING)`: in each range the
    sum so far, on top of the totals of the ranges before."""
    by = [F.col(c).asc_nulls_first() for c in order]
    filled = df.withColumn("_value", F.coalesce(F.col(value), F.lit(0).cast(df.schema[value].dataType)))
    ranged = in_ranges(filled, by, staging, ranges)
    so_far = F.sum("_value").over(Window.partitionBy(RANGE).orderBy(*by).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    kind = ranged.agg(F.sum("_value").alias("s")).schema["s"].dataType
    none = F.lit(0).cast(kind)
    return _carried(ranged, _before(ranged, F.sum("_value"), lambda a, b: a + b, None)).select(
        *df.columns, (F.coalesce(F.col("_before"), none) + so_far).cast(kind).alias(name))


def asof_max_by_ranges(probes: DataFrame, probe_col: str, ref: DataFrame, ref_key: str, value: str, out: str,
                       staging: Staging | None = None, ranges: int | None = None) -> DataFrame:
    """For each probe row: `MAX(value) FROM ref WHERE ref_key <= probe` (NULL if none), for
    facts on both sides.

    Both sides are first reduced to distinct keys on the map side (a reference key to its
    largest value), so that a key with a third of all rows is one row here. The keys are
    merged in ranges, the largest value so far is carried over their borders, and the answers
    are joined to the probe rows. No (probe, reference) pairs are made. Keys are compared as
    timestamps; a NULL probe gets NULL, a NULL reference key is never met."""
    refs = ref.where(F.col(ref_key).isNotNull()).groupBy(F.col(ref_key).cast("timestamp").alias("_k")).agg(F.max(value).alias("_v"))
    keys = probes.where(F.col(probe_col).isNotNull()).select(F.col(probe_col).cast("timestamp").alias("_k")).distinct()
    merged = refs.select("_k", "_v", F.lit(False).alias("_asked")).unionByName(
        keys.select("_k", F.lit(None).cast(refs.schema["_v"].dataType).alias("_v"), F.lit(True).alias("_asked")))
    ranged = in_ranges(merged, [F.col("_k").asc()], staging, ranges)
    largest = F.max("_v").over(Window.partitionBy(RANGE).orderBy("_k").rangeBetween(Window.unboundedPreceding, Window.currentRow))
    answers = _carried(ranged, _before(ranged, F.max("_v"), max, None)).withColumn(
        "_best", F.greatest(F.col("_before"), largest)).where("_asked").select(F.col("_k").alias("_key"), F.col("_best").alias(out))
    return probes.join(answers, F.col(probe_col).cast("timestamp") == F.col("_key"), "left").select(*probes.columns, out)
