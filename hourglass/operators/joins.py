"""Join shapes the reports need beyond plain equi-joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def range_join_days(
    left: DataFrame,
    left_date: str,
    right: DataFrame,
    start_col: str,
    span_days: int,
    how: str = "left",
    half_open: bool = False,
) -> DataFrame:
    """`left.d BETWEEN right.start AND right.start + span_days` as an equi-join.

    Each right row (a calendar interval) is exploded into the days it covers, then joined
    on the date. The explosion multiplies the right side by `span_days + 1`, never the
    fact side, and the join is an ordinary hash/sort-merge join: no nested loop, no
    cartesian product. `half_open=True` drops the closing day, so a date that starts the
    next interval matches once instead of twice.
    """
    stop = span_days - 1 if half_open else span_days
    day = "_rj_day"
    exploded = right.withColumn(
        day, F.explode(F.sequence(F.to_date(F.col(start_col)), F.date_add(F.to_date(F.col(start_col)), stop)))
    )
    joined = left.join(exploded, F.to_date(F.col(left_date)) == F.col(day), how)
    return joined.drop(day)


def pre_aggregated_join(fact: DataFrame, dim: DataFrame, on, pre_keys, pre_cols, how: str = "inner", dealt_by=None) -> DataFrame:
    """Sum a fact to its join and group grain (`pre_sum`), then join it to a dimension-like
    side: whatever the side's size, the join moves one row per key instead of one per fact
    row. Spark picks the join's physical form. The caller sums the sums.

    Where the summed fact stays nearly as long as the fact, give its side of the join keys as `dealt_by`:
    it is then dealt by them over all shuffle partitions, and these are not merged into a few by their
    compressed size. A join by the same keys and a sum by them follow in the same tasks, each with a sort or a
    table of its own, so that a task's memory is several times its rows. The dimension's rows of such a partition
    are hashed, and the fact's are not sorted."""
    from hourglass.operators.aggregates import pre_sum

    summed = pre_sum(fact, pre_keys, pre_cols)
    if dealt_by is not None:
        summed = summed.repartition(int(fact.sparkSession.conf.get("spark.sql.shuffle.partitions")), *dealt_by)
        dim = dim.hint("shuffle_hash")
    return summed.join(dim, on, how)


def join_to_few(rows: DataFrame, few: DataFrame, on, dealt_by=(), how: str = "inner") -> DataFrame:
    """A join of many rows with a side that holds few keys (a choice per project, say), by `on`; inner or left.

    Shuffled by such a key, the rows would lie in as many partitions as there are keys, however many they are.
    Spark can't tell beforehand that an aggregate is small, so the few are broadcast by name: one row per key, while
    the rows stay in the tasks they are in and are not shuffled. `dealt_by` is what callers dealt the rows by
    when the few were repeated per shuffle partition; nothing is dealt now."""
    return rows.join(F.broadcast(few), on, how)


def asof_max(probes: DataFrame, probe_col: str, ref: DataFrame, ref_key: str, value: str, out: str) -> DataFrame:
    """For each probe row: `MAX(value) FROM ref WHERE ref_key <= probe` (NULL if none).

    Probes and reference rows are put in one date-ordered stream (reference rows first on
    ties, as the test is `<=`) and a running max is carried along it: linear in the two
    inputs, no (probe, reference) pairs. Keys are compared as timestamps: a reference key with a
    time of day only qualifies from that time on. The stream is ordered globally, so both sides must
    be calendar-sized (snapshot dates, work weeks) — the only use in the reports.
    """
    from pyspark.sql import Window

    # a NULL key never satisfies `key <= probe`
    r = ref.where(F.col(ref_key).isNotNull()).select(
        F.col(ref_key).cast("timestamp").alias("_k"), F.lit(0).alias("_probe"), F.col(value).alias("_v"),
        *[F.lit(None).cast(probes.schema[c].dataType).alias(c) for c in probes.columns])
    p = probes.select(F.col(probe_col).cast("timestamp").alias("_k"), F.lit(1).alias("_probe"),
                      F.lit(None).cast(ref.schema[value].dataType).alias("_v"), *probes.columns)
    w = Window.orderBy(F.col("_k").asc_nulls_first(), "_probe").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    stream = r.unionByName(p).withColumn("_m", F.max("_v").over(w))
    return (stream.where(F.col("_probe") == 1)
            .select(*probes.columns, F.when(F.col("_k").isNotNull(), F.col("_m")).alias(out)))
