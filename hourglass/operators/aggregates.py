"""Aggregations: conditional-sum pivots, two-level ratios."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _total(df: DataFrame, name: str, c: Column) -> Column:
    """SUM as Spark computes it; a decimal's total in the widest type of its scale."""
    dt = df.schema[name].dataType
    return F.sum(c).cast(f"decimal(38,{dt.scale})") if isinstance(dt, T.DecimalType) else F.sum(c)


def sum_of(df: DataFrame, name: str, cond: Column | None = None) -> Column:
    """`SUM(name)`, or `SUM(CASE WHEN cond THEN name END)`."""
    return _total(df, name, F.col(name) if cond is None else F.when(cond, F.col(name)))


def pre_sum(df: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Early aggregation: SUM `cols` by `keys` before the frame is joined.

    Catalyst does not push aggregates below joins; summing a fact to the grain of its join
    and group keys first makes the join shuffle carry one row per key instead of one per
    fact row. SUM distributes over the later join (each pre-summed row meets the same
    partners its fact rows would have), so summing the sums gives the same totals."""
    return df.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in cols])


def conditional_sums(df: DataFrame, keys: Sequence[str], measures: Sequence[tuple[str, Column, str]]) -> DataFrame:
    """`SUM(CASE WHEN cond THEN value ELSE 0 END) AS name` for every measure, one pass.

    A row's conditions are evaluated once, as bits, and rows that agree in keys and bits are summed up
    first: a row costs one addition per value column, and only these few sums one per measure. A static
    wide pivot needs no pivot operator and no second scan per measure."""
    if len(measures) > 63:
        raise ValueError("more than 63 measures: their conditions are bits of a long")
    fed = reduce(Column.bitwiseOR, [F.when(cond, F.lit(1 << k).cast("long")).otherwise(F.lit(0).cast("long")) for k, (_, cond, _) in enumerate(measures)])
    values = list(dict.fromkeys(val for _, _, val in measures))
    folded = df.select(*keys, fed.alias("_fed"), *[F.col(v).alias(f"_sum_{v}") for v in values]).groupBy(*keys, "_fed").agg(
        *[_total(df, v, F.col(f"_sum_{v}")).alias(f"_sum_{v}") for v in values])
    return folded.groupBy(*keys).agg(*[
        _total(folded, f"_sum_{val}", F.when(F.col("_fed").bitwiseAND(F.lit(1 << k).cast("long")) != 0, F.col(f"_sum_{val}")).otherwise(F.lit(0))).alias(name)
        for k, (name, _, val) in enumerate(measures)])


def week_bits(code: str) -> tuple[Column, Column]:
    """(block, mask) of a `YYYYWWnn` code: its year and one bit of a long for its week, so that
    the distinct weeks of any rows are the OR of their masks by block, and their number the sum
    of the bits. Any other code is a block of its own with one bit; NULL has no block and no bit."""
    c = F.col(code)
    formed = c.rlike("^[0-9]{4}WW[0-5][0-9]$")
    one = F.lit(1).cast("long")
    block = F.when(formed, F.substring(c, 1, 4)).otherwise(F.concat(F.lit("="), c))
    mask = F.when(formed, F.call_function("shiftleft", one, F.right(c, F.lit(2)).cast("int"))).when(c.isNotNull(), one)
    return block, mask


def two_level_ratio(
    df: DataFrame,
    detail_keys: Sequence[str],
    total_keys: Sequence[str],
    value: str,
    distinct_of: str,
    label_cols: dict[str, str],
    out: str = "ratio",
) -> DataFrame:
    """`SUM(value) / COUNT(DISTINCT distinct_of)` at two grouping levels, unioned.

    Detail rows group by `detail_keys`; total rows by `total_keys`, a subset of them, and carry the
    literal labels of `label_cols` (column -> label) in the detail-only columns. Distinct codes
    are kept as bits (`week_bits`) that merge upward: the map side folds a fact to one row per
    (detail keys, year), both levels read that one aggregate (its exchange runs once), and no
    row is expanded into one per level or per code. `_gid` is the grouping id of the level, 0
    for detail. A sum over no distinct value at all raises, as a division by zero does; a NULL
    sum gives NULL.
    """
    block, mask = week_bits(distinct_of)
    rows = df.select(*detail_keys, F.col(value).alias("_v"), block.alias("_block"), mask.alias("_mask"))
    folded = rows.groupBy(*detail_keys, "_block").agg(F.sum("_v").alias("_v"), F.bit_or("_mask").alias("_mask"))
    coarse = folded.groupBy(*total_keys, "_block").agg(F.sum("_v").alias("_v"), F.bit_or("_mask").alias("_mask"))
    gid = sum(1 << k for k, c in enumerate(reversed(detail_keys)) if c not in total_keys)

    def level(by_block: DataFrame, keys: Sequence[str], gid: int) -> DataFrame:
        g = by_block.groupBy(*keys).agg(F.sum("_v").alias("_s"), F.sum(F.coalesce(F.bit_count("_mask"), F.lit(0))).alias("_n"))
        zero = (F.col("_n") == 0) & F.col("_s").isNotNull()
        ratio = F.when(zero, F.raise_error(F.lit(f"division by zero: no {distinct_of}"))).otherwise(F.try_divide(F.col("_s"), F.col("_n")))
        cols = [F.col(c) if c in keys else F.lit(label_cols.get(c)).cast(df.schema[c].dataType).alias(c) for c in detail_keys]
        return g.select(*cols, ratio.alias(out), F.lit(gid).cast("long").alias("_gid"))

    return level(folded, detail_keys, 0).unionByName(level(coarse, total_keys, gid))
