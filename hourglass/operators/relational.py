"""Relational operators: top-1 per group, null-aware anti join, update-from-join,
positional ledger append, deterministic template row, set union.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

def top1_per_group(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[tuple[str, bool]],
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """`ROW_NUMBER() OVER (PARTITION BY keys ORDER BY order) = 1`.

    `order` is a list of (column, descending); NULL is lowest. Ties on the order keys are
    broken by the remaining columns (T-SQL leaves them arbitrary). Spark limits each group
    to its best row on the map side already (WindowGroupLimit, partial), so a hot key costs
    one row per map task in the shuffle.
    """
    keep = list(keep) if keep is not None else [c for c in df.columns if c not in keys]
    by = [F.col(c).desc_nulls_last() if d else F.col(c).asc_nulls_first() for c, d in order]
    used = {c for c, _ in order}
    ties = [F.col(c).asc_nulls_first() for c in keep if c not in used]
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*by, *ties))
    return df.withColumn("_rn", place).where("_rn = 1").select(*keys, *keep)


def null_aware_anti_join(left: DataFrame, left_col: str, right: DataFrame, right_col: str) -> DataFrame:
    """`left.left_col NOT IN (SELECT right_col FROM right)` with SQL three-valued logic.

    * right empty: every left row is kept, NULL keys included;
    * a NULL among the right values: no row is kept;
    * otherwise: rows whose key is non-NULL and unmatched.

    One aggregate reduces the right side to its distinct values. An ordinary anti join, which
    AQE may broadcast or shuffle, and a scalar subquery that tells whether the list is empty
    and whether it has a NULL both read that aggregate. The join compares null-safely, so that
    no filter is pushed into one of the two reads, and Spark runs their exchange once. Nothing
    runs before the caller's action, and no side is collected or broadcast by hand (Spark's
    own null-aware join is a broadcast of the whole right side)."""
    vals = right.select(F.col(right_col).alias("_nav")).distinct()
    summary = vals.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("_nav").isNull()).alias("nulls"))
    empty = summary.select(F.col("n") == 0).scalar()
    no_null = summary.select(F.col("nulls") == 0).scalar()
    key = F.col(left_col)
    unmatched = left.join(vals, key.eqNullSafe(F.col("_nav")), "left_anti")
    return unmatched.where(empty | (no_null & key.isNotNull()))


def keys_in_no_list(keys: DataFrame, key: str, lists: Sequence[tuple[DataFrame, str]]) -> DataFrame:
    """`key NOT IN (list 1) AND key NOT IN (list 2) ...` for a frame of keys: its rows that pass,
    as the one column `key`, repeated as often as they came.

    All keys and list values go through one aggregate, each with a tag of the side it comes
    from, reduced on the map side: a value says which sides hold it and how many key rows do.
    A NULL in a list lets nothing pass (the flags are one row, from the same aggregate, whose
    exchange is run once); a NULL key passes only if every list is empty. Each side is read
    once and nothing runs before the caller's action."""
    tagged = keys.select(F.col(key).alias("_key"), F.lit(0).alias("_side"))
    for k, (df, col) in enumerate(lists, 1):
        tagged = tagged.unionByName(df.select(F.col(col).alias("_key"), F.lit(1 << (k - 1)).alias("_side")))
    sides = tagged.groupBy("_key").agg(F.bit_or("_side").alias("_in"), F.count_if(F.col("_side") == 0).alias("_n"), F.max("_key").alias("_value"))
    # both reads of the aggregate have one shape: the flags read all of its columns, and the
    # key goes out as an aggregate, through which no later join's null filter is pushed
    whole = F.struct("_in", "_n", "_value")
    flags = sides.agg(F.max(whole).alias("_most"), F.max(F.when(F.col("_key").isNull(), whole)).alias("_of_null")).select(
        F.coalesce(F.col("_most._in"), F.lit(0)).alias("_any"), F.coalesce(F.col("_of_null._in"), F.lit(0)).alias("_null"))
    passes = (F.col("_any") == 0) | ((F.col("_null") == 0) & F.col("_value").isNotNull())
    out = sides.crossJoin(F.broadcast(flags)).where((F.col("_in") == 0) & (F.col("_n") > 0) & passes)
    return out.select(F.col("_value").alias(key), F.explode(F.array_repeat(F.lit(0), F.col("_n").cast("int"))).alias("_copy")).select(key)


def first_source_rows(rows: DataFrame, key: str, source: str, value: str) -> DataFrame:
    """Rows whose `source` is the smallest one present for their `key`: the priority of
    several feeds (`... AND key NOT IN (SELECT key FROM better feed)`), for any number of them.

    `rows` must be an aggregate. The smallest source comes from the same aggregate, `value`
    included, so that both reads of it have one shape and its exchange is run once; rows are counted by
    key and source first, with buffers that a hash table holds, where the least struct per key would
    sort them all. Keys are compared null-safely: a NULL key is a key of its own. Rows of one key stay dealt as
    the aggregate has dealt them (`join_to_few`)."""
    from hourglass.operators.joins import join_to_few

    present = rows.groupBy(F.col(key).alias("_key"), F.col(source).alias("_source")).agg(F.count(value).alias("_n"))
    best = present.groupBy("_key").agg(F.min(F.struct("_source", "_n")).alias("_best"))
    met = join_to_few(rows, best, F.col(key).eqNullSafe(F.col("_key")))
    return met.where(F.col(source) == F.col("_best._source")).drop("_key", "_best")


def update_from_join(target: DataFrame, source: DataFrame, key: str, set_col: str, source_col: str | None = None) -> DataFrame:
    """`UPDATE t SET t.set_col = s.source_col FROM t INNER JOIN s ON t.key = s.key`.

    Unmatched rows keep their value. Several source rows per key: T-SQL takes any one; we
    take the smallest, so the result is deterministic.
    """
    source_col = source_col or set_col
    src = source.groupBy(key).agg(F.min(source_col).alias("_upd"), F.lit(True).alias("_hit"))
    cols = [F.when(F.col("_hit"), F.col("_upd")).otherwise(F.col(set_col)).alias(set_col) if c == set_col else F.col(c)
            for c in target.columns]
    return target.join(src, key, "left").select(*cols)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast a SELECT list onto a declared table schema **by position** (INSERT semantics)."""
    if len(df.columns) != len(schema.fields):
        raise ValueError(f"insert has {len(df.columns)} columns, table has {len(schema.fields)}")
    return df.select(*[F.col(c).cast(f.dataType).alias(f.name) for c, f in zip(df.columns, schema.fields)])


def append_typed(frames: Sequence[DataFrame], schema: T.StructType) -> DataFrame:
    """Successive INSERTs into one declared table: conform each, then bag union."""
    conformed = [conform(f, schema) for f in frames]
    if not conformed:
        raise ValueError("nothing to append")
    return reduce(lambda a, b: a.unionByName(b), conformed)


def template_row(df: DataFrame, order: Sequence[str] | None = None) -> DataFrame:
    """`SELECT TOP 1 ... FROM t` with no ORDER BY, made deterministic.

    Ordered by all columns; Spark plans `orderBy + limit` as a per-partition top-1 and a
    merge of one row per partition.
    """
    order = list(order) if order else df.columns
    return df.orderBy(*[F.col(c).asc_nulls_first() for c in order]).limit(1)


def union_distinct(a: DataFrame, b: DataFrame) -> DataFrame:
    """`UNION` (set semantics), by position like SQL."""
    return a.union(b).distinct()
