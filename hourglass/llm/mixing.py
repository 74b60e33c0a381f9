"""Mixing sources to target weights by cube-method balanced sampling.

Each source gets a target share of all words by its weight. A source whose target is f
times its size takes floor(f) whole copies of each document, and one more of a sample in
which every document has the inclusion probability f - floor(f). The cube method draws
that sample: it moves the vector of probabilities along directions that keep two totals,
words and documents, until all but two probabilities of a block are 0 or 1. Blocks of
bounded size run in parallel; the two left over from each meet in the blocks of the next
level, until one block of each source is left, whose last two are rounded (landing).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from hourglass.llm.common import SPACED_WORD, counted_copies, each_copy, stored

WEIGHTS = (1, 2, 3)
#: no document and no source is taken more often than this
MOST = 3
#: rows of a block; a block is what one call of the flight holds in memory
BLOCK_ROWS = 4_000
SEED = 7


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.0, most: int = MOST) -> DataFrame:
    """Per source: source_size, n_docs, target. `sizes` has source and size.

    Sources in code point order, null last, take the weights in turn. A target is cut at
    `most` times its source's size and the excess goes to the others by weight; that ends
    in target = min(cap, level * weight) with one level, found by walking the sources in
    the order of cap / weight. The windows hold one row per source.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    turn = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.row_number().over(turn) - 1, F.lit(len(weights))) + 1).cast("int"))
    per = per.withColumn("weight", weight.cast("double")).withColumn("cap", F.lit(float(most)) * F.col("source_size"))
    everything, filling = Window.partitionBy(), Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    left = F.lit(share) * F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    rest = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    per = per.withColumn("level", left / rest)
    place = F.row_number().over(filling)
    first_open = F.min(F.when(F.col("cap") > F.col("level") * F.col("weight"), F.struct("place", "level"))).over(everything)
    per = per.withColumn("place", place).withColumn("open", first_open)
    target = F.when(F.col("place") >= F.col("open.place"), F.col("open.level") * F.col("weight")).otherwise(F.col("cap"))
    return per.select("source", "source_size", "n_docs", target.alias("target"))


def flight(size: np.ndarray, x: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Moves the inclusion probabilities `x` until at most two lie strictly between 0 and 1.

    Three open units at a time: (b-c, c-a, a-b) for sizes a, b, c changes neither the
    number of words nor of documents; with equal sizes any exchange of two does. The step
    to either end is drawn so that each probability keeps its mean.
    """
    x = x.astype(float).copy()
    open_, coins = [], rng.random(len(x))
    for i in np.flatnonzero((x > 0) & (x < 1)):
        open_.append(i)
        if len(open_) < 3:
            continue
        s, p = size[open_].astype(float), x[open_]
        u = np.array([s[1] - s[2], s[2] - s[0], s[0] - s[1]])
        if not u.any():
            u = np.array([1.0, -1.0, 0.0])
        u /= np.abs(u).max()
        moving = u != 0
        up = np.where(u > 0, 1 - p, p)[moving] / np.abs(u[moving])
        down = np.where(u > 0, p, 1 - p)[moving] / np.abs(u[moving])
        forward, back = up.min(), down.min()
        if coins[i] * (forward + back) < back:
            step, at = forward, np.flatnonzero(moving)[up.argmin()]
            p, end = p + step * u, u[at] > 0
        else:
            step, at = back, np.flatnonzero(moving)[down.argmin()]
            p, end = p - step * u, u[at] < 0
        p = np.where(p < 1e-9, 0.0, np.where(p > 1 - 1e-9, 1.0, p))
        p[at] = 1.0 if end else 0.0
        x[open_] = p
        open_ = [k for k in open_ if 0 < x[k] < 1]
    return x


def landing(size: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Rounds the at most two open units so that words, then documents, change least."""
    x = x.copy()
    open_ = np.flatnonzero((x > 0) & (x < 1))
    ends = [np.array([(k >> j) & 1 for j in range(len(open_))], float) for k in range(1 << len(open_))]
    cost = [(abs(((e - x[open_]) * size[open_]).sum()), abs((e - x[open_]).sum())) for e in ends]
    x[open_] = ends[min(range(len(ends)), key=lambda k: cost[k])]
    return x


def _dealt(rows: DataFrame, level: int, block_rows: int) -> DataFrame:
    """Adds the source's number of blocks and the row's block; copies of a row go to blocks in turn."""
    per = rows.groupBy("source").agg(F.count("*").alias("_rows")).select(F.col("source").alias("_source"), (
        F.ceil(F.col("_rows") / F.lit(block_rows))).cast("int").alias("blocks"))
    first = F.pmod(F.xxhash64("doc_id", "text_hash", F.lit(level)), F.col("blocks"))
    return rows.join(per, F.col("source").eqNullSafe(F.col("_source"))).drop("_source").withColumn(
        "block", F.pmod(first + F.col("copy"), F.col("blocks")))


def _level(rows: DataFrame, level: int, block_rows: int, seed: int) -> DataFrame:
    """One flight over all blocks; sources that have one block land. Adds x and `landed`."""
    dealt = _dealt(rows, level, block_rows)

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["size", "doc_id", "text_hash", "copy"], ascending=[False, True, True, True], ignore_index=True)
        size = group["size"].to_numpy()
        rng = np.random.default_rng([seed, level, int(group["block"].iloc[0])])
        x = flight(size, group["x"].to_numpy(), rng)
        last = bool(group["blocks"].iloc[0] == 1)
        return group.assign(x=landing(size, x) if last else x, landed=last)[[*names, "landed"]]

    names = rows.columns
    out = StructType([*(StructField(f.name, f.dataType) for f in rows.schema), StructField("landed", BooleanType())])
    return dealt.groupBy("source", "block").applyInPandas(run, out)


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.0, most: int = MOST,
        block_rows: int = BLOCK_ROWS, seed: int = SEED) -> DataFrame:
    """One row per document row: doc_id, size, source_size, target, taken, source, copies,
    text_hash. `taken` is size times copies; reruns on the same rows give the same.

    Null and empty texts have size 0 and may be taken or not, at no words. A null source
    is a source, a null id an id like any other. Repeated rows are separate rows; which of
    rows equal in all of id, text and source is taken cannot be told apart. A source whose
    words are 0 has target 0 and no copies. An empty table gives no rows.
    """
    sized = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                        F.coalesce(F.regexp_count("text", F.lit(SPACED_WORD)), F.lit(0)).cast("long").alias("size"),
                        F.xxhash64("text").alias("text_hash"))
    sized = stored(sized, "mix-sizes")
    t = targets(sized, weights, share, most).select(F.col("source").alias("_source"), "source_size", "target")
    factor = F.coalesce(F.try_divide(F.col("target"), F.col("source_size").cast("double")), F.lit(0.0))
    whole = F.floor(factor + 1e-12)
    single = each_copy(counted_copies(sized), sized.columns, "copy")
    rows = single.join(t, F.col("source").eqNullSafe(F.col("_source"))).drop("_source").select(
        "doc_id", "source", "size", "text_hash", "copy", "source_size", "target",
        whole.cast("long").alias("whole"), F.greatest(factor - whole, F.lit(0.0)).alias("x"))
    done, level = [], 0
    while True:  # a level leaves two rows of each block: three levels for 10^12 rows
        flown = stored(_level(rows, level, block_rows, seed), f"mix-level{level}")
        open_ = ~F.col("landed") & (F.col("x") > 0) & (F.col("x") < 1)
        done.append(flown.filter(~open_).drop("landed"))
        rows, level = flown.filter(open_).drop("landed"), level + 1
        if rows.isEmpty():
            break
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    out = out.withColumn("copies", F.col("whole") + F.round("x").cast("long"))
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"),
                      "source", "copies", "text_hash")


#: parts that rows equal in id, text and source are numbered in
PARTS = 4_096
SAME = ["doc_id", "_hash", "source"]


def _meet(left: DataFrame, right: DataFrame, columns: list[str]) -> DataFrame:
    """`left` with the rows of `right` that are equal in `columns`, nulls included."""
    other = right.select(*[F.col(c).alias(f"_r{c}") if c in columns else F.col(c) for c in right.columns])
    on = [F.col(c).eqNullSafe(F.col(f"_r{c}")) for c in columns]
    return left.join(other, on).drop(*[f"_r{c}" for c in columns])


def _places(rows: DataFrame) -> DataFrame:
    """Adds `_place`: rows equal in SAME numbered from 1, in the order of their `_row_hash`.

    Counts run ahead of the numbers: by part of the hashes, within a part by hash and stored
    partition; only rows of one hash and partition, which are alike, are numbered together.
    """
    parts = rows.withColumn("_part", F.pmod("_row_hash", F.lit(PARTS)))
    runs = parts.groupBy(*SAME, "_part", "_row_hash", "_stored_in").agg(F.count("*").alias("_n"))

    def before(count: str, group: list[str], order: list[str]) -> Column:
        ahead = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum(count).over(ahead), F.lit(0))

    by_part = runs.groupBy(*SAME, "_part").agg(F.sum("_n").alias("_m"))
    by_part = by_part.select(*SAME, "_part", before("_m", SAME, ["_part"]).alias("_before_part"))
    in_part = runs.withColumn("_before_run", before("_n", [*SAME, "_part"], ["_row_hash", "_stored_in"]))
    starts = _meet(in_part, by_part, [*SAME, "_part"]).select(
        *SAME, "_row_hash", "_stored_in", (F.col("_before_part") + F.col("_before_run")).alias("_start"))
    run = [*SAME, "_row_hash", "_stored_in"]
    own = F.row_number().over(Window.partitionBy(*run).orderBy("_row_hash"))
    return _meet(rows.withColumn("_own", own), starts, run).withColumn("_place", F.col("_start") + F.col("_own")).drop("_own", "_start")


def mixed_documents(docs: DataFrame, **parameters) -> DataFrame:
    """The mixed corpus: every document row as often as the mix takes it, all columns.

    Rows equal in id, text and source share the copies taken of them as evenly as can be, the
    first in the order of a hash of their columns one more; nulls there are values like any other.
    An empty table gives no rows.
    """
    taken = mix(docs, **parameters).groupBy("doc_id", F.col("text_hash").alias("_hash"), "source").agg(
        F.sum("copies").alias("_all"), F.count("*").alias("_rows")).filter("_all > 0")
    taken = stored(taken, "mix-taken")
    hashable = [f.name for f in docs.schema.fields if "map<" not in f.dataType.simpleString()]
    # rows travel as one struct, so that no column of theirs can clash with one made here
    hashed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                         F.xxhash64("text").alias("_hash"), F.xxhash64(*hashable).alias("_row_hash"), F.struct(*docs.columns).alias("row"))
    alone = _meet(hashed, taken.filter("_rows = 1"), SAME).select("row", F.col("_all").alias("_own"))
    shared = _meet(hashed, taken.filter("_rows > 1"), SAME).withColumn("_stored_in", F.spark_partition_id())
    shared = _places(stored(shared, "mix-shared"))
    own = F.call_function("div", F.col("_all"), F.col("_rows")) + (F.col("_place") <= F.pmod("_all", "_rows")).cast("long")
    out = alone.unionByName(shared.select("row", own.alias("_own"))).filter("_own > 0")
    return out.withColumn("_copy", F.explode_outer(F.sequence(F.lit(1).cast("long"), F.col("_own")))).select("row.*")
