"""Exact top-k inner products by pivot-table elimination.

Distances of every vector to P pivots are computed once. For a query q and a candidate v
the triangle inequality gives |q-v| >= |d(q,p) - d(v,p)| for each pivot p, and with the largest of
these lower bounds the inner product is at most (|q|^2 + |v|^2 - bound^2) / 2. Candidates are
scored in the order of that bound until the k-th best score exceeds it: no later candidate
can enter. Bounds carry a margin for rounding; scores are integers and exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hourglass.llm.common import stored

K = 10
SCALE = 1024
QUERY_STEP = 100
PIVOTS = 24
#: vectors of a length that pivots are chosen from: those with the smallest hashes
PIVOT_SAMPLE = 1_000
#: vectors of a block of candidates, and queries of a block; one task holds a block of each
BLOCK, QUERY_BLOCK = 8_192, 1_024
#: candidates scored between two looks at the k-th best
STEP = 256


def quantized(vectors: DataFrame) -> DataFrame:
    """vec_id and `v` (floor(SCALE * x)) of every row that takes part."""
    x = F.transform("embedding", lambda e: e.cast("double"))
    whole = vectors.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).select(
        F.col("vec_id").cast("long").alias("vec_id"), x.alias("x"))
    bad = F.exists("x", lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    return whole.filter(~bad).select("vec_id", F.transform("x", lambda e: F.floor(e * SCALE).cast("long")).alias("v"))


def choose_pivots(sample: np.ndarray, count: int) -> np.ndarray:
    """Farthest-first: each pivot is the vector farthest from those before it."""
    if not len(sample):
        return sample
    far = np.full(len(sample), np.inf)
    out = [int((sample * sample).sum(1).argmax())]
    while len(out) < min(count, len(sample)):
        far = np.minimum(far, ((sample - sample[out[-1]]) ** 2).sum(1))
        if far.max() <= 0:
            break
        out.append(int(far.argmax()))
    return sample[out]


def _distances(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivots = shared.value
        for batch in batches:
            far = []
            for v in batch.column("v").to_pylist():
                p = pivots[len(v)]
                far.append(np.sqrt(((p - np.array(v, float)) ** 2).sum(1)).tobytes())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(far, pa.binary())], [*batch.schema.names, "far"])

    return run


def exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Rows of integers `a` times one vector `b`. Doubles are exact while no sum can pass
    2^53; beyond, Python's integers are used, and a score over 64 bits raises."""
    big = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * max(a.shape[1], 1)
    if big < 1 << 53:
        return (a.astype(float) @ b.astype(float)).astype(np.int64)
    return np.array([sum(int(x) * int(y) for x, y in zip(row, b, strict=True)) for row in a], np.int64)


def search(q_id: int, q: np.ndarray, q_far: np.ndarray, ids: np.ndarray, vectors: np.ndarray, far: np.ndarray,
           square: np.ndarray, k: int, step: int = STEP, own_row: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, int]:
    """Ids and scores of the best k of one block, ties to smaller ids, and how many
    candidates were scored. `own_row` marks the query's own row among them; where ids are
    unique, its id does."""
    mine = ids == q_id if own_row is None else own_row
    below = np.abs(far - q_far).max(1) if far.shape[1] else np.zeros(len(ids))
    own = float((q.astype(float) ** 2).sum())
    scale = own + square + 1.0
    bound = (own + square - np.maximum(below - 1e-9 * np.sqrt(scale), 0.0) ** 2) / 2 + 1e-9 * scale
    bound[mine] = -np.inf
    order = np.argsort(-bound, kind="stable")[: int((~mine).sum())]
    best_id, best, done = np.empty(0, np.int64), np.empty(0, np.int64), 0
    while done < len(order) and (len(best) < k or bound[order[done]] >= best[-1]):
        part = order[done : done + step]
        done += len(part)
        all_id, all_score = np.concatenate((best_id, ids[part])), np.concatenate((best, exact(vectors[part], q)))
        top = np.lexsort((all_id, -all_score))[:k]
        best_id, best = all_id[top], all_score[top]
    return best_id, best, done


def _block(k: int):
    def run(queries: pa.Table, candidates: pa.Table) -> pa.Table:
        out: list[tuple[int, int, int, int]] = []
        if queries.num_rows and candidates.num_rows:
            ids, numbers = candidates.column("vec_id").to_numpy(), candidates.column("row").to_numpy()
            vectors = np.array(candidates.column("v").to_pylist(), np.int64).reshape(len(ids), -1)
            far = np.array([np.frombuffer(x) for x in candidates.column("far").to_pylist()]).reshape(len(ids), -1)
            square = (vectors.astype(float) ** 2).sum(1)
            columns = [queries.column(c).to_pylist() for c in ("row", "vec_id", "v", "far")]
            for row, q_id, q, q_far in zip(*columns, strict=True):
                found, scores, _ = search(q_id, np.array(q, np.int64), np.frombuffer(q_far), ids, vectors, far, square, k, own_row=numbers == row)
                out += [(row, q_id, i, s) for i, s in zip(found.tolist(), scores.tolist(), strict=True)]
        return pa.table({c: pa.array([r[n] for r in out], pa.int64()) for n, c in enumerate(("row", "query_id", "vec_id", "score"))})

    return run


def top_k(vectors: DataFrame, k: int = K, step: int = QUERY_STEP, pivots: int = PIVOTS, block: int = BLOCK,
          query_block: int = QUERY_BLOCK) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: of every vector whose id is divisible by
    `step`, the k others with the highest integer inner products, ties to smaller ids.

    Vectors null or with null or non-finite components, and rows with a null id, take no
    part. Rows are told apart by their place, not by their id: each of the rows that share an id
    is a candidate, for the others too, and a query with its own k rows. Vectors of different
    lengths never meet; of empty vectors all products are 0. An empty table gives no rows.
    Other columns are not read.

    Each block of candidates meets each block of queries of the same length in one task,
    whose memory holds one of either; of a pair of blocks only k rows per query are kept.
    """
    spark = vectors.sparkSession
    # numbers of rows hold once they are stored; no result depends on which row has which
    base = stored(quantized(vectors).select("*", F.size("v").alias("dim"), F.monotonically_increasing_id().alias("row")), "topk-vectors")
    per_dim = {r["dim"]: (r["n"], r["q"]) for r in base.groupBy("dim").agg(
        F.count("*").alias("n"), F.count_if(F.col("vec_id") % step == 0).alias("q")).collect()}  # one row per vector length
    chosen = {}
    for dim in per_dim:
        rows = base.filter(F.col("dim") == dim).orderBy(F.xxhash64("vec_id", "v"), "vec_id").limit(PIVOT_SAMPLE).select("v").collect()
        chosen[dim] = choose_pivots(np.array([r["v"] for r in rows], float).reshape(len(rows), dim), pivots)
    shared = spark.sparkContext.broadcast(chosen)
    blocks = F.lit(1)
    query_blocks = F.lit(1)
    for dim, (n, q) in per_dim.items():
        blocks = F.when(F.col("dim") == dim, -(-n // block)).otherwise(blocks)
        query_blocks = F.when(F.col("dim") == dim, max(1, -(-q // query_block))).otherwise(query_blocks)
    table = base.mapInArrow(_distances(shared), "vec_id long, v array<long>, dim int, row long, far binary")
    table = stored(table.select("*", blocks.cast("int").alias("blocks"), query_blocks.cast("int").alias("query_blocks")), "topk-table")
    place = F.xxhash64("row")
    candidates = table.withColumn("c", F.pmod(place, F.col("blocks")).cast("int")).withColumn(
        "q", F.explode_outer(F.sequence(F.lit(0), F.col("query_blocks") - 1)))
    queries = table.filter(F.col("vec_id") % step == 0).withColumn("q", F.pmod(place, F.col("query_blocks")).cast("int")).withColumn(
        "c", F.explode_outer(F.sequence(F.lit(0), F.col("blocks") - 1)))
    columns = ["dim", "c", "q", "row", "vec_id", "v", "far"]
    found = queries.select(columns).groupBy("dim", "c", "q").cogroup(candidates.select(columns).groupBy("dim", "c", "q")).applyInArrow(
        _block(k), "row long, query_id long, vec_id long, score long")
    place_in = F.row_number().over(Window.partitionBy("row").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", place_in.cast("int")).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
