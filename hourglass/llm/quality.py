"""Quality classifier: hashed word n-gram logistic regression, trained by FTRL-proximal.

Features of a text are its words, runs of marks, and pairs of neighbours, hashed into
2^BITS places; a text's value at a place is the share of its n-grams there, scaled to unit
length. A score is the logistic function of one sparse dot product.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourglass.llm.common import sliced

BITS = 18
#: labelled documents the model is trained from, at most: those with the smallest hashes
TRAIN_ROWS = 6_000
#: FTRL-proximal parameters and passes over the training rows
ALPHA, BETA, L1, L2, PASSES = 2.0, 1.0, 1e-4, 1e-4, 2
THRESHOLD = 0.7
SEED = 11

_CODE = np.random.default_rng(3).integers(0, 2**64, 256, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
#: kinds of bytes: 0 white space, 1 letters, digits and all beyond ASCII, 2 marks
_KIND = np.full(256, 2, np.int8)
_KIND[[9, 10, 11, 12, 13, 32]] = 0
for _low, _high in ((48, 57), (65, 90), (97, 122), (128, 255)):
    _KIND[_low : _high + 1] = 1
_SAME = np.uint64(0xD6E8FEB86659FD93)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def features(text: str | None, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Places and values of a text, from one pass over its bytes; empty for no text.

    The second word of a pair that repeats the first is hashed as "the same word", so that
    repetition is one feature whatever the word.
    """
    data = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
    if not len(data):
        return np.empty(0, np.int64), np.empty(0)
    kind = _KIND[data]
    cut = np.flatnonzero(np.diff(kind) != 0) + 1
    start, end = np.concatenate(([0], cut)), np.concatenate((cut, [len(data)]))
    token = kind[start] != 0
    start, end = start[token], end[token]
    if not len(start):
        return np.empty(0, np.int64), np.empty(0)
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_CODE[data] * _powers(_BASE, len(data)), dtype=np.uint64)))
    word = _mixed((total[end] - total[start]) * _powers(_BASE_INVERSE, len(data))[start] + (end - start).astype(np.uint64))
    next_ = np.where(word[1:] == word[:-1], _SAME, word[1:])
    first = np.where(word[1:] == word[:-1], _SAME, word[:-1])
    pair = _mixed(first * np.uint64(0x9E3779B97F4A7C15) + next_)
    place = (np.concatenate((word, pair)) >> np.uint64(64 - bits)).astype(np.int64)
    place.sort()
    edge = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
    count = np.diff(np.concatenate((edge, [len(place)]))).astype(float)
    return place[edge], count / np.sqrt((count * count).sum())


def _chance(z: float) -> float:
    return 1 / (1 + np.exp(-min(max(z, -35.0), 35.0)))


def ftrl(examples: list[tuple[np.ndarray, np.ndarray, float]], bits: int = BITS) -> np.ndarray:
    """Weights, the last of which is the intercept. Each example is one online update of
    the places it holds; weights follow from the sums z and n in closed form."""
    size = 1 << bits
    z, n = np.zeros(size + 1), np.zeros(size + 1)

    def weights(at: np.ndarray) -> np.ndarray:
        zs, ns = z[at], n[at]
        return np.where(np.abs(zs) <= L1, 0.0, -(zs - np.sign(zs) * L1) / ((BETA + np.sqrt(ns)) / ALPHA + L2))

    rng = np.random.default_rng(SEED)
    for _ in range(PASSES):
        for k in rng.permutation(len(examples)):
            place, value, y = examples[k]
            at, x = np.append(place, size), np.append(value, 1.0)
            w = weights(at)
            g = (_chance(float(w @ x)) - y) * x
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
            z[at] += g - sigma * w
            n[at] += g * g
    return weights(np.arange(size + 1))


def held_out(doc_id: Column) -> Column:
    """Rows of the fold that labels are never learnt from."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(4)) == 2, F.lit(False))


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches, 64):
        found = [features(t) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([
            batch.column("doc_id"), batch.column("y"), pa.array([p.astype("<i4").tobytes() for p, _ in found], pa.binary()),
            pa.array([v.astype("<f8").tobytes() for _, v in found], pa.binary())], ["doc_id", "y", "place", "value"])


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> np.ndarray:
    """Weights from at most `rows` labelled documents outside the held-out fold, those
    with the smallest hashes of the id, both labels in the shares that they have there.

    Features are made where the texts are; one task reads the sparse features of these
    rows, whose number is fixed (2^BITS places of a row at most, however long its text),
    and updates the weights row by row. Null ids, texts and labels and
    labels other than 0 and 1 are not learnt from; an id with both labels is learnt as
    both. Without any label all scores are 1/2.
    """
    own = labels.select(F.col("doc_id").alias("_doc"), F.col("quality").cast("int").alias("y")).filter(
        F.col("_doc").isNotNull() & F.col("y").isin(0, 1) & ~held_out(F.col("_doc"))).distinct()
    order = F.xxhash64("_doc")
    both = F.broadcast(own.orderBy(order, "_doc", "y").limit(rows))  # `rows` rows of two numbers at most
    chosen = docs.select("doc_id", "text").filter("text IS NOT NULL").join(both, F.col("doc_id") == F.col("_doc"))
    chosen = chosen.groupBy("doc_id", "y").agg(F.min("text").alias("text"))

    def fit(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["doc_id", "y"])
        w = ftrl([(np.frombuffer(p, "<i4").astype(np.int64), np.frombuffer(v, "<f8"), float(y))
                  for p, v, y in zip(group["place"], group["value"], group["y"], strict=True)])
        return pd.DataFrame({"w": [w.astype("<f8").tobytes()]})

    kind = dict(chosen.dtypes)["doc_id"]
    examples = chosen.select("doc_id", "y", "text").mapInArrow(_examples, f"doc_id {kind}, y int, place binary, value binary")
    found = examples.groupBy(F.lit(0).alias("one")).applyInPandas(fit, "w binary").collect()
    return np.frombuffer(found[0]["w"], "<f8") if found else np.zeros((1 << BITS) + 1)


def _score(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = np.frombuffer(shared.value, "<f8")
        for batch in sliced(batches, 256):
            scores = []
            for text in batch.column("text").to_pylist():
                place, value = features(text)
                scores.append(_chance(float(w[place] @ value + w[-1])))
            rest = batch.drop_columns(["text"])
            yield pa.RecordBatch.from_arrays([*rest.columns, pa.array(scores, pa.float64())], [*rest.schema.names, "score"])

    return run


def scored(spark: SparkSession, docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """doc_id, text_hash and score of every row, its whole text read."""
    shared = spark.sparkContext.broadcast(weights.tobytes())  # 2^BITS numbers
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    return rows.mapInArrow(_score(shared), "doc_id long, text_hash long, score double")


def classify(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document row: doc_id, held_out, score, predicted, text_hash.

    Null and empty texts have no features: the intercept alone scores them. Null ids are
    never held out. Repeated rows come out as often as they went in; an empty table gives
    no rows. Of `docs` only doc_id and text are read, of `labels` doc_id and quality.
    """
    out = scored(docs.sparkSession, docs, train(docs, labels, rows))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                      (F.col("score") >= threshold).cast("int").alias("predicted"), "text_hash")


def accepted(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """The documents predicted to be good, all columns as they were, in one pass."""
    weights = train(docs, labels, rows)
    shared = docs.sparkSession.sparkContext.broadcast(weights.tobytes())
    text_at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = np.frombuffer(shared.value, "<f8")
        for batch in sliced(batches, 256):
            keep = []
            for text in batch.column(text_at).to_pylist():
                place, value = features(text)
                keep.append(_chance(float(w[place] @ value + w[-1])) >= threshold)
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
