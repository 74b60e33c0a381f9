"""Phrase collocations from count streams in prefix and suffix order.

Counts come level by level. A phrase of m words can only be frequent if the two phrases of
m-1 words in it are, so a pass over the text counts, at each place, the phrases whose two
parts may be frequent; a bitmap of fixed size, made of the frequent phrases of the level
before, tells. It has false positives and no false negatives, and all counts of the phrases
that pass are exact: tasks count blocks of text, Spark sums by language and phrase.

Frequent phrases then are count streams. A level in prefix order (by its first m-1 words) is
merged in lockstep with the level below it: that gives each phrase the counts of all its
first parts, and the shorter phrase its largest right extension. In suffix order (by the
last m-1 words) the same merge gives last parts and left extensions. The merges are sort-
merge joins, so a first word with very many phrases is split by Spark over tasks.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourglass.llm.common import sliced, stored

LONGEST = 5
LEAST = 100
TOP = 2000
#: bits of the bitmap of frequent phrases: 4 MB whatever the corpus holds
FILTER_BITS = 1 << 25
#: bytes of text that a worker counts at a time; a longer text is cut between its pieces
BLOCK = 1_000_000
#: rows of a batch that are turned into Python values at a time
ROWS = 256
UNKNOWN = "und"
#: parts of a language that are ranked apart before the final ranking
DEALT = 32

#: fixed values: what ends a piece, and what ends a word in it
BREAKS, BLANKS = b".,;:!?\n\x0b\x0c\r", b" \t"
_BREAK = re.compile(b"[" + re.escape(BREAKS) + b"]")
_KIND = np.zeros(256, np.uint8)
_KIND[list(BLANKS)] = 1
_KIND[list(BREAKS)] = 2
_BYTE = np.random.default_rng(3).integers(0, 2**64, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15
_STEP = np.uint64(0xC2B2AE3D27D4EB4F)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Powers:
    """Powers of an odd number and of its inverse, kept for the longest block so far."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def __call__(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            self.up, self.down = (np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(n - 1, b, np.uint64))), dtype=np.uint64)
                                  for b in (_BASE, pow(_BASE, -1, 2**64)))
        return self.up[:n], self.down[:n]


_powers = _Powers()


class Block:
    """Words of some texts at once: where they are, their pieces, languages and hashes."""

    def __init__(self, texts: list[bytes], langs: list[str]):
        self.bytes = b"\n".join(texts).lower()  # bytes.lower: A-Z only
        data = np.frombuffer(self.bytes, np.uint8)
        kind = _KIND[data]
        edge = np.diff(np.concatenate(([True], kind > 0, [True])).astype(np.int8))
        self.start, self.end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        self.piece = np.cumsum(kind == 2, dtype=np.int32)[self.start] if len(data) else np.empty(0, np.int32)
        first = np.cumsum([0] + [len(t) + 1 for t in texts])[: len(texts)]
        self.langs, number = np.unique(np.array(langs, object), return_inverse=True) if langs else (np.empty(0, object), np.empty(0, int))
        row = np.searchsorted(first, self.start, "right") - 1
        self.lang = number[row] if len(row) else np.empty(0, int)
        up, down = _powers(max(len(data), 1))
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTE[data] * up[: len(data)], dtype=np.uint64)))
        salt = np.array([xxhash.xxh64_intdigest(x.encode()) for x in self.langs], np.uint64)
        value = (total[self.end] - total[self.start]) * down[self.start] if len(self.start) else np.empty(0, np.uint64)
        self.word = _mixed(value + (self.end - self.start).astype(np.uint64) + (salt[self.lang] if len(salt) else np.uint64(0)))

    def hashes(self, m: int) -> np.ndarray:
        """Hash of the phrase of m words at each place that has so many words after it."""
        n = max(len(self.word) - m + 1, 0)
        out = self.word[:n]
        for k in range(1, m):
            out = _mixed(out * _STEP + self.word[k : n + k])
        return out


def _parts(text: bytes) -> Iterator[bytes]:
    """A long text in parts of about BLOCK bytes, cut where pieces end."""
    at = 0
    while len(text) - at > BLOCK:
        end = _BREAK.search(text, at + BLOCK)
        if end is None:
            break
        yield text[at : end.start()]
        at = end.start()
    yield text[at:] if at else text


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[Block]:
    texts, langs, size = [], [], 0
    for batch in sliced(batches, ROWS):
        for whole, lang in zip(batch.column("text").cast(pa.binary()).to_pylist(), batch.column("lang").to_pylist(), strict=True):
            for text in _parts(whole):
                texts.append(text)
                langs.append(lang)
                size += len(text)
                if size >= BLOCK:
                    yield Block(texts, langs)
                    texts, langs, size = [], [], 0
    if texts:
        yield Block(texts, langs)


def _count(m: int, shared):
    """Counts of the phrases of m words in each block; only of those whose two parts have
    their bits set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(shared.value, np.uint8) if shared else None
        for block in _blocks(batches):
            whole = block.hashes(m)
            at = np.flatnonzero(block.piece[: len(whole)] == block.piece[m - 1 :]) if m > 1 else np.arange(len(whole))
            if bits is not None:
                bit = _bit(block.hashes(m - 1))
                there = (bits[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 == 1
                at = at[there[at] & there[at + 1]]
            if not len(at):
                continue
            value = whole[at]
            order = np.argsort(value, kind="stable")
            value, at = value[order], at[order]
            first = np.flatnonzero(np.concatenate(([True], value[1:] != value[:-1])))
            counts = np.diff(np.concatenate((first, [len(at)])))
            at = at[first]
            starts, ends = block.start[at].tolist(), block.end[at + m - 1].tolist()
            # words of a phrase are one space apart, or else put together anew
            gaps = np.cumsum(np.concatenate(([0], (block.start[1:] - block.end[:-1] != 1) | (np.frombuffer(block.bytes, np.uint8)[block.end[:-1]] != 32))))
            odd = (gaps[at + m - 1] - gaps[at]).tolist()
            text = block.bytes
            phrases = [text[a:b] if not o else b" ".join(text[a:b].split()) for a, b, o in zip(starts, ends, odd, strict=True)]
            yield pa.RecordBatch.from_arrays([
                pa.array(block.langs[block.lang[at]].tolist(), pa.string()), pa.array(phrases, pa.binary()), pa.array(counts, pa.int64())],
                ["lang", "phrase", "n"])

    return run


def _bit(value: np.ndarray) -> np.ndarray:
    return (value % np.uint64(FILTER_BITS)).astype(np.int64)


def _bits_of(m: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, phrases = batch.column("lang").to_pylist(), batch.column("phrase").to_pylist()
            if not phrases:
                continue
            block = Block(phrases, langs)
            yield pa.RecordBatch.from_arrays([pa.array(_bit(block.hashes(m)[::m]) if m > 1 else _bit(block.word))], ["bit"])

    return run


def _bitmap(frequent: DataFrame, m: int) -> bytes | None:
    """The bits of the frequent phrases; at most FILTER_BITS / 64 numbers come to the driver."""
    bit = frequent.select("lang", F.col("phrase").cast("binary").alias("phrase")).mapInArrow(_bits_of(m), "bit long")
    words = bit.select(F.call_function("div", "bit", F.lit(64)).alias("w"), (F.col("bit") % 64).cast("int").alias("p")).groupBy("w").agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("p"))).alias("bits")).toArrow()
    if not words.num_rows:
        return None
    out = np.zeros(FILTER_BITS // 64, np.int64)
    out[np.asarray(words.column("w"))] = np.asarray(words.column("bits"))
    return out.tobytes()


def phrase_counts(docs: DataFrame, longest: int = LONGEST, least: int = LEAST) -> tuple[DataFrame, list[DataFrame]]:
    """Words of each language (lang, n), and by length the phrases (lang, phrase, n) that
    occur at least `least` times there."""
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang"), F.col("text")).filter(
        "text IS NOT NULL AND text <> ''")
    levels, totals, shared = [], None, None
    for m in range(1, longest + 1):
        counted = rows.mapInArrow(_count(m, shared), "lang string, phrase binary, n long").groupBy(
            "lang", F.col("phrase").cast("string").alias("phrase")).agg(F.sum("n").alias("n"))
        if m == 1:
            counted = stored(counted, "collocation-words")
            totals = counted.groupBy("lang").agg(F.sum("n").alias("total"))
        level = stored(counted.filter(F.col("n") >= least), "collocation-phrases")
        levels.append(level)
        bits = _bitmap(level, m) if m < longest else None
        if bits is None:
            break
        shared = spark.sparkContext.broadcast(bits)
    return totals, levels


def _head(phrase: Column, m: int) -> Column:
    """The first m - 1 of the m words."""
    return F.substring_index(phrase, " ", m - 1)


def _tail(phrase: Column, m: int) -> Column:
    """The last m - 1 of the m words."""
    return F.substring_index(phrase, " ", 1 - m)


def _merged(above: DataFrame, below: DataFrame, m: int, part, counts: str) -> DataFrame:
    """`above` in the order of `part` of its phrases, merged with the level below it: each
    phrase gets the counts of its parts on that side, shortest first."""
    side = below.select(F.col("lang").alias("_lang"), F.col("phrase").alias("_part"),
                        F.concat(F.col(counts), F.array("n")).alias(f"_{counts}"))
    keyed = above.withColumn("_key", part(F.col("phrase"), m))
    return keyed.join(side.hint("merge"), (F.col("lang") == F.col("_lang")) & (F.col("_key") == F.col("_part"))).withColumn(
        counts, F.col(f"_{counts}")).drop("_lang", "_part", "_key", f"_{counts}")


def _extended(below: DataFrame, above: DataFrame, m: int) -> DataFrame:
    """`below` (m - 1 words) with `longer`: the largest count of a phrase with one word more on one side."""
    sides = [above.select(F.col("lang").alias("_lang"), part(F.col("phrase"), m).alias("_part"), "n") for part in (_head, _tail)]
    most = sides[0].unionByName(sides[1]).groupBy("_lang", "_part").agg(F.max("n").alias("_longer"))
    return below.join(most.hint("merge"), (F.col("lang") == F.col("_lang")) & (F.col("phrase") == F.col("_part")), "left").withColumn(
        "longer", F.coalesce("_longer", F.lit(0).cast("long"))).drop("_lang", "_part", "_longer")


def scored(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, kept: int = 100) -> DataFrame:
    """Every collocation: lang, phrase, a, l, r, n, score (a phrase is dropped if a longer
    frequent one that holds it occurs at least kept % as often)."""
    totals, levels = phrase_counts(docs, longest, least)
    none = F.array().cast("array<long>")
    below = levels[0].withColumn("firsts", none).withColumn("lasts", none)
    done = []
    for k, level in enumerate(levels[1:], 1):
        above = level.withColumn("firsts", none).withColumn("lasts", none)
        above = _merged(_merged(above, below, k + 1, _head, "firsts"), below, k + 1, _tail, "lasts")
        above = stored(above, "collocation-parts")
        # of two phrases, the shorter inside the longer, the longer is no more frequent, so
        # that the one-word extensions decide for all longer ones
        longer = levels[k + 1] if k + 1 < len(levels) else levels[k].filter("false")
        done.append(_extended(above, longer, k + 2).filter(100 * F.col("longer") < kept * F.col("n")))
        below = above
    if not done:
        done = [below.withColumn("longer", F.lit(0).cast("long")).filter("false")]
    found = reduce(DataFrame.unionByName, done).withColumnRenamed("n", "a").join(totals.withColumnRenamed("lang", "_lang"), F.col("lang") == F.col("_lang"))
    wide = "decimal(38,0)"
    # cut after k words: l is the k-th first part, r the last part of the other words
    times = F.col("a").cast(wide) * 1000 * F.col("total").cast(wide)
    cuts = F.transform(F.col("firsts"), lambda first, k: F.struct(
        F.call_function("div", times, first.cast(wide) * F.element_at(F.col("lasts"), -(k + 1)).cast(wide)).alias("score"),
        (k + 1).alias("k"), first.alias("l"), F.element_at(F.col("lasts"), -(k + 1)).alias("r")))
    return found.withColumn("_cut", F.array_min(cuts)).select(
        "lang", "phrase", "a", F.col("_cut.l").alias("l"), F.col("_cut.r").alias("r"), F.col("total").alias("n"),
        F.col("_cut.score").alias("score"))


def collocations(docs: DataFrame, top: int = TOP, **parameters) -> DataFrame:
    """The `top` collocations of each language: lang, rank (from 1), phrase, a, l, r, n, score.

    Null and empty texts hold no words; a null language counts as `und`. Repeated rows count
    as often as they come. Ties go to the more frequent phrase, then to the smaller one in
    byte order, so ranks are unique. A text is read whole, however long. An empty table, or
    one without a frequent phrase of two words, gives no rows. Other columns are not read.
    """
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    place = F.row_number()
    # the best of each of DEALT parts of a language first: one task then ranks DEALT * top rows
    dealt = scored(docs, **parameters).withColumn("_part", F.pmod(F.xxhash64("phrase"), F.lit(DEALT)))
    best = dealt.withColumn("rank", place.over(Window.partitionBy("lang", "_part").orderBy(*order))).filter(F.col("rank") <= top)
    ranked = best.withColumn("rank", place.over(Window.partitionBy("lang").orderBy(*order)))
    return ranked.filter(F.col("rank") <= top).select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
