"""Near duplicates: MinHash signatures and a multi-index Hamming join, confirmed on full sets.

A document's set is its distinct word shingles. Documents with the same set are one vertex.
A vertex has a signature of CHUNKS * WIDTH MinHash values of 16 bits; the signature
distance of two is the number of places in which they differ. Cut into CHUNKS chunks, two
signatures at distance up to CHUNKS * (ERRORS + 1) - 1 have a chunk with at most ERRORS
differing places, by the pigeonhole principle. The index enumerates the allowed errors: it
holds each chunk once for every choice of ERRORS places left out, so all such pairs share
a key, whatever their distance elsewhere.

Keys only group vertices into clusters: each links to the smallest vertex of its key, never
all pairs of a key. A pair that shares a key is inside one cluster; the full sets of a
cluster are then compared exactly, in blocks of bounded size, skipping pairs that are
already connected.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hourglass.llm.common import sliced, stored

CHUNKS, WIDTH, ERRORS = 10, 5, 1
#: shingle hashes that one block of a cluster holds on average (8 bytes each)
BLOCK_SHINGLES = 1_000_000
#: bits of the filter that keeps documents outside any cluster from being shuffled
FILTER_BITS = 1 << 22
#: rows that a worker turns into sets at a time
BATCH = 64

_WORD = np.random.default_rng(1).integers(0, 2**64, 256, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_WHITE = np.zeros(256, bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def word_hashes(text: bytes) -> np.ndarray:
    """64-bit hashes of the words, by differences of one running polynomial sum."""
    if not text:
        return np.empty(0, np.uint64)
    data = np.frombuffer(text, np.uint8)
    gap = _WHITE[data]
    edge = np.diff(np.concatenate(([True], gap, [True])).astype(np.int8))
    start, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_WORD[data] * _powers(_BASE, len(data)), dtype=np.uint64)))
    value = (total[end] - total[start]) * _powers(_BASE_INVERSE, len(data))[start]
    return _mixed(value + (end - start).astype(np.uint64))


def shingles(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of `words` words; of fewer words, one
    shingle of all; of none, no shingle."""
    h = word_hashes((text or "").encode("utf-8", "surrogatepass").lower())
    if not len(h):
        return h
    n = min(words, len(h))
    s = np.zeros(len(h) - n + 1, np.uint64)
    for k in range(n):
        s = _mixed(s * np.uint64(0xC2B2AE3D27D4EB4F) + h[k : len(h) - n + 1 + k])
    s = s + np.uint64(n)
    s.sort()
    return s[np.concatenate(([True], s[1:] != s[:-1]))]


def _hash_family(k: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(2)
    return rng.integers(0, 2**63, k, dtype=np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(0, 2**64, k, dtype=np.uint64)


def signature(s: np.ndarray, k: int = CHUNKS * WIDTH) -> np.ndarray:
    """MinHash values, 16 bits of each; of an empty set, none."""
    if not len(s):
        return np.empty(0, np.uint16)
    a, b = _hash_family(k)
    least = np.full(k, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(s), 1024):  # bounds memory for very long texts
        least = np.minimum(least, (a[:, None] * s[None, at : at + 1024] + b[:, None]).min(1))
    return (_mixed(least) >> np.uint64(48)).astype(np.uint16)


def keys(sig: np.ndarray, chunks: int = CHUNKS, width: int = WIDTH, errors: int = ERRORS) -> np.ndarray:
    """64-bit index keys: a chunk without every choice of `errors` of its places."""
    from itertools import combinations

    out = []
    for c in range(chunks):
        part = sig[c * width : (c + 1) * width].astype(np.uint64)
        for left in combinations(range(width), errors):
            h = np.array([c + 1], np.uint64)
            for place in range(width):
                if place not in left:
                    h = _mixed(h * np.uint64(0xC2B2AE3D27D4EB4F) + part[place] * np.uint64(256) + np.uint64(place + 1))
            out.append(h[0])
    return np.array(out, np.uint64).view(np.int64)


def _sketch(word_count: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, BATCH):
            n, sets, sigs = [], [], []
            for text in batch.column("text").to_pylist():
                s = shingles(text, word_count)
                n.append(len(s))
                sets.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                sigs.append(signature(s).tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), batch.column("text_hash"), pa.array(n, pa.int64()),
                pa.array(sets, pa.binary()), pa.array(sigs, pa.binary())],
                ["doc_id", "text_hash", "n_shingles", "set_id", "signature"])

    return run


def sketches(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, text_hash, n_shingles, set_id (128-bit hash of the set) and signature."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text").mapInArrow(
        _sketch(words), "doc_id long, text_hash long, n_shingles long, set_id binary, signature binary")


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from itertools import combinations

    mul = np.uint64(0xC2B2AE3D27D4EB4F)
    for batch in sliced(batches, 2048):
        sig = np.array([np.frombuffer(x, np.uint16) for x in batch.column("signature").to_pylist()], np.uint64)
        sig = sig.reshape(batch.num_rows, CHUNKS * WIDTH)
        cols = []
        for c in range(CHUNKS):
            for left in combinations(range(WIDTH), ERRORS):
                h = np.full(len(sig), c + 1, np.uint64)
                for place in range(WIDTH):
                    if place not in left:
                        h = _mixed(h * mul + sig[:, c * WIDTH + place] * np.uint64(256) + np.uint64(place + 1))
                cols.append(h.view(np.int64))
        v = np.tile(np.asarray(batch.column("v")), len(cols))
        key = np.concatenate(cols) if cols else np.empty(0, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(v)], ["key", "v"])


def components(edges: DataFrame, name: str) -> DataFrame:
    """(v, root) for every vertex of the undirected `edges` (a, b); root is the smallest
    vertex reachable. Large-star and small-star steps in turn, until nothing changes."""
    pair = F.struct(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    now = stored(edges.select(pair.alias("e")).select("e.*").filter("a != b").distinct(), name)
    while True:
        both = now.select("a", "b").unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("at"), F.least("m", "at").alias("m"))
        # large star: every larger neighbour goes to the smallest of the neighbourhood
        large = both.filter("b > a").join(least, F.col("a") == F.col("at")).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        down = large.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "at")
        # small star: smaller neighbours, and the vertex itself, go to their smallest
        joined = large.join(down, F.col("a") == F.col("at"))
        small = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(down.select(F.col("at").alias("a"), F.col("m").alias("b")))
        after = stored(small.filter("a != b").distinct(), name)
        if after.count() == now.count() and after.exceptAll(now).isEmpty():
            break
        now = after
    return now.select(F.col("a").alias("v"), F.col("b").alias("root")).unionByName(
        now.select(F.col("b").alias("v"), F.col("b").alias("root")).distinct())


def _filter_words(members: DataFrame) -> np.ndarray:
    """A bitmap of FILTER_BITS bits with those of the members' text hashes set. Its size is
    fixed, whatever the number of members: at most FILTER_BITS / 64 numbers are collected."""
    bit = F.pmod("text_hash", F.lit(FILTER_BITS))
    words = members.select(F.call_function("div", bit, F.lit(64)).alias("w"), F.pmod(bit, F.lit(64)).cast("int").alias("p")).groupBy("w").agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("p"))).alias("bits")).collect()
    out = np.zeros(FILTER_BITS // 64, np.int64)
    for r in words:
        out[r["w"]] = r["bits"]
    return out


def _sets_of(shared, word_count: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(shared.value, np.uint64)
        for batch in sliced(batches, BATCH):
            h = np.asarray(batch.column("text_hash")).astype(np.int64) % FILTER_BITS
            keep = (bits[h // 64] >> (h % 64).astype(np.uint64)) & np.uint64(1) == 1
            if not keep.any():
                continue
            batch = batch.filter(pa.array(keep))
            sets = [shingles(t, word_count).tobytes() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_hash"), pa.array(sets, pa.binary())],
                                             ["doc_id", "text_hash", "shingles"])

    return run


def _linked(sets: list[np.ndarray], first: int, num: int, den: int, joined: list[int]) -> list[tuple[int, int]]:
    """Links of a spanning forest of the pairs with den * |A & B| >= num * |A | B|.

    With first > 0, only pairs of one of the first `first` sets and one of the others. The
    intersections of one set with all others come from one pass over the block's shingles;
    pairs that are connected already, or whose sizes rule them out, are left out.
    """
    size = np.array([len(s) for s in sets])
    start = np.concatenate(([0], np.cumsum(size)))
    local = np.unique(np.concatenate(sets), return_inverse=True)[1]
    flag = np.zeros(int(local.max()) + 1, bool)
    parent = np.array(joined)

    def label() -> np.ndarray:
        at = parent
        while True:
            up = at[at]
            if (up == at).all():
                return at
            at = up

    out = []
    for i in range(first or len(sets)):
        root = label()
        parent = root.copy()
        others = np.arange(first or i + 1, len(sets))
        low, high = np.minimum(size[others], size[i]), np.maximum(size[others], size[i])
        others = others[(root[others] != root[i]) & (den * low >= num * high)]
        if not len(others):
            continue
        flag[local[start[i] : start[i + 1]]] = True
        piece = np.concatenate([local[start[j] : start[j + 1]] for j in others])
        both = np.add.reduceat(flag[piece].astype(np.int64), np.concatenate(([0], np.cumsum(size[others])[:-1])))
        flag[local[start[i] : start[i + 1]]] = False
        for j in others[den * both >= num * (size[i] + size[others] - both)]:
            a, b = int(root[i]), int(root[j])
            if a != b:
                parent[max(a, b)] = min(a, b)
                root = label()
                out.append((i, int(j)))
    return out


def _resolve(num: int, den: int):
    def block(rows: list[tuple]) -> list[tuple[int, int]]:
        """rows: (side, v, shingles) of a block (side 0) or of two (sides 0 and 1)."""
        rows.sort(key=lambda r: (r[0], r[1]))
        first = sum(r[0] == 0 for r in rows)
        sets = [np.frombuffer(r[2], np.uint64) for r in rows]
        cross = first if first < len(rows) else 0
        if not first:
            return []
        links = _linked(sets, cross, num, den, [*range(len(rows))])
        return [(rows[i][1], rows[j][1]) for i, j in links]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, rows = None, []

        def done() -> pa.RecordBatch:
            links = block(rows) if len(rows) > 1 else []
            return pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], pa.binary()) for k in (0, 1)], ["a", "b"])

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("cluster", "i", "j", "side", "v", "shingles")]
            for cluster, i, j, side, v, s in zip(*columns, strict=True):
                if (cluster, i, j) != at:
                    if rows:
                        yield done()
                    at, rows = (cluster, i, j), []
                rows.append((side, v, s))
        if rows:
            yield done()

    return run


def near_duplicates(docs: DataFrame, words: int = 5, similarity: tuple[int, int] = (8, 10),
                    block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """One row per distinct (doc_id, set): doc_id, n_shingles, component_id, kept, text_hash, root.

    Linked are documents with similarity[1] * |A & B| >= similarity[0] * |A | B| on their sets of
    `words`-word shingles; component_id is the smallest doc_id reachable over links.

    Null, empty and blank texts have an empty set and are linked with nothing. A null id
    never becomes a component's id unless the component has no other. Repeated rows (the
    same id and set) come out once. An empty table gives no rows. Other columns are not read.
    `root` is one set of the component, the same for all its rows; null without a set.
    """
    num, den = similarity
    rows = stored(sketches(docs, words), "near-sketches")
    full = rows.filter("set_id IS NOT NULL")
    # one vertex for each set; its representative's text is read again if it is in a cluster
    vertices = stored(full.groupBy("set_id").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "text_hash")).alias("rep"),
        F.first("signature").alias("signature"), F.first("n_shingles").alias("n_shingles")).select(
        "set_id", "rep.doc_id", "rep.text_hash", "signature", "n_shingles", F.xxhash64("set_id").alias("v")), "near-vertices")
    index = vertices.select("v", "signature").mapInArrow(_index, "key long, v long")
    shared = index.groupBy("key").agg(F.min("v").alias("root"), F.max("v").alias("_most")).filter("_most > root").select(
        F.col("key").alias("_key"), "root")
    stars = index.join(shared, F.col("key") == F.col("_key")).filter("v > root").select(
        F.col("v").alias("a"), F.col("root").alias("b")).distinct()
    clusters = components(stars, "near-clusters").withColumnRenamed("v", "_v").withColumnRenamed("root", "cluster")
    members = stored(vertices.drop("signature").join(clusters, F.col("v") == F.col("_v")).drop("_v"), "near-members")
    # the full sets of the members, in blocks of their cluster
    spark = docs.sparkSession
    bits = spark.sparkContext.broadcast(_filter_words(members).tobytes())
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text").mapInArrow(
        _sets_of(bits, words), "doc_id long, text_hash long, shingles binary")
    own = members.select(F.col("doc_id").alias("_doc"), F.col("text_hash").alias("_text"), F.col("set_id").alias("v"), "cluster")
    per = members.groupBy("cluster").agg(F.ceil(F.sum("n_shingles") / F.lit(block_shingles)).cast("int").alias("blocks"))
    blocks = own.join(per.withColumnRenamed("cluster", "_c"), F.col("cluster") == F.col("_c")).withColumn(
        "block", F.pmod(F.xxhash64("v"), F.col("blocks")).cast("int"))
    sets = read.join(blocks, read["doc_id"].eqNullSafe(F.col("_doc")) & (read["text_hash"] == F.col("_text"))).dropDuplicates(["v"])
    paired = sets.withColumn("other", F.explode_outer(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "cluster", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
        (F.col("block") > F.col("other")).cast("int").alias("side"), "v", "shingles")
    links = paired.repartition("cluster", "i", "j").sortWithinPartitions("cluster", "i", "j").mapInArrow(
        _resolve(num, den), "a binary, b binary")
    linked = components(links, "near-links").select(F.col("v").alias("_v"), "root")
    least = vertices.join(linked, F.col("set_id") == F.col("_v"), "left").withColumn("root", F.coalesce("root", "set_id"))
    by_root = least.groupBy("root").agg(F.min("doc_id").alias("component_id")).withColumnRenamed("root", "_root")
    classes = least.select("set_id", "root").join(by_root, F.col("root") == F.col("_root")).select(
        F.col("set_id").alias("_set"), "root", "component_id")
    out = rows.groupBy("doc_id", "set_id", "n_shingles").agg(F.min("text_hash").alias("text_hash")).join(
        classes, F.col("set_id") == F.col("_set"), "left")
    component = F.when(F.col("set_id").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.withColumn("component_id", component).select(
        "doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"), "text_hash", "root")


def distinct_documents(docs: DataFrame, **parameters) -> DataFrame:
    """One document of each component, all columns as they were: the one with the smallest
    id, null ids last. Documents that share an id, or have none, but are linked with nothing
    all stay; of rows equal in id and text one stays, and of rows equal in id without words."""
    alone = F.col("root").isNull()
    kept = near_duplicates(docs, **parameters).groupBy("root", F.when(alone, F.col("doc_id")).alias("alone")).agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "text_hash")).alias("rep")).select(
        F.col("rep.doc_id").alias("_doc"), F.col("rep.text_hash").alias("_text"))
    # rows travel as one struct, so that no column of theirs can clash with one made here
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"),
                       F.xxhash64(*docs.columns).alias("row_hash"), F.struct(*docs.columns).alias("row"))
    out = rows.join(kept, rows["doc_id"].eqNullSafe(F.col("_doc")) & (F.col("text_hash") == F.col("_text")), "left_semi")
    if docs.select("doc_id").groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1").isEmpty():
        return out.select("row.*")
    place = F.row_number().over(Window.partitionBy("doc_id", "text_hash").orderBy("row_hash"))
    return out.withColumn("place", place).filter("place = 1").select("row.*")
