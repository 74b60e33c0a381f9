"""Best-fit-decreasing packing of tokenized documents into sequences of bounded length.

Lengths are whole numbers up to the capacity, so what the packing needs to know of a corpus
is how many pieces there are of each length. That table has `capacity` rows whatever the
corpus holds; Spark counts it, and the placing runs on it: lengths in falling order, each
piece into the tightest open sequence that takes it, found by a segment tree over the
remaining capacities. Sequences with equal room are alike, so pieces of one length are
placed in runs. The outcome is best-fit decreasing over all pieces of the corpus at once.

A run says: of length L, the pieces numbered a..a+n-1 go to the sequences s..s+n-1 at one
offset. Every piece finds its run by its length and its number among the pieces of that
length; numbering is spread over buckets.

Each length adds at most four groups of alike sequences (the last one used is split in
three, and new ones are opened), so there are at most 4 * capacity at any time, and the
runs have a bound that depends on the capacity alone.
"""

from __future__ import annotations

import json
import zlib
from collections import defaultdict, deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hourglass.llm.common import counted_copies, each_copy, sliced, stored
from hourglass.llm.token_count import byte_symbols

CAPACITY = 2048
#: id that ends every document
END = 0
#: pieces that one numbering bucket holds on average
BUCKET_ROWS = 50_000
#: rows that a worker tokenizes at a time
BATCH = 64
#: fixed values: how a byte-level tokenizer cuts text into pieces; without its part for
#: white space before white space the same for texts in which no two white characters meet
PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|", r"\s+(?!\S)|", r"\s+")


# ------------------------------------------------------------------------------ tokens

class Encoder:
    """Ids of whole texts as the library `tokenizers` gives them for a vocabulary file.

    A byte-level vocabulary whose merges make its ids in order is also one of ranks; such a
    file is read by the faster `tiktoken`, special strings apart, else the library itself
    encodes. Both give the same ids.
    """

    def __init__(self, tokenizer_json: str):
        spec = json.loads(tokenizer_json)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        plain = not any(t[k] for t in spec["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized"))
        self.ranks = _ranks(spec) if plain else None
        if self.ranks is None:
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_str(tokenizer_json)
            self.library.no_truncation()
            self.library.no_padding()
            return
        import regex
        import tiktoken

        self.spaced, self.single = (tiktoken.Encoding(name, pat_str=pattern, mergeable_ranks=self.ranks, special_tokens={})
                                    for name, pattern in (("spaced", "".join(PATTERN)), ("single", PATTERN[0] + PATTERN[2])))
        self.two_white = regex.compile(r"\s\s")
        self.cut = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None

    def _part(self, text: str) -> list[int]:
        return (self.spaced if self.two_white.search(text) else self.single).encode_ordinary(text)

    def __call__(self, text: str) -> list[int]:
        if self.ranks is None:
            return self.library.encode(text, add_special_tokens=False).ids
        found = [*self.cut.finditer(text)] if self.cut else []
        if not found:
            return self._part(text)
        out, at = [], 0
        for hit in found:
            out += self._part(text[at : hit.start()])
            out.append(self.special[hit[0]])
            at = hit.end()
        return out + self._part(text[at:])


def _ranks(spec: dict) -> dict[bytes, int] | None:
    model, pre = spec["model"], spec["pre_tokenizer"]
    if model["type"] != "BPE" or pre["type"] != "ByteLevel" or pre["add_prefix_space"] or spec["normalizer"] or not pre.get("use_regex", True):
        return None
    if model["dropout"] or model["byte_fallback"] or model.get("ignore_merges"):
        return None
    byte, special = byte_symbols(), {t["content"] for t in spec["added_tokens"]}
    ranks = {bytes(byte[c] for c in t): k for t, k in model["vocab"].items() if t not in special}
    merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    made = [bytes(byte[c] for c in a + b) for a, b in merges]
    return ranks if [ranks.get(t) for t in made] == [*range(256, 256 + len(made))] and len(ranks) == 256 + len(made) else None


def _encode(shared, capacity: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Encoder(shared.value)
        for batch in sliced(batches, BATCH):
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                ids = np.array([*encode(text or ""), END], "<u4")
                first = (len(ids) - 1) % capacity + 1
                start = 0
                for piece, end in enumerate(range(first, len(ids) + 1, capacity)):
                    part = ids[start:end].tobytes()
                    rows.append((doc_id, piece, start, end - start, zlib.crc32(part), *([part] if with_ids else [])))
                    start = end
            names = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])]
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kinds[k]) for k in range(len(names))], names)

    return run


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids: little-endian unsigned 32-bit) of
    every document's pieces: its ids and the end id, cut into pieces of `capacity`, the first
    of which may be shorter. `tokenizer` is the path of the vocabulary file."""
    with open(tokenizer, encoding="utf-8") as file:
        shared = docs.sparkSession.sparkContext.broadcast(file.read())
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text")).mapInArrow(
        _encode(shared, capacity, with_ids),
        "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids binary" if with_ids else ""))


# ------------------------------------------------------------------------------ placing

class OpenRoom:
    """A segment tree over the rooms 1..capacity: which of them open sequences have."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.any = [False] * (2 * self.size)

    def set(self, room: int, there: bool) -> None:
        k = room + self.size
        self.any[k] = there
        while k > 1:
            k //= 2
            self.any[k] = self.any[2 * k] or self.any[2 * k + 1]

    def tightest(self, length: int) -> int | None:
        """The smallest room of at least `length` that a sequence has."""
        k = length + self.size
        if self.any[k]:
            return length
        while k > 1:
            if k % 2 == 0 and self.any[k + 1]:
                k += 1
                while k < self.size:
                    k = 2 * k if self.any[2 * k] else 2 * k + 1
                return k - self.size
            k //= 2
        return None


def best_fit_decreasing(counts: dict[int, int], capacity: int = CAPACITY) -> np.ndarray:
    """Runs (length, first piece, first sequence, offset, pieces), sorted, for `counts`
    pieces of each length."""
    tree, groups, opened, runs = OpenRoom(capacity), defaultdict(deque), 0, []

    def give(room: int, first: int, n: int) -> None:
        if room:
            group = groups[room]
            if not group:
                tree.set(room, True)
            if group and group[-1][0] + group[-1][1] == first:
                group[-1] = (group[-1][0], group[-1][1] + n)
            else:
                group.append((first, n))

    for length in sorted(counts, reverse=True):
        placed, left = 0, counts[length]
        while left:
            room = tree.tightest(length)
            if room is None:
                room, first = capacity, opened
                n = -(-left // (capacity // length))
                opened += n
            else:
                first, n = groups[room].popleft()
                if not groups[room]:
                    tree.set(room, False)
            # a sequence that still has room after a piece is the tightest for the next one
            each = room // length
            full = min(n, left // each)
            for filled, takes in ((full, each), (min(n - full, 1), left - full * each), (n - full - 1, 0)):
                if filled > 0:
                    takes = min(takes, each)
                    for k in range(takes):
                        runs.append((length, placed, first, capacity - room + k * length, filled))
                        placed, left = placed + filled, left - filled
                    give(room - takes * length, first, filled)
                    first += filled
    return np.array(sorted(runs), np.int64).reshape(-1, 5)


# ------------------------------------------------------------------------------ pieces

KEYS = ["doc_id", "piece", "start", "length", "ids_crc32"]


def _numbered(pieces: DataFrame, n: int) -> DataFrame:
    """Every piece with `number`, 0.. among those of its length, in an order that depends on
    contents alone. Equal rows are counted first and their copies dealt over tasks; a length
    that many pieces share is spread over buckets."""
    buckets = max(1, -(-n // BUCKET_ROWS))
    dealt = counted_copies(pieces.select(*KEYS)).withColumn("_bucket", F.pmod(F.xxhash64(*KEYS), F.lit(buckets)))
    before = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy("length", "_bucket").agg(F.sum("_n").alias("_rows")).select(
        F.col("length").alias("_len"), F.col("_bucket").alias("_at"), F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    within = Window.partitionBy("length", "_bucket").orderBy(*[F.col(k).asc_nulls_first() for k in KEYS]).rowsBetween(
        Window.unboundedPreceding, -1)
    out = dealt.withColumn("_place", F.coalesce(F.sum("_n").over(within), F.lit(0))).join(
        starts, (F.col("length") == F.col("_len")) & (F.col("_bucket") == F.col("_at")))
    return each_copy(out, KEYS, "_copy").withColumn("number", F.col("_start") + F.col("_place") + F.col("_copy")).select(*KEYS, "number")


def _place(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = np.frombuffer(shared.value, np.int64).reshape(-1, 5)
        key = (runs[:, 0] << 48) + runs[:, 1]
        for batch in batches:
            length, number = (np.asarray(batch.column(c)) for c in ("length", "number"))
            at = np.searchsorted(key, (length << 48) + number, "right") - 1
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in KEYS), pa.array(runs[at, 2] + number - runs[at, 1]), pa.array(runs[at, 3])],
                [*KEYS, "sequence_id", "offset"])

    return run


def placed(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id and offset of every piece.
    `pieces` is read three times: store it first."""
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # <= capacity rows
    runs = best_fit_decreasing(counts, capacity)
    shared = pieces.sparkSession.sparkContext.broadcast(runs.tobytes())
    return _numbered(pieces, sum(counts.values())).mapInArrow(
        _place(shared), "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """Where every piece of every document lies: doc_id, piece, start, length, ids_crc32,
    sequence_id (0.. without gaps) and offset (without gaps in each sequence).

    Null text counts as empty: its document is the end id alone. A null id is an id like any
    other. Repeated rows are separate documents; which of two pieces equal in all columns
    lies where cannot be told apart. A text is tokenized whole, however long. Reruns agree.
    An empty table gives no rows. Other columns are not read.
    """
    return placed(stored(token_pieces(docs, tokenizer, capacity), "packing-pieces"), capacity)


def sequences(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """The packed sequences: sequence_id, ids (array of at most `capacity`) and, for each
    document in it, where it starts. A sequence is a group of at most `capacity` ids."""
    pieces = stored(token_pieces(docs, tokenizer, capacity, with_ids=True), "packing-ids")
    where = placed(pieces, capacity)
    # pieces equal in all keys hold the same ids: one copy of the ids serves them all
    ids = pieces.dropDuplicates(KEYS).select(*[F.col(k).alias(f"_{k}") for k in KEYS], "ids")
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in KEYS]
    on = same[0]
    for c in same[1:]:
        on = on & c

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, BATCH):
            ids = [np.concatenate([np.frombuffer(x, "<u4") for x in row]).astype(np.int32) for row in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("sequence_id"), pa.array(ids, pa.list_(pa.int32())), batch.column("starts")],
                                             ["sequence_id", "ids", "starts"])

    grouped = where.join(ids, on).groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("p"))
    return grouped.select("sequence_id", F.col("p.ids").alias("ids"), F.col("p.offset").alias("starts")).mapInArrow(
        joined, "sequence_id long, ids array<int>, starts array<long>")
