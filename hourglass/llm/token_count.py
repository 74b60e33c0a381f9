"""Token counts of a byte-level BPE tokenizer, by two finite-state transducers.

The first cuts a text into pieces; of each character only its class (letter, number, other
mark, space, other white space) and those next to it decide whether a piece starts there.
The second reads a piece byte by byte. Its state after a prefix is the last token of the
prefix's encoding, and each transition says how many tokens the prefix now has: the new
last token is the one vocabulary suffix t whose remaining prefix ends in a token u such
that the merges leave u, t as they are. Transitions are compiled when a piece first needs
them and kept, as are the counts of pieces, in tables of bounded size.

A long text is cut into chunks anywhere, which any tasks may read in any order. What a chunk
does to the state is a small map: the piece it finishes (head), the tokens of its inner
pieces, and the piece it leaves open (tail). Maps compose associatively, so that a document's
maps are composed in rounds, `FAN` neighbours at a time, each group where the shuffle puts it:
no task holds a document. Rounds are as many as the longest text Spark can hold needs.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourglass.llm.common import each_copy, sliced

#: characters of a chunk; shorter texts are one chunk
CHUNK = 1 << 16
#: pieces whose counts a worker keeps at most, and three times as many states, before it
#: starts its tables anew (about 150 bytes each)
TABLE = 700_000
#: longer pieces are not kept in the table
LONG_PIECE = 200
LIMIT = 512
#: neighbouring maps that one group of a round composes
FAN = 32
#: characters of the longest string, which bound a document's chunks and so the rounds
LONGEST = 1 << 31

LETTER, NUMBER, MARK, SPACE, WHITE = range(5)
#: fixed values: letters after an apostrophe that make a piece with it
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")


def byte_symbols() -> dict[str, int]:
    """The symbol that byte-level vocabularies write for each byte: printable Latin-1
    characters stand for themselves, the others follow in order from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class PieceCounter(dict):
    """Token counts by piece, compiled when first asked for, in a table of bounded size.

    Two neighbouring tokens u, t stay apart iff no merge across them comes up while they
    are put together: of the tokens that end u (u, its right part, that one's right part,
    ...) and those that start t, a pair with a merge that is due while both stand.
    """

    def __init__(self, merges: list[tuple[bytes, bytes]], table: int = TABLE):
        super().__init__()
        self.rank = {pair: k for k, pair in enumerate(merges)}
        made = {a + b: k for k, (a, b) in reversed([*enumerate(merges)])}
        if any(made.get(x, -1) >= k for k, pair in enumerate(merges) for x in pair if len(x) > 1):
            raise ValueError("a merge comes before the merges that make its parts")
        self.token = [bytes([b]) for b in range(256)] + [*made]
        whole = {t: k for k, t in enumerate(self.token)}
        self.longest = max(map(len, self.token))
        #: number of each token; -1 for what only ends tokens
        self.number = {t[k:]: -1 for t in self.token for k in range(len(t))} | whole
        self.due = {whole[a] << 20 | whole[b]: k for k, (a, b) in enumerate(merges)}
        self.table = table
        self.parts: dict[int, tuple[int, int] | None] = {}
        self.ends: tuple[dict, dict] = ({}, {})
        self.fits: dict[int, bool] = {}
        #: compiled transitions by state and byte, and each state's last token and count, as
        #: one number
        self.follow: dict[int, int] = {}
        self.out: list[int] = [0]

    def merged(self, symbols: list[bytes]) -> tuple[list[bytes], tuple[bytes, bytes] | None]:
        """The merges applied in rank order, by definition, and the last one applied."""
        applied = None
        while len(symbols) > 1:
            best = min(range(len(symbols) - 1), key=lambda k: self.rank.get((symbols[k], symbols[k + 1]), 1 << 60))
            pair = (symbols[best], symbols[best + 1])
            if pair not in self.rank:
                break
            out, k, applied = [], 0, pair
            while k < len(symbols):
                if k + 1 < len(symbols) and (symbols[k], symbols[k + 1]) == pair:
                    out.append(pair[0] + pair[1])
                    k += 2
                else:
                    out.append(symbols[k])
                    k += 1
            symbols = out
        return symbols, applied

    def _made_of(self, t: int) -> tuple[int, int] | None:
        """The two parts of a token; (t, t) for a byte; None if the merges never make t of
        its own bytes."""
        if t not in self.parts:
            raw = self.token[t]
            symbols, applied = self.merged([raw[k : k + 1] for k in range(len(raw))])
            pair = tuple(self.number[x] for x in applied) if applied else (t, t)
            self.parts[t] = pair if symbols == [raw] else None
        return self.parts[t]

    def _end(self, t: int, side: int) -> list[tuple[int, int]]:
        """Tokens at one end of t, inner ones last, each with the rank that uses it up."""
        known = self.ends[side].get(t)
        if known is None:
            known, used = [(t, 1 << 60)], t
            while used >= 256:
                pair = self._made_of(used)
                used = pair[side]
                known.append((used, self.due[pair[0] << 20 | pair[1]]))
            self.ends[side][t] = known
        return known

    def _apart(self, u: int, t: int) -> bool:
        if self._made_of(t) is None:
            return False
        due, right = self.due.get, self._end(t, 0)
        for a, used_a in self._end(u, 1):
            for b, used_b in right:
                rank = due(a << 20 | b)
                # equal merges apply from the left: u's own goes first, the one across before t's
                if rank is not None and rank < used_a and rank <= used_b:
                    return False
        return True

    def _step(self, data: bytes, end: int, last: list[int], count: list[int]) -> None:
        """The transition on byte end-1: number of the new last token and the new count."""
        number, found, start = self.number.get, [], end - 1
        while start >= 0:
            t = number(data[start:end])
            if t is None:
                break
            if t >= 0:
                found.append((start, t))
            start -= 1
        for start, t in reversed(found):
            if start:
                key = last[start] << 20 | t
                fits = self.fits.get(key)
                if fits is None:
                    if len(self.fits) > 2 * self.table:
                        self.fits.clear()
                    fits = self.fits[key] = self._apart(last[start], t)
            else:
                fits = self._made_of(t) is not None
            if fits:
                last.append(t)
                count.append(count[start] + 1)
                return
        raise ValueError(f"no state follows on {data[:end]!r}")

    def tokens(self, piece: bytes) -> int:
        """Runs the transducer; a transition that is missing is compiled on the way. Of a
        very long piece the states are not kept."""
        last, count = [0], [0]
        if len(piece) > LONG_PIECE:
            for end in range(1, len(piece) + 1):
                self._step(piece, end, last, count)
            return count[-1]
        state, follow, out = 0, self.follow.get, self.out
        for end, byte in enumerate(piece, 1):
            to = follow(state << 8 | byte)
            if to is None:
                self._step(piece, end, last, count)
                to = self.follow[state << 8 | byte] = len(out)
                out.append(last[-1] << 8 | count[-1])
            else:
                last.append(out[to] >> 8)
                count.append(out[to] & 0xFF)
            state = to
        return count[-1]

    def __missing__(self, piece: str) -> int:
        if len(self) > self.table or len(self.out) > 3 * self.table:
            self.clear()
            self.follow, self.out = {}, [0]
        n = self.tokens(piece.encode("utf-8", "surrogatepass"))
        if len(piece) <= LONG_PIECE:
            self[piece] = n
        return n


class Classes:
    """Class of each character, as the tokenizer's own pattern sees it; looked up once."""

    def __init__(self, cut):
        self.cut = cut  # the tokenizer's own cutting of a short string into pieces
        self.of = np.full(0x110000, 255, np.uint8)

    def __call__(self, codes: np.ndarray) -> np.ndarray:
        out = self.of[codes]
        if (out == 255).any():
            for c in np.unique(codes[out == 255]).tolist():
                self.of[c] = self._find(chr(c))
            out = self.of[codes]
        return out

    def _find(self, ch: str) -> int:
        if ch == " ":
            return SPACE
        for kind, like in ((LETTER, "a"), (NUMBER, "0"), (MARK, "!")):
            if len(self.cut(like + ch)) == 1:
                return kind
        return WHITE


def piece_starts(codes: np.ndarray, kind: np.ndarray) -> np.ndarray:
    """Marks the characters at which a piece starts, of a text that starts and ends here.

    A run of one class is a piece and takes the one space before it. Of a longer white run
    before a character the last is cut off; an apostrophe that does not follow a mark or a
    space makes a piece with the letters of a contraction.
    """
    n = len(codes)
    if not n:
        return np.zeros(0, bool)
    white = kind >= SPACE
    before = np.concatenate(([255], kind[:-1])).astype(np.uint8)
    after_white = np.concatenate((white[1:], [True]))
    solid_start = ~white & (kind != before) & (before != SPACE)
    white_before = before >= SPACE
    white_before[0] = False
    white_start = white & (~white_before | ~after_white)
    start = solid_start | white_start
    start[0] = True
    quote = np.flatnonzero((codes == 39) & ((before == LETTER) | (before == NUMBER) | (before == WHITE) | (before == 255)))
    if len(quote):
        padded = np.concatenate((codes, np.zeros(2, codes.dtype)))
        one, two = padded[quote + 1], padded[np.minimum(quote + 2, n + 1)]
        size = np.zeros(len(quote), np.int64)
        for c in CONTRACTIONS:
            fits = (one == ord(c[0])) & ((two == ord(c[-1])) if len(c) == 2 else True)
            size = np.where((size == 0) & fits, len(c), size)
        quote, size = quote[size > 0], size[size > 0]
        start[quote + 1] = False
        end = quote + 1 + size
        inside = end < n
        start[end[inside]] |= ~white[end[inside]]
        long = quote[size == 2] + 2
        start[long] = False
    return start


class Counter:
    """A compiled tokenizer: token counts of texts and state maps of chunks."""

    def __init__(self, tokenizer_json: str, table: int = TABLE):
        from tokenizers import Tokenizer

        spec = json.loads(tokenizer_json)
        model, pre = spec["model"], spec["pre_tokenizer"]
        if model["type"] != "BPE" or pre["type"] != "ByteLevel" or pre["add_prefix_space"] or spec["normalizer"]:
            raise ValueError("only byte-level BPE without normalizer and added space is compiled")
        byte = byte_symbols()
        to_bytes = lambda s: bytes(byte[c] for c in s)
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.pieces = PieceCounter([(to_bytes(a), to_bytes(b)) for a, b in merges], table)
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.classes = Classes(Tokenizer.from_str(tokenizer_json).pre_tokenizer.pre_tokenize_str)

    def cut(self, text: str) -> list[str]:
        if not text:
            return []
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        at = np.flatnonzero(piece_starts(codes, self.classes(codes))).tolist()
        return [text[a:b] for a, b in zip(at, [*at[1:], len(text)], strict=True)]

    def plain(self, text: str) -> int:
        """Tokens of a text without special strings."""
        return sum(map(self.pieces.__getitem__, self.cut(text)))

    def parts(self, text: str) -> tuple[list[str], int]:
        """The text between special strings, and how many of them there are."""
        parts = [text]
        for s in self.special:
            parts = [p for part in parts for p in part.split(s)]
        return parts, len(parts) - 1

    def text(self, text: str | None) -> int:
        parts, special = self.parts(text or "")
        return special + sum(map(self.plain, parts))

    def chunk_map(self, text: str) -> tuple[str, int, str | None]:
        """(head, inner tokens, tail) of a chunk; no tail: nothing in it surely ends a piece.

        Head and tail are cut where a piece ends whatever stands before and after: where a run
        of letters, numbers or other marks ends, but not between an apostrophe and a letter,
        nor where the two sides may belong to a special string.
        """
        if not text:
            return text, 0, None
        at = self.ends(text)
        first = next((k for k in at if not self._in_special(text, k)), None)
        if first is None:
            return text, 0, None
        last = next(k for k in reversed(at) if not self._in_special(text, k))
        return text[:first], self.text(text[first:last]), text[last:]

    def ends(self, text: str) -> list[int]:
        """Places where a piece ends whatever stands before and after, special strings aside."""
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        kind = self.classes(codes)
        left, right = kind[:-1], kind[1:]
        run = (left == LETTER) | (left == NUMBER) | (left == MARK)
        contraction = (codes[:-1] == ord("'")) & (right == LETTER)
        return (np.flatnonzero(run & (left != right) & ~contraction) + 1).tolist()

    def _in_special(self, text: str, at: int) -> bool:
        """Whether a special string may lie across `at`, as far as the text shows."""
        for s in self.special:
            for k in range(1, len(s)):
                before, after = text[max(0, at - k) : at], text[at : at + len(s) - k]
                if s[:k].endswith(before) and s[k:].startswith(after):
                    return True
        return False

    def compose(self, left: tuple[str, int, str | None], right: tuple[str, int, str | None]):
        """The map of two chunks in a row."""
        if left[2] is None:
            return (left[0] + right[0], right[1], right[2])
        if right[2] is None:
            return (left[0], left[1], left[2] + right[0])
        return (left[0], left[1] + self.text(left[2] + right[0]) + right[1], right[2])

    def value(self, m: tuple[str, int, str | None]) -> int:
        """Tokens of a whole text from its map: nothing stands before head and after tail."""
        return self.text(m[0]) + m[1] + (self.text(m[2]) if m[2] else 0)


def compiled(shared) -> Counter:
    """The counter of a worker, compiled once: a broadcast value stays with the worker."""
    if "counter" not in shared.value:
        shared.value["counter"] = Counter(shared.value["json"])
    return shared.value["counter"]


def _maps(shared, limit: int):
    """Counts whole texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = compiled(shared)
        for batch in sliced(batches, 256):
            n = [counter.text(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_bytes"), pa.array(n, pa.int64()), pa.array([k > limit for k in n], pa.bool_())],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return run


def _chunk_rows(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        deal = 0
        for batch in sliced(batches, 1):
            text = batch.column("text")[0].as_py()
            for k, at in enumerate(range(0, len(text), size)):
                yield pa.RecordBatch.from_arrays(
                    [*batch.drop_columns(["text"]).columns, pa.array([k], pa.int64()), pa.array([text[at : at + size]], pa.string()),
                     pa.array([deal], pa.int64())], ["doc_id", "text_hash", "n_bytes", "chunk", "text", "deal"])
                deal += 1

    return run


def _chunk_maps(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = compiled(shared)
        for batch in sliced(batches, 16):
            maps = [counter.chunk_map(t) for t in batch.column("text").to_pylist()]
            columns = [pa.array([m[k] for m in maps], kind) for k, kind in enumerate((pa.string(), pa.int64(), pa.string()))]
            rest = batch.drop_columns(["text", "deal"])
            yield pa.RecordBatch.from_arrays([*rest.columns, *columns], [*rest.schema.names, "head", "inner", "tail"])

    return run


def _round(shared):
    """Composes neighbouring maps with the same `part`, which come in order; gives one map of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = compiled(shared)
        group, total = None, None
        names = ["doc_id", "text_hash", "n_bytes", "_n", "part"]

        def done() -> pa.RecordBatch:
            kinds = (*[pa.int64()] * 5, pa.string(), pa.int64(), pa.string())
            return pa.RecordBatch.from_arrays([pa.array([x], kind) for x, kind in zip((*group, *total), kinds, strict=True)],
                                              [*names[:-1], "chunk", "head", "inner", "tail"])

        for batch in sliced(batches, 256):
            columns = [batch.column(c).to_pylist() for c in (*names, "head", "inner", "tail")]
            for *key, head, inner, tail in zip(*columns, strict=True):
                if key != group:
                    if group is not None:
                        yield done()
                    group, total = key, (head, inner, tail)
                else:
                    total = counter.compose(total, (head, inner, tail))
        if group is not None:
            yield done()

    return run


def _values(shared, limit: int):
    """The counts of documents whose maps are composed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = compiled(shared)
        for batch in sliced(batches, 16):
            maps = zip(*[batch.column(c).to_pylist() for c in ("head", "inner", "tail")], strict=True)
            n = [counter.value(m) for m in maps]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in ("doc_id", "text_hash", "n_bytes", "_n")], pa.array(n, pa.int64()),
                 pa.array([k > limit for k in n], pa.bool_())], ["doc_id", "text_hash", "n_bytes", "_n", "n_tokens", "over_limit"])

    return run


def rounds(chunk: int, fan: int = FAN) -> int:
    """Rounds after which the maps of the longest text are one."""
    n, maps = 0, -(-LONGEST // chunk)
    while maps > 1:
        n, maps = n + 1, -(-maps // fan)
    return n


def count_tokens(docs: DataFrame, tokenizer_path: str, limit: int = LIMIT, chunk: int = CHUNK) -> DataFrame:
    """One row per document row: doc_id, n_bytes, n_tokens, over_limit (n_tokens > limit).

    The tokenizer's file is read on the driver and broadcast (its size does not depend on
    the data). Texts up to `chunk` characters are counted where they are read; longer ones
    are cut, dealt out by chunk and composed in rounds. Null and empty texts have no bytes and no
    tokens; null ids stay; repeated rows come out as often as they went in; an empty table
    gives no rows. Other columns are not read.
    """
    spark: SparkSession = docs.sparkSession
    with open(tokenizer_path, encoding="utf-8") as f:
        shared = spark.sparkContext.broadcast({"json": f.read()})
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    rows = rows.withColumn("n_bytes", F.octet_length("text").cast("long"))
    out = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
    short = rows.filter(F.char_length("text") <= chunk).mapInArrow(_maps(shared, limit), out)
    long_ = rows.filter(F.char_length("text") > chunk).withColumn("text_hash", F.xxhash64("text")).select(
        "doc_id", "text_hash", "n_bytes", "text").mapInArrow(
        _chunk_rows(chunk), "doc_id long, text_hash long, n_bytes long, chunk long, text string, deal long")
    maps = long_.repartition("doc_id", "text_hash", "chunk", "deal").mapInArrow(
        _chunk_maps(shared), "doc_id long, text_hash long, n_bytes long, chunk long, head string, inner long, tail string")
    # rows equal in id and text have equal maps: composed once, counted as _n
    key = ["doc_id", "text_hash", "n_bytes"]
    maps = maps.groupBy(*key, "chunk").agg(F.count("*").alias("_n"), F.any_value(F.struct("head", "inner", "tail")).alias("m"))
    maps = maps.select(*key, "_n", "chunk", "m.*")
    for _ in range(rounds(chunk)):
        parts = maps.withColumn("part", F.call_function("div", F.col("chunk"), F.lit(FAN)))
        maps = parts.repartition(*key, "part").sortWithinPartitions(*key, "chunk").mapInArrow(
            _round(shared), "doc_id long, text_hash long, n_bytes long, _n long, chunk long, head string, inner long, tail string")
    counts = maps.mapInArrow(_values(shared, limit), "doc_id long, text_hash long, n_bytes long, _n long, n_tokens long, over_limit boolean")
    counts = each_copy(counts, ["doc_id", "text_hash"], "_copy").select("doc_id", "n_bytes", "n_tokens", "over_limit")
    return short.unionByName(counts)
