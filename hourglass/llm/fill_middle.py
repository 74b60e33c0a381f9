"""Fill-in-the-middle rearrangement on a piece table.

A document is a list of descriptors (buffer, start, end) over immutable buffers: its own
text and the three sentinels. Cutting splits descriptors, an arrangement permutes the parts
and puts sentinel descriptors between them, and the inverse permutation brings them back.
No step copies text; checksums stream over what the descriptors name, and a text is put
together only where a caller asks for it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourglass.llm.common import sliced

#: fixed values: the sentinels, and the order in which each form has them and the parts
#: (0 prefix, 1 middle, 2 suffix)
SENTINELS = {"P": b"<P>", "S": b"<S>", "M": b"<M>"}
FORMS = {"psm": (("P", "S", "M"), (0, 2, 1)), "spm": (("S", "P", "M"), (2, 0, 1))}
#: of 100 documents those that are rearranged, and of 100 rearranged those in form spm
REARRANGED, SUFFIX_FIRST = 90, 20
#: rows that a worker turns at a time
BATCH = 256

#: buffer, first byte, byte after the last
Span = tuple[object, int, int]


def whole(buffer) -> list[Span]:
    return [(buffer, 0, len(buffer))] if len(buffer) else []


def cut(spans: Sequence[Span], at: int) -> tuple[list[Span], list[Span]]:
    """Both sides of byte `at` of what the descriptors spell; at most one is split."""
    left, right = [], []
    for buffer, start, end in spans:
        here = min(max(at, 0), end - start)
        at -= end - start
        if here:
            left.append((buffer, start, start + here))
        if start + here < end:
            right.append((buffer, start + here, end))
    return left, right


def arranged(parts: Sequence[Sequence[Span]], form: str) -> list[Span]:
    """The parts in the form's order, each behind its sentinel."""
    marks, order = FORMS[form]
    out: list[Span] = []
    for mark, part in zip(marks, order, strict=True):
        out += whole(SENTINELS[mark])
        out += parts[part]
    return out


def restored(output: bytes, form: str) -> list[Span]:
    """Descriptors over `output` that spell the text it was made of.

    A text with a sentinel in it is never rearranged, and sentinels have one `<` each, in
    front; so each sentinel is found at the one place where it was put."""
    if form == "plain":
        return whole(output)
    marks, order = FORMS[form]
    places, after = [], 0
    for mark in marks:
        place = output.index(SENTINELS[mark], after)
        after = place + len(SENTINELS[mark])
        places.append((place, after))
    ends = [place for place, _ in places[1:]] + [len(output)]
    parts: list[list[Span]] = [[], [], []]
    for part, (_, start), end in zip(order, places, ends, strict=True):
        parts[part] = [(output, start, end)] if start < end else []
    return [span for part in parts for span in part]


def spelled(spans: Sequence[Span]) -> Iterator[memoryview]:
    for buffer, start, end in spans:
        yield memoryview(buffer)[start:end]


def checksum(spans: Sequence[Span]) -> str:
    out = hashlib.sha256()
    for view in spelled(spans):
        out.update(view)
    return out.hexdigest()


def units(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """First bytes of the units (a run of ASCII letters, or any one other code point), and
    for each byte whether a code point starts there."""
    data = np.frombuffer(text, np.uint8)
    letter = ((data | 0x20) - np.uint8(97)) < 26
    point = (data & 0xC0) != 0x80
    starts = point.copy()
    starts[1:] &= ~(letter[1:] & letter[:-1])
    return np.flatnonzero(starts), point


def draws(doc_id: int | None, seed: int) -> tuple[int, int, int, int]:
    """Four unsigned 32-bit numbers of a document; a null id counts as no digits."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return tuple(int.from_bytes(digest[k : k + 4], "big") for k in (0, 4, 8, 12))


def choose(text: bytes, doc_id: int | None, seed: int, rearranged: int, suffix_first: int) -> str:
    *_, h3, h4 = draws(doc_id, seed)
    if not text or h3 % 100 >= rearranged or any(mark in text for mark in SENTINELS.values()):
        return "plain"
    return "spm" if h4 % 100 < suffix_first else "psm"


def rearrange(text: bytes, doc_id: int | None, seed: int = 1, rearranged: int = REARRANGED,
              suffix_first: int = SUFFIX_FIRST) -> tuple[list[Span], str, int, int | None, int | None]:
    """Descriptors of the output, its form, units, and code points of prefix and middle."""
    starts, point = units(text)
    n, form = len(starts), choose(text, doc_id, seed, rearranged, suffix_first)
    if form == "plain":
        return whole(text), form, n, None, None
    h1, h2, *_ = draws(doc_id, seed)
    first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, b = (int(starts[k]) if k < n else len(text) for k in (first, second))
    prefix, rest = cut(whole(text), a)
    middle, suffix = cut(rest, b - a)
    chars = (int(np.count_nonzero(point[:a])), int(np.count_nonzero(point[a:b])))
    return arranged((prefix, middle, suffix), form), form, n, *chars


def _run(seed: int, rearranged: int, suffix_first: int, texts: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, BATCH):
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist(), strict=True):
                text = text or b""
                spans, form, n, prefix, middle = rearrange(text, doc_id, seed, rearranged, suffix_first)
                output = text if form == "plain" else b"".join(spelled(spans))
                rows.append((doc_id, n, form, prefix, middle, checksum(spans), checksum(restored(output, form)), *([output] if texts else [])))
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), *([pa.binary()] if texts else [])]
            names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256", *(["output"] if texts else [])]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names)

    return run


def transform(docs: DataFrame, seed: int = 1, rearranged: int = REARRANGED, suffix_first: int = SUFFIX_FIRST,
              texts: bool = True) -> DataFrame:
    """One row per row of `docs`: doc_id, n (units), form (plain, psm or spm), prefix_chars,
    middle_chars (code points, null if plain), the SHA-256 of the output and of the text
    rebuilt from output and form, and with `texts` the output itself.

    Where a document is cut depends on its id, the seed and its number of units only. Null
    text counts as empty; an empty text and one that holds a sentinel stay plain. A null id
    draws from the seed alone. Repeated rows are separate rows with equal results. A text is
    read whole, however long. An empty table gives no rows. Other columns are not read.
    """
    schema = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string"
    made = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text")).mapInArrow(
        _run(seed, rearranged, suffix_first, texts), schema + (", output binary" if texts else ""))
    return made.withColumn("output", F.col("output").cast("string")) if texts else made


def restore(outputs: DataFrame) -> DataFrame:
    """doc_id and text of the rows of `outputs` (doc_id, form, output): the inverse."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, BATCH):
            forms, found = batch.column("form").to_pylist(), batch.column("output").cast(pa.binary()).to_pylist()
            texts = [b"".join(spelled(restored(output or b"", form))) for output, form in zip(found, forms, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.binary())], ["doc_id", "text"])

    return outputs.select(F.col("doc_id").cast("long").alias("doc_id"), "form", "output").mapInArrow(
        run, "doc_id long, text binary").withColumn("text", F.col("text").cast("string"))
