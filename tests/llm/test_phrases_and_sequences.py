"""Collocations, fill-in-the-middle and packing against brute force, inverses and the library."""

import hashlib
import itertools
import json
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from hourglass.llm import collocations, fill_middle, packing

JSON = public_tokenizers.path("byte_bpe_50k.json")


# ------------------------------------------------------------------------ collocations

def brute_collocations(rows, least, top, longest=5, kept=100):
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = lang if lang is not None else "und"
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", low):
            words = [w for w in re.split("[ \t]", piece) if w]
            n[lang] += len(words)
            for m in range(1, longest + 1):
                f[lang].update(tuple(words[k : k + m]) for k in range(len(words) - m + 1))
    out = []
    for lang, counts in f.items():
        often = {p: c for p, c in counts.items() if c >= least}
        found = []
        for p, a in often.items():
            if len(p) < 2:
                continue
            longer = [q for q in often if len(q) > len(p) and any(q[k : k + len(p)] == p for k in range(len(q) - len(p) + 1))]
            if any(100 * often[q] >= kept * a for q in longer):
                continue
            score, _, l, r = min((1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), l, r))
        out += [(lang, rank, p.decode(), -a, l, r, n[lang], -s) for rank, (s, a, p, l, r) in enumerate(sorted(found)[:top], 1)]
    return sorted(out)


def odd_rows():
    rng = np.random.default_rng(5)
    words = ["the", "of", "Éa", "漢字", "a b", " x", "don't", "LONG" * 40, "\x1c"]
    rows = []
    for k in range(60):
        text = "".join(words[i] + gaps for i, gaps in zip(rng.integers(0, len(words), 80).tolist(), rng.choice([" ", "  ", "\t", ". ", ",", "\n", " \t "], 80, p=[.6, .1, .1, .05, .05, .05, .05]), strict=True))
        rows.append((text, ["en", None, "und", "fr"][k % 4]))
    return rows + [(None, "en"), ("", "en"), (" . ;", None), ("the of the of the of the", "en")] + [("Exactly the same row", "de")] * 7


def as_documents(spark, rows):
    df = spark.createDataFrame([(k, t, g) for k, (t, g) in enumerate(rows)], "doc_id long, text string, lang string")
    return df.withColumns({c: F.lit(1) for c in ("phrase", "n", "a", "_key", "rank")})


@pytest.mark.parametrize("kept", [100, 60])
@pytest.mark.parametrize("block", [collocations.BLOCK, 90])
def test_collocations_equal_brute_force(spark, monkeypatch, block, kept):
    monkeypatch.setattr(collocations, "BLOCK", block)
    rows = odd_rows()
    got = collocations.collocations(as_documents(spark, rows), top=15, least=3, kept=kept)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    want = brute_collocations(rows, 3, 15, kept=kept)
    assert sorted(map(tuple, got.collect())) == want and len({w[0] for w in want}) == 4


def test_a_long_text_is_cut_between_its_pieces(monkeypatch):
    monkeypatch.setattr(collocations, "BLOCK", 50)
    text = b"one two three, " * 40 + b"word " * 40 + b". end"
    parts = [*collocations._parts(text)]
    assert len(parts) > 5 and b"".join(parts) == text and all(p[:1] in (b",", b".") for p in parts[1:])


def test_collocation_scores_beyond_64_bits(spark):
    big = 4 * 10**12
    counts = spark.createDataFrame([("en", "x y", big)], "lang string, phrase string, n long")
    words = spark.createDataFrame([("en", "x", big + 1), ("en", "y", big + 3)], "lang string, phrase string, n long")
    total = spark.createDataFrame([("en", 10**13)], "lang string, total long")
    # 1000 * a * n is far beyond 64 bits
    import unittest.mock as mock

    with mock.patch.object(collocations, "phrase_counts", return_value=(total, [words, counts])):
        row = collocations.collocations(spark.range(0).withColumns({"text": F.lit("")})).collect()[0]
    assert row["score"] == 1000 * big * 10**13 // ((big + 1) * (big + 3)) and (row["l"], row["r"]) == (big + 1, big + 3)


def test_collocations_of_nothing(spark, documents, no_documents):
    assert collocations.collocations(no_documents).count() == 0
    assert collocations.collocations(documents, least=10**9).count() == 0
    rows = [(r["text"], r["lang"]) for r in documents.collect() if r["doc_id"] != 10]
    got = collocations.collocations(documents.filter("doc_id IS NULL OR doc_id <> 10"), least=2, top=50)
    assert sorted(map(tuple, got.collect())) == brute_collocations(rows, 2, 50)


# ------------------------------------------------------------------ fill in the middle

def brute_middle(doc_id, text):
    text = text or ""
    tokens = re.findall("[A-Za-z]+|[^A-Za-z]", text, re.S)
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[k : k + 8], 16) for k in (0, 8, 16, 24))
    lo, hi = sorted((h1 % (len(tokens) + 1), h2 % (len(tokens) + 1)))
    p, m, s = ("".join(x) for x in (tokens[:lo], tokens[lo:hi], tokens[hi:]))
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return len(tokens), "plain", None, None, text
    if h4 % 100 < 20:
        return len(tokens), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(tokens), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


TEXTS = st.text(st.sampled_from(list("ab Z<PSM>1\n\0") + ["é", "漢", " ", "😀", "\x85"]), max_size=40)


@settings(max_examples=400, deadline=None)
@given(st.one_of(st.none(), st.integers(-5, 10**6)), TEXTS)
def test_rearranged_text_equals_brute_force(doc_id, text):
    raw = text.encode()
    spans, form, n, prefix, middle = fill_middle.rearrange(raw, doc_id)
    output = b"".join(fill_middle.spelled(spans))
    assert (n, form, prefix, middle, output.decode()) == brute_middle(doc_id, text)
    assert b"".join(fill_middle.spelled(fill_middle.restored(output, form))) == raw
    assert fill_middle.checksum(spans) == hashlib.sha256(output).hexdigest()


@settings(max_examples=200, deadline=None)
@given(st.lists(st.binary(max_size=5), max_size=5), st.integers(-2, 30))
def test_cut_splits_what_the_descriptors_spell(buffers, at):
    spans = [s for b in buffers for s in fill_middle.whole(b)]
    left, right = fill_middle.cut(spans, at)
    text = b"".join(buffers)
    at = max(at, 0)
    assert b"".join(fill_middle.spelled(left)) == text[:at] and b"".join(fill_middle.spelled(right)) == text[at:]
    assert len(left) + len(right) <= len(spans) + 1


def test_fill_in_middle_table(spark, documents, no_documents):
    got = fill_middle.transform(documents)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    want = []
    for r in documents.collect():
        n, form, prefix, middle, output = brute_middle(r["doc_id"], r["text"])
        want.append((r["doc_id"], n, form, prefix, middle, sha(output), sha(r["text"] or ""), output))
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))
    assert {form for _, _, form, *_ in want} >= {"psm", "plain"}
    back = fill_middle.restore(got)
    assert sorted(map(repr, map(tuple, back.collect()))) == sorted(repr((r["doc_id"], r["text"] or "")) for r in documents.collect())
    assert fill_middle.transform(no_documents).count() == 0 and "output" not in fill_middle.transform(documents, texts=False).columns


# ----------------------------------------------------------------------------- packing

def brute_rooms(lengths, capacity):
    rooms = []
    for x in sorted(lengths, reverse=True):
        best = min((r for r in rooms if r >= x), default=None)
        if best is None:
            rooms.append(capacity - x)
        else:
            rooms[rooms.index(best)] = best - x
    return sorted(rooms)


@settings(max_examples=300, deadline=None)
@given(st.integers(1, 40).flatmap(lambda c: st.tuples(st.just(c), st.lists(st.integers(1, c), max_size=80))))
def test_runs_are_best_fit_decreasing(case):
    capacity, lengths = case
    runs = packing.best_fit_decreasing(Counter(lengths), capacity).tolist()
    held, numbers = defaultdict(list), defaultdict(list)
    for length, first, sequence, offset, n in runs:
        numbers[length] += range(first, first + n)
        for k in range(n):
            held[sequence + k].append((offset, length))
    assert {k: sorted(v) for k, v in numbers.items()} == {k: [*range(n)] for k, n in Counter(lengths).items()}
    for parts in held.values():
        ends = list(itertools.accumulate(x for _, x in sorted(parts)))
        assert [o for o, _ in sorted(parts)] == [0, *ends[:-1]] and ends[-1] <= capacity
    assert sorted(capacity - sum(x for _, x in v) for v in held.values()) == brute_rooms(lengths, capacity)


def test_the_plan_depends_on_the_capacity_not_on_the_rows():
    rng = np.random.default_rng(0)
    for rows in (10**4, 10**6):
        lengths = np.minimum(2048, rng.exponential(500, rows).astype(int) + 1)
        counts = {k: v for k, v in enumerate(np.bincount(lengths).tolist()) if v}
        few, many = packing.best_fit_decreasing(counts), packing.best_fit_decreasing({k: 1000 * v for k, v in counts.items()})
        assert len(many) < 60_000 and len(few) < 60_000 and many[:, 4].sum() == 1000 * rows


SAMPLES = ["", " ", "don't I'LL 'tis", "a  b   c \n\n d\t\te", "x<|endoftext|>y <|endoftext|><|endoftext|>", "  x   y　　", "漢字かな 한글 ١٢٣ ½ ⅷ", "\x1c\x1d a\x85\x85b", "😀👍🏽 é ‍", "a" * 3000, "!?" * 500, "\r\n\r\n", "﻿\0\0"]


def test_ids_equal_the_library():
    library, own = Tokenizer.from_file(JSON), packing.Encoder(open(JSON, encoding="utf-8").read())
    assert own.ranks is not None
    for text in SAMPLES:
        assert own(text) == library.encode(text, add_special_tokens=False).ids, text
    # every token of the vocabulary that is a text by itself
    tokens = [t.decode() for t in own.ranks if b"\xef\xbf\xbd" not in t and t.decode("utf-8", "ignore").encode() == t]
    for text, want in zip(tokens, library.encode_batch(tokens, add_special_tokens=False), strict=True):
        assert own(text) == want.ids, text
    # characters of every class between letters, digits, marks and themselves
    odd = [f"a{c}a 1{c}1 !{c}! {c}{c}  {c}" for c in map(chr, [*range(1, 0x3000), *range(0xA000, 0xD800, 7), *range(0xE000, 0x20000, 11)])]
    for text, want in zip(odd, library.encode_batch(odd, add_special_tokens=False), strict=True):
        assert own(text) == want.ids, text


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60))
def test_ids_of_any_text_equal_the_library(text):
    library, own = Tokenizer.from_file(JSON), test_ids_of_any_text_equal_the_library.own
    assert own(text) == library.encode(text, add_special_tokens=False).ids


test_ids_of_any_text_equal_the_library.own = packing.Encoder(open(JSON, encoding="utf-8").read())


def test_other_tokenizers_are_read_by_the_library():
    spec = json.load(open(JSON, encoding="utf-8"))
    spec["added_tokens"][0]["lstrip"] = True
    own = packing.Encoder(json.dumps(spec))
    assert own.ranks is None and own("a <|endoftext|>") == Tokenizer.from_str(json.dumps(spec)).encode("a <|endoftext|>").ids


def check_packing(rows, docs, capacity):
    library = Tokenizer.from_file(JSON)
    want = []
    for r in docs:
        ids = [*library.encode(r["text"] or "", add_special_tokens=False).ids, 0]
        first = len(ids) % capacity or capacity
        ends = [first + k * capacity for k in range((len(ids) - first) // capacity + 1)] if len(ids) > capacity else [len(ids)]
        for piece, (a, b) in enumerate(zip([0, *ends], ends)):
            want.append((r["doc_id"], piece, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    assert sorted(map(repr, want)) == sorted(repr((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"])) for r in rows)
    held = defaultdict(list)
    for r in rows:
        held[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in held.values():
        ends = list(itertools.accumulate(x for _, x in sorted(parts)))
        assert [o for o, _ in sorted(parts)] == [0, *ends[:-1]] and ends[-1] <= capacity
    assert sorted(capacity - sum(x for _, x in v) for v in held.values()) == brute_rooms([x[3] for x in want], capacity)


@pytest.mark.parametrize("bucket", [packing.BUCKET_ROWS, 5])
def test_packing_odd_rows(spark, monkeypatch, documents, no_documents, bucket):
    monkeypatch.setattr(packing, "BUCKET_ROWS", bucket)
    docs = documents.unionByName(documents.filter("doc_id = 2")).withColumn("piece", F.lit("clash")).withColumn("length", F.lit(-1))
    rows = packing.pack(docs, JSON, capacity=64).collect()
    check_packing(rows, docs.collect(), 64)
    again = packing.pack(docs.repartition(5), JSON, capacity=64).collect()
    assert sorted(map(repr, map(tuple, rows))) == sorted(map(repr, map(tuple, again)))
    assert packing.pack(no_documents, JSON).count() == 0


def test_packing_of_the_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    check_packing(packing.pack(docs, JSON).collect(), docs.collect(), 2048)


def test_sequences_hold_the_ids(spark, documents):
    library = Tokenizer.from_file(JSON)
    made = packing.sequences(documents, JSON, capacity=50).collect()
    where = packing.pack(documents, JSON, capacity=50).collect()
    assert {r["sequence_id"]: r["starts"] for r in made} == {s: sorted(r["offset"] for r in where if r["sequence_id"] == s) for s in {r["sequence_id"] for r in where}}
    by_id = {r["sequence_id"]: r["ids"] for r in made}
    whole = defaultdict(list)
    for r in sorted(where, key=lambda r: r["start"]):
        if r["doc_id"] is not None and r["doc_id"] not in (2,):
            whole[r["doc_id"]] += by_id[r["sequence_id"]][r["offset"] : r["offset"] + r["length"]]
    for r in documents.collect():
        if r["doc_id"] in whole:
            assert whole[r["doc_id"]] == [*library.encode(r["text"] or "", add_special_tokens=False).ids, 0]
