"""Near duplicates, decontamination and top-k against brute force."""

import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from hourglass.llm import decontaminate, near_dedup, topk

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def word_set(text, n):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", (text or "").translate(LOWER)) if x]
    return frozenset(tuple(w[k : k + n]) for k in range(max(len(w) - n + 1, 1))) if w else frozenset()


def brute_components(rows, n, num, den):
    sets = [(i, word_set(t, n)) for i, t in rows]
    root = [*range(len(sets))]

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and den * len(x & y) >= num * len(x | y):
                root[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(sets):
        if i is not None:
            least[find(k)] = min(least.get(find(k), i), i)
    return {(i, s): (len(s), least.get(find(k))) for k, (i, s) in enumerate(sets)}


def check_components(docs, n, num, den, **more):
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    want = sorted(((i, *v) for (i, _), v in brute_components(rows, n, num, den).items()), key=str)
    out = near_dedup.near_duplicates(docs, n, (num, den), **more).collect()
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in out), key=str) == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in out)


def test_near_duplicates_on_odd_rows(documents, no_documents):
    check_components(documents, 3, 85, 100)
    check_components(documents, 5, 8, 10)
    assert near_dedup.near_duplicates(no_documents).count() == 0


@pytest.mark.parametrize("block", [1_000_000, 300])  # one block, and pairs of many
def test_near_duplicates_of_chains_of_edits(spark, block):
    rng = np.random.default_rng(5)
    rows = []
    for group in range(6):
        text = [f"w{x}" for x in rng.integers(0, 5000, 120)]
        for step in range(12):  # each a few edits from the last: ends of a chain are far apart
            rows.append((group * 100 + step, " ".join(text)))
            for _ in range(rng.integers(1, 4)):
                text[rng.integers(0, len(text))] = f"e{rng.integers(0, 10**6)}"
    check_components(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85, 100, block_shingles=block)


def test_one_document_of_each_group_stays(documents):
    kept = near_dedup.distinct_documents(documents, words=3, similarity=(85, 100))
    assert kept.columns == documents.columns
    ids = sorted((r["doc_id"] for r in kept.collect()), key=str)
    out = near_dedup.near_duplicates(documents, 3, (85, 100)).filter("kept").collect()
    assert ids == sorted({r["doc_id"] for r in out}, key=str)


def test_unlinked_documents_stay_without_ids_or_with_a_shared_one(spark):
    a, b, c = (" ".join(f"{x}{k}" for k in range(30)) for x in "abc")
    rows = [(None, a), (None, a), (None, b), (None, b + " end"), (None, None), (None, ""), (7, a + " tail"), (8, b), (8, c), (9, " ")]
    kept = near_dedup.distinct_documents(spark.createDataFrame(rows, "doc_id long, text string"))
    got = [(r["doc_id"], r["text"]) for r in kept.collect()]
    assert {x for x in got if (x[1] or "").strip()} == {(7, a + " tail"), (8, b), (8, c)}
    assert sorted(str(i) for i, t in got if not (t or "").strip()) == ["9", "None"] and len(got) == 5
    nameless = near_dedup.distinct_documents(spark.createDataFrame([(None, a), (None, b), (None, c)], "doc_id long, text string"))
    assert sorted(r["text"] for r in nameless.collect()) == [a, b, c]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=50, max_size=50), st.integers(0, 19), st.randoms())
def test_index_guarantee(values, distance, random):
    """Signatures within the guaranteed distance share a key."""
    a = np.array(values, np.uint16)
    b = a.copy()
    for place in random.sample(range(50), distance):
        b[place] += 7
    assert set(near_dedup.keys(a)) & set(near_dedup.keys(b))


def brute_hits(text, items, n=10):
    w = WORD.findall((text or "").translate(LOWER))
    hit, ids = set(), set()
    for item, t in items:
        iw = WORD.findall((t or "").translate(LOWER))
        size = min(n, len(iw))
        for s in range(len(iw) - size + 1) if iw else ():
            for p in range(len(w) - size + 1):
                if w[p : p + size] == iw[s : s + size]:
                    hit.update(range(p, p + size))
                    ids.add(item)
    names = sorted(str(i) for i in ids if i is not None)
    return len(w), len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), bool(hit)


@pytest.mark.parametrize("entries", [decontaminate.BROADCAST_BYTES, 0])
def test_decontamination(spark, documents, no_documents, entries, monkeypatch):
    monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", entries)
    items = [(1, "Three, four five six seven eight nine ten eleven twelve!"), (2, "don t"), (3, ""), (4, None), (None, "word"),
             (10, "long words long words long words long words long words long"), (12, "six seven eight nine ten eleven twelve thirteen fourteen tail tail")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    out = decontaminate.contamination(documents, bench).collect()
    got = sorted([(r["doc_id"], r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) for r in out], key=str)
    short = [(r["doc_id"], r["text"]) for r in documents.collect()]
    assert got == sorted(((i, *brute_hits(t if i != 10 else "long words " * 30, items)) if i != 10 else (i, 60_000, 60_000, 1, hashlib.sha256(b"10").hexdigest(), True) for i, t in short), key=str)
    bad = {r["doc_id"] for r in out if r["contaminated"]}
    clean = decontaminate.clean_documents(documents, bench)
    assert clean.columns == documents.columns
    assert sorted((r["doc_id"] for r in clean.collect()), key=str) == sorted((i for i, _ in short if i not in bad), key=str)
    assert decontaminate.contamination(no_documents, bench).count() == 0
    assert decontaminate.contamination(documents, bench.filter("false")).filter("contaminated").count() == 0
    text = {r["doc_id"]: r["clean_text"] for r in decontaminate.masked(documents, bench).collect()}
    assert text[1] == "one two thirteen fourteen" and text[8] == ""


def test_masked_words_are_those_of_the_text(spark):
    bench = spark.createDataFrame([(1, "one two three")], "item_id long, text string")
    docs = spark.createDataFrame([(None, "one two three four five"), (None, "a b one c d"), (7, "x one two three"), (7, "one two x y z"),
                                  (7, "x one two three")], "doc_id long, text string")
    got = sorted((str(r["doc_id"]), r["clean_text"]) for r in decontaminate.masked(docs, bench).collect())
    assert got == [("7", "one two x y z"), ("7", "x"), ("7", "x"), ("None", "a b one c d"), ("None", "four five")]


def test_the_broadcast_is_bounded_by_bytes(spark):
    words = " ".join(f"w{k}" for k in range(10))
    few = decontaminate.benchmark_windows(spark.createDataFrame([(1, words)], "item_id long, text string"))
    # one window that very many items hold is one window, and large
    many = decontaminate.benchmark_windows(spark.range(20_000).select(F.col("id").alias("item_id"), F.lit(words).alias("text")))
    assert few.count() == many.count() == 1
    assert decontaminate._bytes(few) < 2_000 and decontaminate._bytes(many) > 20_000 * 20 * 6
    assert decontaminate._bytes(few.filter("false")) == 0


def test_top_k(spark):
    rng = np.random.default_rng(3)
    rows = [(int(i), [float(x) for x in rng.normal(size=8)]) for i in range(0, 900, 3)]
    rows += [(3, rows[1][1]), (3, rows[7][1]), (300, rows[4][1]), (300, rows[4][1]), (5, None), (7, [1.0, None]), (400, [float("nan")] * 8), (11, [float("inf")] * 8), (None, [1.0] * 8),
             (13, []), (500, []), (17, [1.0, 2.0]), (1000, [0.5, 0.5]), (1001, rows[0][1]), (1002, rows[0][1])]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, rank int")
    whole = [(i, [int(np.floor(1024 * x)) for x in v]) for i, v in rows
             if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    want = []
    for at, (q, a) in enumerate(whole):
        if q % 100 == 0:
            scores = sorted((-sum(x * y for x, y in zip(a, b, strict=True)), i) for k, (i, b) in enumerate(whole) if k != at and len(a) == len(b))
            want += [(q, r, i, -s) for r, (s, i) in enumerate(scores[:10], 1)]
    for sizes in ({}, {"block": 50, "query_block": 2, "pivots": 3}):
        got = [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in topk.top_k(df, **sizes).collect()]
        assert sorted(got) == sorted(want)
    assert topk.top_k(df.filter("false")).count() == 0


def test_bounds_leave_candidates_out():
    rng = np.random.default_rng(4)
    centre = rng.normal(size=(20, 16)) * 900
    v = np.floor(np.repeat(centre, 100, 0) + rng.normal(size=(2000, 16)) * 30).astype(np.int64)
    p = topk.choose_pivots(v[::7].astype(float), 24)
    far = np.sqrt(((v[:, None].astype(float) - p[None]) ** 2).sum(2))
    ids, square = np.arange(2000), (v.astype(float) ** 2).sum(1)
    found, scores, scored = topk.search(0, v[0], far[0], ids, v, far, square, 10)
    want = np.lexsort((ids[1:], -(v[1:] @ v[0])))[:10] + 1
    assert found.tolist() == want.tolist() and scored < 1000


def test_scores_beyond_doubles():
    a = np.array([[2**30, 2**30 + 1], [-(2**30), 5]])
    assert topk.exact(a, np.array([2**30 + 3, 7])).tolist() == [2**30 * (2**30 + 3) + 7 * (2**30 + 1), -(2**30) * (2**30 + 3) + 35]
