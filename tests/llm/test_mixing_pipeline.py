"""Source mixing and the pipeline against plain re-computations."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from hourglass.llm import mixing, sharding


def plain_targets(size, weights=(1, 2, 3), most=3):
    order = sorted(size, key=lambda s: (s is None, s.encode() if s else b""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    total, cut = sum(size.values()), {}
    while True:
        rest = [s for s in order if s not in cut]
        level = (total - sum(cut.values())) / sum(weight[s] for s in rest) if rest else 0
        over = [s for s in rest if level * weight[s] > most * size[s]]
        if not over:
            return cut | {s: level * weight[s] for s in rest}
        cut |= {s: most * size[s] for s in over}


@pytest.mark.parametrize("sizes", [{"a": 100, "b": 50, "c": 7, "é": 9, None: 1}, {"a": 5}, {"x": 0, "y": 10}, {None: 3, "B": 3, "a": 1, "C": 90}])
def test_targets(spark, sizes):
    df = spark.createDataFrame([(s, 1) for s, n in sizes.items() for _ in range(n)] + [(s, 0) for s in sizes], "source string, size long")
    got = {r["source"]: r["target"] for r in mixing.targets(df).collect()}
    assert got == pytest.approx(plain_targets(sizes))


def test_flight_keeps_both_totals():
    rng = np.random.default_rng(1)
    size, x = rng.integers(0, 500, 3000), rng.random(3000)
    out = mixing.flight(size, x, np.random.default_rng(2))
    assert ((out > 0) & (out < 1)).sum() <= 2 and out.min() >= 0 and out.max() <= 1
    assert abs((out * size).sum() - (x * size).sum()) < 1e-3 and abs(out.sum() - x.sum()) < 1e-5
    done = mixing.landing(size, out)
    assert set(done) <= {0.0, 1.0} and abs((done * size).sum() - (x * size).sum()) <= 500


def test_flight_keeps_probabilities():
    size = np.array([3, 3, 5, 9, 2, 7, 7, 1])
    x = np.array([0.1, 0.9, 0.5, 0.3, 0.7, 0.2, 0.6, 0.4])
    mean = np.mean([mixing.flight(size, x, np.random.default_rng(k)) for k in range(4000)], axis=0)
    assert np.abs(mean - x).max() < 0.04


@pytest.mark.parametrize("block", [mixing.BLOCK_ROWS, 20])
def test_mix(spark, sf_dir, block):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = mixing.mix(docs, block_rows=block).collect()
    own = {r["doc_id"]: (r["source"], len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or ""))) for r in docs.collect()}
    size, taken, largest = Counter(), Counter(), defaultdict(int)
    for s, n in own.values():
        size[s] += n
        largest[s] = max(largest[s], n)
    target = plain_targets(size)
    assert len(out) == len(own)
    for r in out:
        s, n = own[r["doc_id"]]
        assert (r["size"], r["source_size"]) == (n, size[s]) and r["target"] == pytest.approx(target[s])
        assert 0 <= r["taken"] <= 3 * n and r["taken"] == n * r["copies"]
        taken[s] += r["taken"]
    for s in size:
        assert abs(taken[s] - target[s]) <= largest[s]
    assert sorted(map(str, out)) == sorted(map(str, mixing.mix(docs.repartition(3), block_rows=block).collect()))


def test_equal_rows_are_split(spark):
    from pyspark.sql import functions as F

    docs = spark.range(9000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("a b c").alias("text"), F.lit("s").alias("source"))
    docs = docs.unionByName(docs.limit(100).withColumn("source", F.lit("t")))
    out = mixing.mix(docs, block_rows=500)
    assert out.groupBy("source").count().collect() and out.count() == 9100
    rows = docs.select("doc_id", "source", F.lit(3).alias("size"), F.xxhash64("text").alias("text_hash"))
    single = mixing.each_copy(mixing.counted_copies(rows), rows.columns, "copy").withColumn("x", F.lit(0.5))
    blocks = mixing._dealt(single, 0, 500).filter("source = 's'").groupBy("block").count().collect()
    assert len(blocks) == 18 and {r["count"] for r in blocks} == {500}
    made = single.groupBy("source", F.floor(F.col("copy") / 4000)).agg(F.countDistinct("copy").alias("n")).collect()
    assert sorted(r["n"] for r in made) == [100, 1000, 4000, 4000]
    numbers, n = sharding.numbered(rows, ["doc_id", "source", "size"])
    assert n == 9100 and sorted(r[0] for r in numbers.select("row_number").collect()) == [*range(n)]


def test_mix_on_odd_rows(documents, no_documents):
    out = mixing.mix(documents).collect()
    assert len(out) == documents.count() and sum(r["size"] == 0 for r in out) == 3
    assert mixing.mix(no_documents).count() == 0
    mixed = mixing.mixed_documents(documents)
    assert mixed.columns == documents.columns
    assert mixed.count() == sum(r["copies"] for r in out)
    assert Counter(r["doc_id"] for r in mixed.collect()) == Counter({i: n for i, n in sum(
        (Counter({r["doc_id"]: r["copies"]}) for r in out), Counter()).items() if n})


def test_equal_rows_share_their_copies(spark):
    """Rows equal in id, text and source, some alike in all columns: each comes out as often as
    any other or once more, the same ones however the table is dealt over partitions."""
    import collections

    rows = [(None, None, None, k % 7) for k in range(50)] + [(1, "a b c", "s", k) for k in range(40)] + [(2, "a b c", "s", 0), (3, "x y", "t", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, _own int")
    taken = collections.Counter()
    for r in mixing.mix(docs).collect():
        taken[r["doc_id"], r["source"]] += r["copies"]
    seen = []
    for parts in (1, 7):
        mixed = mixing.mixed_documents(docs.repartition(parts))
        assert mixed.columns == docs.columns
        seen.append(collections.Counter(tuple(r) for r in mixed.collect()))
    assert seen[0] == seen[1] and set(seen[0]) <= set(rows)
    came = collections.Counter((r[0], r[2]) for r in seen[0].elements())
    assert came == +taken
    each = [seen[0][1, "a b c", "s", k] for k in range(40)]
    assert max(each) - min(each) <= 1 and sum(each) == taken[1, "s"]


def test_pipeline(spark, sf_dir):
    import corpus_pipeline
    from test_pairs import brute_components, brute_hits

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").cache()
    bench = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "near_dedup", "decontamination", "mixing", "sharding"]
    kept = {}
    now = docs
    for name, stage in corpus_pipeline.STAGES:
        before = now
        now = stage(spark, before, sf_dir).cache()
        kept[name] = now
        if name != "sharding":
            assert now.schema.names == docs.schema.names
        if name == "near_dedup":
            want = {v[1] for v in brute_components([(r["doc_id"], r["text"]) for r in before.collect()], 5, 8, 10).values()}
            blank = {r["doc_id"] for r in before.collect() if not (r["text"] or "").split()}
            assert {r["doc_id"] for r in now.collect()} == want | blank
        if name == "decontamination":
            assert {r["doc_id"] for r in now.collect()} == {r["doc_id"] for r in before.collect() if not brute_hits(r["text"], bench)[1]}
    result = corpus_pipeline.run(spark, sf_dir)
    assert sorted(map(str, result.collect())) == sorted(map(str, now.collect()))
    assert result.count() == kept["mixing"].count()
    assert sharding.shard(kept["mixing"]).count() == result.count()


def test_pipeline_on_odd_rows(spark, documents, tmp_path):
    import corpus_pipeline

    labels = [(k, 1, 0) for k in range(1, 13)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "word of a benchmark that is not there")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for rows in (documents, documents.filter("false")):
        now = rows
        for _, stage in corpus_pipeline.STAGES:
            before, now = now, stage(spark, now, str(tmp_path))
        own = {"size", "text_crc32", "law", "shard", "slot", "grown_shard"}
        kept = [c for c in rows.columns if c not in own]
        assert now.columns[: len(kept)] == kept and set(now.columns[len(kept) :]) == own
        told = lambda df: Counter(str([r[c] for c in kept]) for r in df.collect())
        assert told(now) == told(before) and set(told(now)) <= set(told(rows))
