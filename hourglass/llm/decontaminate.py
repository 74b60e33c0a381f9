"""Benchmark decontamination: word windows of the items found anywhere in the documents.

A window is `n` consecutive words of an item, or the whole of a shorter item. All windows
are put, with their items, into a hash set. Of a document not every window is looked up but
every q-th gram: with g = ceil(L/2) and q = L-g+1, any L consecutive words hold exactly one
gram of g words at a position divisible by q among their first q starts. Each window is
therefore entered once per offset 0..q-1 under the hash of its gram there; a hit says where
in the document the window would start, and the words there are then compared one by one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourglass.llm.common import stored, words_of

#: words of a window
N = 10
#: The hash set is broadcast while its entries, words and item ids included, have at most so
#: many bytes; beyond, grams and entries are shuffled to each other. Results are the same.
BROADCAST_BYTES = 100_000_000


def _gram(length: int) -> tuple[int, int]:
    g = -(-length // 2)
    return g, length - g + 1


def benchmark_windows(benchmark: DataFrame, n: int = N) -> DataFrame:
    """Distinct windows: `window` (words), `len`, `items` (ids as strings, distinct).

    Items without words have no window; an item with a null id has windows but no name.
    """
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), words_of(F.col("text")).alias("w"))
    items = items.filter(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("w") - (n - 1)))
    # explode_outer, here and below: explode lets the optimizer add a filter on the array and
    # push it down, and with it a second and much slower evaluation of what makes the array
    windows = items.select("item", F.explode_outer(F.transform(starts, lambda i: F.slice(F.col("w"), i, n))).alias("window"))
    return windows.groupBy("window").agg(F.collect_set("item").alias("items")).withColumn("len", F.size("window"))


def _bytes(windows: DataFrame) -> int:
    """Bytes of all entries: each window, with its items, once per offset."""
    texts = F.octet_length(F.array_join("window", " ")) + F.octet_length(F.array_join("items", " "))
    places = 16 * (F.size("window") + F.size("items")) + 64  # offsets and lengths of an array's parts
    offsets = F.col("len") - F.ceil(F.col("len") / 2) + 1
    return windows.agg(F.sum((texts + places) * offsets).cast("long").alias("n")).collect()[0]["n"] or 0


def _entries(windows: DataFrame, lengths: list[int]) -> DataFrame:
    def of(length: int) -> Column:
        g, q = _gram(length)
        grams = F.transform(F.sequence(F.lit(0), F.lit(q - 1)), lambda o: F.struct(
            o.alias("offset"), F.xxhash64(F.lit(length), F.slice(F.col("window"), o + 1, g)).alias("gram")))
        return F.when(F.col("len") == length, grams)

    return windows.select("window", "len", "items", F.inline_outer(F.coalesce(*map(of, lengths))))


def _grams(words: Column, lengths: list[int]) -> Column:
    """For each length, the grams of a document at 0, q, 2q, ... as (at, len, gram)."""
    def of(length: int) -> Column:
        g, q = _gram(length)
        last = F.size(words) - g  # the last place a gram fits
        places = F.when(last >= 0, F.sequence(F.lit(0), F.greatest(last, F.lit(0)), F.lit(q))).otherwise(F.array().cast("array<int>"))
        return F.transform(places, lambda p: F.struct(
            p.alias("at"), F.lit(length).alias("len"), F.xxhash64(F.lit(length), F.slice(words, p + 1, g)).alias("gram")))

    return F.concat(*map(of, lengths))


def hits(docs: DataFrame, benchmark: DataFrame, keys: list[str], n: int = N) -> DataFrame:
    """Per group of rows equal in `keys` and text: `n_rows`, `n_words`, `spans` (start and
    length of every window found, words from 0, sorted, distinct) and `items`."""
    windows = stored(benchmark_windows(benchmark, n), "benchmark-windows")
    lengths = sorted(r[0] for r in windows.select("len").distinct().collect()) or [n]  # n values at most
    entries = _entries(windows, lengths)
    small = _bytes(windows) <= BROADCAST_BYTES
    e = (F.broadcast(entries) if small else entries).select(F.col("gram").alias("e_gram"), F.col("len").alias("e_len"), "offset", "window", "items")
    words = docs.select(*keys, F.xxhash64("text").alias("text_hash"), words_of(F.col("text")).alias("w"))
    # a first element without a gram stands for the row itself
    none = F.struct(F.lit(-1).alias("at"), F.lit(None).cast("int").alias("len"), F.lit(None).cast("long").alias("gram"))
    rows = words.select(*keys, "text_hash", "w", F.size("w").alias("n_words"),
                        F.concat(F.array(none), _grams(F.col("w"), lengths)).alias("grams"))
    looked = rows.select(*keys, "text_hash", "w", "n_words", F.explode_outer("grams").alias("g"))
    start = F.col("g.at") - F.col("offset")
    if not small:
        return _hits_by_shuffle(words, looked.drop("w").filter("g.at >= 0"), e, keys)
    found = looked.join(e, (F.col("g.gram") == F.col("e_gram")) & (F.col("g.len") == F.col("e_len"))
                        & (start >= 0) & (start + F.col("e_len") <= F.col("n_words"))
                        & (F.slice(F.col("w"), start + 1, F.col("e_len")) == F.col("window")), "left")
    found = found.filter((F.col("g.at") < 0) | F.col("window").isNotNull())
    span = F.when(F.col("window").isNotNull(), F.struct(start.alias("start"), F.col("e_len").alias("len")))
    return found.select(*keys, "text_hash", "n_words", (F.col("g.at") < 0).cast("int").alias("is_row"),
                        span.alias("span"), "items").groupBy(*keys, "text_hash").agg(
        F.sum("is_row").alias("n_rows"), F.first("n_words").cast("long").alias("n_words"),
        F.array_sort(F.collect_set("span")).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))


def _hits_by_shuffle(words: DataFrame, looked: DataFrame, e: DataFrame, keys: list[str]) -> DataFrame:
    """`hits` where the entries are too many to broadcast. Grams alone are shuffled to the
    entries; places that agree in the gram then meet the words of their document, which
    are shuffled once, and are compared word by word."""
    same = [*keys, "text_hash"]
    start = F.col("g.at") - F.col("offset")
    near = looked.join(e, (F.col("g.gram") == F.col("e_gram")) & (F.col("g.len") == F.col("e_len"))
                       & (start >= 0) & (start + F.col("e_len") <= F.col("n_words")))
    near = near.select(*[F.col(k).alias(f"_near_{k}") for k in same], F.struct(start.alias("start"), F.col("e_len").alias("len")).alias("span"),
                       "window", "items")
    on = [words[k].eqNullSafe(F.col(f"_near_{k}")) for k in same]
    found = words.join(near, on).filter(F.slice("w", F.col("span.start") + 1, F.col("span.len")) == F.col("window"))
    found = found.select(*same, "span", "items").groupBy(*same).agg(
        F.array_sort(F.collect_set("span")).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
    found = found.select(*[F.col(k).alias(f"_found_{k}") for k in same], F.col("spans").alias("_spans"), F.col("items").alias("_items"))
    rows = words.select(*same, F.size("w").alias("n_words")).groupBy(*same).agg(
        F.count("*").alias("n_rows"), F.first("n_words").cast("long").alias("n_words"))
    out = rows.join(found, [rows[k].eqNullSafe(F.col(f"_found_{k}")) for k in same], "left")
    none = F.array().cast("array<struct<start:int,len:int>>")
    return out.select(*same, "n_rows", "n_words", F.coalesce("_spans", none).alias("spans"),
                      F.coalesce("_items", F.array().cast("array<string>")).alias("items"))


def covered(spans: Column) -> Column:
    """Words that lie in any span; spans sorted by start."""
    first = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))

    def add(acc: Column, s: Column) -> Column:
        end = s["start"] + s["len"]
        return F.struct(F.greatest(acc["end"], end).alias("end"),
                        (acc["n"] + F.greatest(end - F.greatest(acc["end"], s["start"]), F.lit(0))).alias("n"))

    return F.aggregate(spans, first, add, lambda a: a["n"])


def contamination(docs: DataFrame, benchmark: DataFrame, n: int = N) -> DataFrame:
    """One row per document row: doc_id, n_words, n_hit (words inside any occurrence of a
    window), n_items, items_sha256, contaminated, and beyond the digest spans and items.

    Null or empty texts have no words and no hits; null ids are kept as they are. Rows
    equal in id and text come out as often as they went in. An empty benchmark hits
    nothing; an empty table gives no rows. Other columns are not read.
    """
    h = hits(docs.select("doc_id", "text"), benchmark, ["doc_id"], n)
    again = F.explode_outer(F.sequence(F.lit(1), F.col("n_rows").cast("int")))
    out = h.withColumn("n_hit", covered(F.col("spans"))).withColumn("_copy", again)
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                      (F.col("n_hit") > 0).alias("contaminated"), "spans", "items")


def clean_documents(docs: DataFrame, benchmark: DataFrame, n: int = N) -> DataFrame:
    """The documents none of whose words is hit, all columns as they were.

    Only the ids and text hashes of the hit documents are joined back; rows with a null id
    are matched like any other.
    """
    h = hits(docs.select("doc_id", "text"), benchmark, ["doc_id"], n).filter(F.size("spans") > 0)
    bad = h.select(F.col("doc_id").alias("_bad_id"), F.col("text_hash").alias("_bad_hash"))
    # rows travel as one struct, so that no column of theirs can clash with one made here
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.struct(*docs.columns).alias("row"))
    return rows.join(bad, rows["doc_id"].eqNullSafe(F.col("_bad_id")) & (rows["text_hash"] == F.col("_bad_hash")),
                     "left_anti").select("row.*")


def masked(docs: DataFrame, benchmark: DataFrame, n: int = N) -> DataFrame:
    """doc_id and clean_text: the words of each document (as matched: lower-cased, joined
    by a space) without those inside a span. Spans belong to a text: documents that share an
    id, or have none, lose the words of their own spans only."""
    h = hits(docs.select("doc_id", "text"), benchmark, ["doc_id"], n).filter(F.size("spans") > 0).select(
        F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), "spans")
    words = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), words_of(F.col("text")).alias("w"))
    spans = F.coalesce(F.col("spans"), F.array().cast("array<struct<start:int,len:int>>"))
    hit = F.flatten(F.transform(spans, lambda s: F.sequence(s["start"], s["start"] + s["len"] - 1)))
    places = F.when(F.size("w") > 0, F.array_except(F.sequence(F.lit(0), F.greatest(F.size("w") - 1, F.lit(0))), hit))
    kept = F.transform(F.coalesce(places, F.array().cast("array<int>")), lambda i: F.get("w", i))
    same = words["doc_id"].eqNullSafe(F.col("_id")) & (words["text_hash"] == F.col("_hash"))
    return words.join(h, same, "left").select("doc_id", F.array_join(kept, " ").alias("clean_text"))
