"""Reproducible shuffle and sharding by a Feistel permutation of global row numbers.

Rows are numbered 0..N-1 in an order that only depends on their contents; a keyed Feistel
network permutes the numbers; the permuted number gives shard and slot by a division. So
anybody can compute where row number n lies, and which row lies in a slot (`row_at`),
without reading the data.

The network works on pairs (l, r) of 0..a-1 x 0..b-1 with a = ceil(sqrt(N)) and
b = ceil(N/a): rounds add a hash of one half to the other half modulo its size, which is a
bijection. Fewer than a of the a*b numbers lie beyond N; a walk that lands there goes on
along its cycle until it is back below N. Such a walk has at most a*b-N+1 < a+1 steps.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourglass.llm.common import counted_copies, each_copy

ROUNDS = 6
#: rows that one numbering bucket holds on average
BUCKET_ROWS = 50_000
#: steps of a cycle walk: exact up to a = 64; beyond, a step lands outside with a chance
#: under 1/64, and a walk still outside after as many steps raises instead of guessing
WALK = 64


def grid(n: int) -> tuple[int, int]:
    a = max(1, math.isqrt(max(n - 1, 0)) + 1)
    return a, max(1, -(-n // a))


def _network(x: Column, n: int, seed: int, inverse: bool = False) -> Column:
    a, b = grid(n)
    pair = F.struct(F.call_function("div", x, F.lit(b)).alias("l"), F.pmod(x, F.lit(b)).cast("long").alias("r"))

    def turn(p: Column, step: Column) -> Column:
        sign = F.lit(-1 if inverse else 1)
        l, r = p["l"], p["r"]
        moved_l = F.pmod(l + sign * F.pmod(F.xxhash64(r, F.lit(seed), step), F.lit(a)), F.lit(a))
        moved_r = F.pmod(r + sign * F.pmod(F.xxhash64(l, F.lit(seed), step), F.lit(b)), F.lit(b))
        even = F.pmod(step, F.lit(2)) == 0
        return F.struct(F.when(even, moved_l).otherwise(l).alias("l"), F.when(even, r).otherwise(moved_r).alias("r"))

    steps = [*range(ROUNDS)][:: -1 if inverse else 1]
    return F.aggregate(F.array(*map(F.lit, steps)), pair, turn, lambda p: p["l"] * F.lit(b) + p["r"])


def permuted(x: Column, n: int, seed: int = 0, inverse: bool = False) -> Column:
    """The place of row number `x` (0 <= x < n) in the shuffle; `inverse` gives x back."""
    walk = F.array_repeat(F.lit(0), min(WALK, grid(n)[0]))
    first = _network(x, n, seed, inverse)
    end = F.aggregate(walk, first, lambda y, _: F.when(y < n, y).otherwise(_network(y, n, seed, inverse)))
    return F.when(end < n, end).otherwise(F.raise_error(F.lit("the cycle walk did not end")).cast("long"))


def row_at(shard: Column, slot: Column, n: int, shards: int, seed: int = 0) -> Column:
    """The global row number that lies in this slot of this shard."""
    return permuted(slot * F.lit(shards) + shard, n, seed, inverse=True)


def numbered(df: DataFrame, keys: list[str], number: str = "row_number") -> tuple[DataFrame, int]:
    """The `keys` of every row with global row numbers 0..N-1, and N.

    Order: by hash bucket of `keys`, then by `keys`. Rows that agree in all keys take
    neighbouring numbers; they are counted first, so that a bucket sorts distinct keys only.
    Only the bucket counts are summed up in one place.
    """
    n = df.count()
    buckets = max(1, -(-n // BUCKET_ROWS))
    dealt = counted_copies(df.select(*keys)).withColumn("_bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy("_bucket").agg(F.sum("_n").alias("_rows")).select(
        F.col("_bucket").alias("_at"), F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    within = Window.partitionBy("_bucket").orderBy(*[F.col(k).asc_nulls_first() for k in keys]).rowsBetween(Window.unboundedPreceding, -1)
    out = dealt.withColumn("_place", F.coalesce(F.sum("_n").over(within), F.lit(0))).join(
        starts, F.col("_bucket") == F.col("_at"))
    out = each_copy(out, keys, "_copy")
    return out.withColumn(number, F.col("_start") + F.col("_place") + F.col("_copy")).drop(
        "_bucket", "_at", "_start", "_place", "_copy"), n


def _sized(docs: DataFrame) -> list[Column]:
    text = F.coalesce(F.col("text"), F.lit(""))
    return [F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 16).cast("long").alias("size"),
            F.crc32(text).alias("text_crc32")]


def _placed(rows: DataFrame, keys: list[str], shards: int, seed: int) -> DataFrame:
    out, n = numbered(rows, keys)
    return out.withColumn("_to", permuted(F.col("row_number"), max(n, 1), seed)).select(
        *keys, F.lit("rows").alias("law"),
        F.pmod(F.col("_to"), F.lit(shards)).cast("int").alias("shard"),
        F.call_function("div", F.col("_to"), F.lit(shards)).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))


def shard(docs: DataFrame, shards: int = 40, seed: int = 0) -> DataFrame:
    """Deals all rows into `shards` shards whose row counts are at most one apart.

    Returns doc_id, size (UTF-8 bytes of the text plus 16), text_crc32, law ("rows"), shard,
    slot (0.. without gaps in each shard) and grown_shard (null: the law is not "key").

    Null text counts as no bytes, like an empty one. Null ids are rows like any other.
    Repeated rows are separate rows with slots of their own; which of two rows equal in
    id, size and checksum gets which slot cannot be told apart. An empty table gives no
    rows. Other columns are not read.
    """
    return _placed(docs.select(*_sized(docs)), ["doc_id", "size", "text_crc32"], shards, seed)


def row_digest(docs: DataFrame) -> Column:
    """A 256-bit digest of all columns of a row; strings and binaries enter by their bytes."""
    plain = [f.name for f in docs.schema.fields if f.dataType.typeName() in ("string", "binary")]
    rest = [c for c in docs.columns if c not in plain]
    parts = [F.coalesce(F.sha2(F.col(f"`{c}`").cast("binary"), 256), F.lit("-")) for c in plain]
    if rest:
        parts.append(F.to_json(F.struct(*[F.col(f"`{c}`") for c in rest])))
    return F.sha2(F.concat_ws("|", *parts), 256)


def sharded_documents(docs: DataFrame, shards: int = 40, seed: int = 0) -> DataFrame:
    """The rows of `docs` themselves, dealt by the same law: all their columns, then size,
    text_crc32, law, shard, slot and grown_shard, which take the place of columns of the
    same names in `docs`.

    Narrow rows (id, size, checksum and a digest of the whole row) are numbered; each number
    then meets its row by the digest. Rows equal in all columns are kept once until they meet
    their numbers, so that the join moves each distinct text once whatever its copies, and
    Spark's skew join splits the numbers of a row that came very often. Nulls, repeated rows
    and empty tables: as in `shard`.
    """
    own = ["size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    digest = row_digest(docs).alias("_digest")
    places = _placed(docs.select(*_sized(docs), digest), ["doc_id", "size", "text_crc32", "_digest"], shards, seed)
    distinct = docs.select(digest, F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")).groupBy(
        "_digest").agg(F.any_value("_row").alias("_row"))
    kept = [F.col("_row").getField(c).alias(c) for c in docs.columns if c not in own]
    return places.select("_digest", *own).join(distinct, "_digest").select(*kept, *own)
