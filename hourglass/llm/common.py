"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourglass.sources.staging import Staging

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: everything that is neither an ASCII digit, a lower-case ASCII letter nor beyond ASCII
WORD_BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: a run of anything but ASCII white space
SPACED_WORD = r"[^\x20\x09-\x0D]+"
#: the same class of bytes: beyond ASCII every byte of a UTF-8 character is 0x80 or more
WORD_BYTES = rb"[0-9a-z\x80-\xff]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z and nothing else. `lower` does just that on pure ASCII, and faster."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, UPPER.lower()))


def words_of(text: Column) -> Column:
    """Words of a lower-cased text, in order; null gives an empty array."""
    pieces = F.split(ascii_lower(F.coalesce(text, F.lit(""))), WORD_BREAK)
    return F.filter(pieces, lambda w: w != "")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Cuts lineage: written as Parquet into the shared folder and read back, so that later
    jobs read columns of it instead of running its plan again, also after a lost executor.
    What is stored is deleted when the application ends."""
    return Staging.of_application(df.sparkSession).store(df, name)


#: copies of equal rows that one task makes at a time
COPIES = 4_000


def counted_copies(df: DataFrame) -> DataFrame:
    """Distinct rows of `df` and how often they came, as _n."""
    return df.groupBy(*df.columns).agg(F.count("*").alias("_n"))


def each_copy(counted: DataFrame, keys: list[str], copy: str) -> DataFrame:
    """Every row _n times, numbered from 0 in `copy`; the copies of one row are dealt over tasks."""
    parts = counted.withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), F.call_function("div", F.col("_n") - 1, F.lit(COPIES)))))
    first = F.col("_part") * COPIES
    each = F.explode(F.sequence(first, F.least("_n", first + COPIES) - 1))
    return parts.repartition(*keys, "_part").withColumn(copy, each).drop("_part", "_n")


def sliced(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """Smaller batches: what a worker makes from one at a time stays small."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)
