"""A training corpus from `documents`, in five stages.

Quality classifier, near-duplicate removal, benchmark decontamination, mixing of sources to
target weights, sharding. Each stage reads all that its predecessor kept, as Parquet.

All stages but the last return the columns of their input as they are; an empty table gives no rows. Rows with null ids are rows like any other; a null text is an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hourglass.llm import decontaminate, mixing, near_dedup, quality, sharding
from hourglass.llm.common import stored, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts; it learns from the labels of `documents`.
    Empty texts are scored like others; repeated rows are all kept or all dropped."""
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a similarity of 0.8 or more on five-word shingles.
    The smallest id stays, null ids last. Texts without words are linked with nothing; of rows equal
    in id and text, and of rows equal in id without words, one stays."""
    return near_dedup.distinct_documents(docs, words=5, similarity=(8, 10))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of ten words of any benchmark item.
    Texts without words hold none and stay; with an empty benchmark all documents stay."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it: not at all, or up to three times.
    A null source is a source of its own."""
    return mixing.mixed_documents(docs)


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row of the mix with its text, shard and slot. The columns size, text_crc32,
    law, shard, slot and grown_shard take the place of columns of the same names."""
    return sharding.sharded_documents(docs)


STAGES = [
    ("quality", quality_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("sharding", sharding_stage),
]

#: the trained classifier and hash-driven sampling have no SQL form
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
