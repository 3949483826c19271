"""Corpus pipeline: quality rules, near-duplicates, benchmark decontamination,
mixing to target weights, sharding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its result is
written as Parquet and read again as the next stage's ``docs``.  All but the
last return the columns of ``documents``; the last adds ``slot`` and ``shard``.
Documents that the mix takes twice are there twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowgrid.llm import contamination, mixing, near_dup, quality_rules, sharding
from flowgrid.session import materialize


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no rule of policy v2 rejects.  Null and empty texts have too few
    words and go; repeated rows and rows without an id are judged row by row; an
    empty table stays empty; columns stay as they are."""
    return quality_rules.passing(docs, "v2")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, a (doc_id, text), of each component (5-word shingles, similarity
    0.8): the smallest id, one with an id before one without.  Rows equal in both
    are one document; texts without a word are linked with nothing and stay; an
    empty table stays empty; columns stay as they are."""
    return near_dup.keep_documents(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a 10-word window of a benchmark item.  Null texts have no
    window and stay; rows are judged one by one; columns stay as they are; with
    an empty benchmark all stay."""
    return contamination.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: a last part of at least half a
    document counts as a pass.  Null and empty texts have size 0 and are never
    taken; a null source is a source; rows that repeat an id or have none are rows
    like others; an empty table stays empty; columns stay as they are."""
    return mixing.repeat_documents(docs, F.array("source"))


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their ``slot`` and ``shard``; rows without an id are placed by
    their text, repeated rows together; an empty table stays empty."""
    return sharding.assign_shards(docs)


STAGES = [("quality_rules", quality), ("near_dedup", near_duplicates), ("decontamination", decontamination),
          ("mix_sources", mix), ("shard", shards)]

#: sketches, flow and turn table have no SQL form; tested against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialize(docs, name)
    return docs
