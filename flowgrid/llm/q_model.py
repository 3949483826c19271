"""Queries of the operators that learn a model."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowgrid.llm import lm_ppm, toxicity_fm
from flowgrid.llm.q_native import documents


def op3_byte_context_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_ppm.score_documents(documents(spark, sf_dir))


def op5_factorization_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = lm_ppm.fold(F.col("doc_id")) == 0
    scored = toxicity_fm.score_toxicity(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"), ~held)
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


QUERIES = {"op3_byte_context_ppm": op3_byte_context_ppm, "op5_factorization_toxicity": op5_factorization_toxicity}
ORACLES: dict[str, str] = {}
