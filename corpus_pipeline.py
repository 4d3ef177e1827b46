"""The corpus pipeline: each stage reads what its predecessor kept and returns a DataFrame."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from caselake.llm import pipeline_stages as P
from caselake.session import scratch_path

STAGES = [
    ("language_id", P.keep_identified),
    ("simhash_near_dedup", P.keep_one_per_group),
    ("benchmark_decontamination", P.keep_uncontaminated),
    ("secret_scans", P.keep_secret_free),
    ("best_fit_packing", P.pack_kept),
]

# The trained language model, the fingerprints, the tokenizer and the linear program have no
# SQL twin; tests/llm compares the stages with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and reread as the next one's input."""
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet")
    name = uuid.uuid4().hex[:8]
    for step, function in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}-{step}")
        function(spark, rows, sf_dir).write.parquet(path)
        rows = spark.read.parquet(path)
    return STAGES[-1][1](spark, rows, sf_dir)
