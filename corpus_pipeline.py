"""A training-data pipeline over ``documents``: the stages, in order, and the run of all.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and read again as the next stage's docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import blocknames, decontaminate, quality, sentencepieces, simhash
from tidemark.llm.tables import stored

STAGES = [
    ("quality", quality.stage),
    ("exact_dedup", blocknames.stage),
    ("near_dedup", simhash.stage),
    ("decontaminate", decontaminate.stage),
    ("sentencepiece", sentencepieces.stage),
]

# Quality scores and piece ids are beyond SQL; the run is tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
