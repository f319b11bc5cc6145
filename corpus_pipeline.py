"""Corpus pipeline: toxicity, near duplicates, benchmark passages, secrets, packing, one after another over documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from annolith.llm.op1_decontaminate import stage_decontamination
from annolith.llm.op4_packing import stage_packing
from annolith.llm.op5_toxicity import stage_toxicity
from annolith.llm.op6_jaccard import stage_near_duplicates
from annolith.llm.op10_secrets import stage_secrets
from annolith.session import kept

#: Each takes (spark, docs, sf_dir); all but the last return the columns of documents.
STAGES = [
    ("toxicity", stage_toxicity),
    ("near_duplicates", stage_near_duplicates),
    ("decontamination", stage_decontamination),
    ("secrets", stage_secrets),
    ("packing", stage_packing),
]
#: Model scores, edit distances and a tokenizer are no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; each stage's result is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = kept(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
