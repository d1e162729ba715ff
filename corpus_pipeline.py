"""A training corpus from documents: toxicity, near duplicates, benchmark leaks, personal data, packing.

Each stage reads what the one before wrote, decides on all of it, and passes all columns of the rows that it keeps; the last one gives
pieces of packed sequences.

Defined results: a document without text (null, empty or blank) is scored as a text without words, is nobody's copy, holds no leak and no
personal data, and is packed as its closing id alone; rows without doc_id go through all stages but are nobody's copy; whole repeats
are copies, of which one row stays; rows that share a doc_id but differ are decided one by one; an empty table gives an empty
result; without labels of both classes nothing is dropped as toxic unless most labels say so; further columns pass through, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from driftwell.llm import decontaminate, neardup, packing, pii, toxicity
from driftwell.llm.common import table
from driftwell.llm.queries import tokenizer_files


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Fitted on the labelled documents of the whole corpus; documents predicted to be toxic go."""
    model = toxicity.fit(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.drop(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Five-word shingles, similarity of 0.8 or more; the smallest doc_id of each group stays."""
    return neardup.keep_one(docs, shingle=5, percent=80)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redact(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, **tokenizer_files())


STAGES = [("toxicity", drop_toxic), ("near_duplicates", drop_near_duplicates), ("decontamination", drop_benchmark_leaks), ("personal_data", mask_personal_data), ("packing", pack_sequences)]

#: SQL can express neither the fitted classifier nor the packing; tests/llm hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = table(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
