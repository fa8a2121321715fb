"""A training corpus from ``documents``: toxic documents go, one of each group
of near-duplicates stays, documents with benchmark passages go, sources are
mixed to their weights, and what is left is written as token ids.

``STAGES`` lists (name, function); a function takes ``(spark, docs, sf_dir)``.
All but the last return rows with the columns of ``documents``; ``run`` writes
each stage as Parquet in the shared folder and reads it for the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tierflow.llm.decontam import keep_uncontaminated
from tierflow.llm.mixing import take_mix
from tierflow.llm.queries import MIX_ALPHA, MIX_EPOCHS, MIX_FRACTION, mix_levels, token_rows
from tierflow.llm.runtime import prepare, written
from tierflow.llm.simhash import keep_one_each
from tierflow.llm.toxicity import fit_chain, keep_clean


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain, learnt from all labelled ones, calls
    toxic go."""
    prepare(spark)
    return keep_clean(docs, fit_chain(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by fingerprints at most 4 bits apart, one stays."""
    prepare(spark)
    return keep_one_each(docs, shingle=4, max_bits=4)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, 0.8 similar or more, go."""
    prepare(spark)
    return keep_uncontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents come as often as the source budgets read them."""
    prepare(spark)
    return take_mix(docs, mix_levels(), fraction=MIX_FRACTION, alpha=MIX_ALPHA, max_epochs=MIX_EPOCHS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token shards with their key index; returns each document's place."""
    prepare(spark)
    return token_rows(docs)


STAGES = [("toxicity", toxicity), ("simhash_dedup", simhash_dedup), ("decontaminate", decontaminate), ("mix", mix), ("tokens", tokens)]

#: Trained models, hash order and tokenizers are beyond SQL: see tests/llm/test_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
