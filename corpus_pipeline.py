"""From raw documents to shards of training text. Each stage works on all that the one before kept,
and is written as Parquet and read again, so a lost executor costs a task and a lost driver a stage.

Every stage but the last returns the columns of its input, other columns included. Rows with a null
in any column, empty and very long texts, repeated rows and empty tables pass through each stage by
the rules in the docstring of its operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from changeflow.llm import leaks, mixing, nearcopies, shards
from changeflow.llm.queries import table, toxicity_model
from changeflow.llm.toxicity import without_toxic
from changeflow.session import scratch_path, settle


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are predicted as toxic go."""
    return without_toxic(docs, toxicity_model(spark, docs, sf_dir))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies stays."""
    return nearcopies.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold an item of the benchmark go."""
    return leaks.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in their target weights: a row for each time that words of a document are taken, with the
    words taken."""
    return mixing.mixed_documents(mixing.mix(docs, keep=docs.columns))


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row's shard and slot along the curve, beside its columns. An input column of the name of an
    added one gives way to it."""
    return shards.hilbert_shards(docs, shards.SHARDS, keep=[c for c in docs.columns if c not in shards.ADDED])


STAGES = [
    ("toxicity", toxicity),
    ("near_copies", near_copies),
    ("decontamination", decontamination),
    ("source_mix", source_mix),
    ("sharding", sharding),
]

#: Nearest neighbours, arrivals of a Poisson process, alignment and seeded permutations are not for SQL:
#: tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), scratch_path(spark, name))
    return docs
