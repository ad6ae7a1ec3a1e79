"""The corpus pipeline: from raw documents to shards for training."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from panelspan.llm import jaccard
from panelspan.llm.frames import table
from panelspan.llm.mixing import poisson_mix
from panelspan.llm.quality import keep_good
from panelspan.llm.sharding import shard_documents
from panelspan.llm.winnowing import decontaminate
from panelspan.sinks.scratch import staged

SHARDS = 24
MIX_SEED = 17
MIX_TEMPER = 0.5


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labelled ones, does not reject."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of copies and near copies (five words, 0.8)."""
    return jaccard.one_of_each(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no ten words in a row with a benchmark item."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As many documents, with sources weighed by the square root of their size."""
    copies = poisson_mix(docs, temper=MIX_TEMPER, seed=MIX_SEED)
    return copies.select(*docs.columns)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every copy with its shard, and its place in the shard."""
    return shard_documents(docs, SHARDS)


STAGES = [
    ("quality", good_quality),
    ("near_copies", one_of_each),
    ("benchmark", without_benchmark),
    ("mix", mixed),
    ("shards", sharded),
]

#: The classifier cannot be said in SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written, and read as the next one's input."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
