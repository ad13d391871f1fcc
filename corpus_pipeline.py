"""The training-data pipeline: five stages from documents to token shards.

Every stage takes (spark, docs, sf_dir) and returns a frame that is written as Parquet and read again
as the next one's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch, small_batches, staged, tables
from tidemark.llm.contamination import contamination
from tidemark.llm.jaccard import without_near_duplicates
from tidemark.llm.mixing import mix_documents
from tidemark.llm.ordering import write_training_order
from tidemark.llm.queries import RANKS, TOXIC_AT
from tidemark.llm.toxicity import toxicity, train
from tidemark.session import scratch_path


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learnt from the labelled ones, doesn't call toxic."""
    small_batches(spark)
    model = train(docs, tables(spark, sf_dir, "labels").select("doc_id", "toxic"))
    return docs.where(toxicity(docs, model) < TOXIC_AT)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five words, Jaccard similarity of 0.8 or more."""
    small_batches(spark)
    return without_near_duplicates(docs, size=5, similarity=(4, 5))


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that aren't contaminated by a benchmark item."""
    judged = contamination(docs, tables(spark, sf_dir, "benchmark"))
    return judged.where(~F.col("hit.contaminated")).select(*docs.columns)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's weight asks for."""
    return mix_documents(docs)


def token_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token shards in training order; the rows are the index of their sequences."""
    return write_training_order(docs, scratch_path(spark, "pipeline-shards"), RANKS, per_shard=2048)


STAGES = [
    ("toxicity", without_toxic),
    ("near_duplicates", one_of_each),
    ("decontamination", without_benchmark),
    ("mixing", mixed_sources),
    ("token_order", token_shards),
]

# A classifier, a key-dependent order and token ids are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = tables(spark, sf_dir, "documents")
    with Scratch(spark) as scratch:
        for name, stage in STAGES[:-1]:
            docs = scratch.staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
        name, stage = STAGES[-1]
        return staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
