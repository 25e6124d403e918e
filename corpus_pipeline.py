"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read again by the next.

In every stage a null text is empty, null languages and sources are groups of their own, rows with equal or null ids are
documents of their own, further columns pass through whatever their names, and an empty table gives an empty one.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from thalweg.llm import jaccard_join, mixing, packing, quality_classifier, quality_rules
from thalweg.llm.common import crc_mod, shared_folder, table
from thalweg.llm.queries import byte_bpe

#: A document stays if its quality score is at least this.
LEAST_SCORE = 0.5


def classify_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier doesn't reject; empty ones have a score like others. Ids without a label or null ones are
    only scored. Without labels of both classes the prior alone decides."""
    learn = F.coalesce(crc_mod(F.col("doc_id"), 4) != 2, F.lit(True))
    return quality_classifier.accepted(docs, table(spark, sf_dir, "labels"), learn, LEAST_SCORE)


def apply_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are no outliers of their language and source; empty ones fail (too few words)."""
    return quality_rules.passing(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the least id, of each group of similar ones; all without words stay, as they are like nothing."""
    return jaccard_join.deduplicated(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents as often as the mix takes them, in training order; those without words are never taken."""
    return mixing.training_order(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row for each piece of a document in a sequence of at most 1024 tokens; an empty one is its separator."""
    return packing.pack_documents(docs, byte_bpe())


STAGES = [
    ("quality classifier", classify_quality),
    ("quality rules", apply_rules),
    ("n-gram Jaccard join", drop_near_copies),
    ("mixing sources", mix_sources),
    ("packing", pack_sequences),
]

#: Two stages learn from data by iteration and one draws on a tokenizer: not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for i, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{i}")
        docs = spark.read.parquet(f"{folder}/{i}")
    return docs
