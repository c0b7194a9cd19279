"""A corpus from raw documents: filtered, without near-duplicates, mixed to weights and packed into sequences."""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowgauge.llm.mixing import mixed_documents, mixing_plan
from flowgauge.llm.near_dedup import near_duplicates
from flowgauge.llm.packing import pack_documents
from flowgauge.llm.quality import fit_quality, good_documents
from flowgauge.llm.tables import stored, table
from flowgauge.llm.toxicity import civil_documents, fit_toxicity

#: The stages hold fitted models and a tokenizer, which SQL can't express; the tests hold them to plain versions.
ORACLE_SQL = None
#: Number of a row within a stage.
ROW = "_stage_row"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality model scores 0.3 or more stay."""
    return good_documents(docs, fit_quality(docs, table(spark, sf_dir, "labels")), 0.3)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model scores under 0.5 stay."""
    return civil_documents(docs, fit_toxicity(docs, table(spark, sf_dir, "labels")), 0.5)


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each near-duplicate group stays, that of the smallest doc_id: shingles of five words, similarity 0.8 or more.

    Rows are judged by their texts: copies under one doc_id, or without any, leave one row, and unlike texts under one doc_id
    are no copies. Blank texts are copies of nothing.
    """
    numbered = stored(docs.withColumn(ROW, F.monotonically_increasing_id()), "numbered")
    groups = near_duplicates(numbered.select(F.col(ROW).alias("doc_id"), "text"), width=5, percent=80)
    groups = groups.select(F.col("doc_id").alias(ROW), "component_id")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", ROW)
    firsts = numbered.select(ROW, "doc_id").join(groups, ROW).groupBy("component_id").agg(F.min(order).getField(ROW).alias(ROW))
    return numbered.join(firsts, ROW, "left_semi").select(*docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as systematic sampling takes them: 150% of all words, sources weighing 3, 1, 2 in turn."""
    return mixed_documents(docs, mixing_plan(docs, weights=(3, 1, 2), share=1.5, most=2.0))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each document's tokens lie in sequences of 2,048."""
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), 2048)


STAGES = [
    ("quality", quality),
    ("toxicity", toxicity),
    ("minhash_dedup", dedup),
    ("mixing", mixing),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages one after another, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
