"""The corpus pipeline: toxic documents out, exact and near copies out, sources mixed, documents packed.

Each stage takes ``(spark, docs, sf_dir)``, works on all documents that the stage before kept, and
returns documents with their columns; the last returns packed pieces.

Defined results of every stage: an empty table gives an empty result; a null text counts as empty and stays if it is
not a copy of another; a null source is a source of its own; a row with a null doc_id is scored, deduplicated by text, never a
near-duplicate of a document, mixed and packed like any other; rows that repeat a doc_id and text are copies, of which one stays; columns beside those
of ``documents``, whatever their names, are carried through all stages but the last. Ties go to the smallest doc_id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fringeflow.llm import exact, mixing, packing, simhash, toxicity
from fringeflow.plans.lineage import settle


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the toxicity operator predicts to be toxic."""
    return toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the smallest doc_id."""
    return exact.drop_exact(docs)


def drop_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near-duplicates, the document with the smallest doc_id."""
    return simhash.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mixed(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with the sequence and place that each is packed to."""
    return packing.pack_documents(docs)


STAGES = [("toxicity", drop_toxic), ("exact_dedup", drop_exact), ("near_dedup", drop_near), ("mixing", mix_sources), ("packing", pack)]

#: SQL cannot express a trained classifier, fingerprints or a tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's result is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
