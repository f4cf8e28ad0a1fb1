"""The corpus pipeline: language, near copies, secrets, mixture, packing.

Each stage takes all that its predecessor kept and returns the columns of ``documents``; the last returns the packed
pieces. Decisions name documents by doc_id: a row without one is never dropped, rows that repeat one share its fate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm import language_id, mixing, packing, prob_minhash, queries, secret_scan
from skyledger.llm.common import stored
from skyledger.plans.registry import Query


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known with a posterior of one half or more; texts without letters go."""
    judged = language_id.identify(language_id.document_evidence(docs), language_id.fit_text_model(docs))
    return _without(docs, judged.where(~F.col("accepted")))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest doc_id."""
    return _without(docs, prob_minhash.near_duplicates(docs).where(~F.col("kept")))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a mark in place of every secret."""
    return secret_scan.redact(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in the order of the mix: files and the rows within them follow the slots of the schedule."""
    mixed = mixing.mix(docs, queries.SHARES, keep=docs.columns)
    return mixed.orderBy("slot", "position", "doc_id").select("kept.*")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their sequences and places; sequences follow the order of the mix."""
    pieces = packing.token_pieces(mixing.places(docs), keep=["_place"])
    return packing.pack(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"), shard_pieces=packing.SHARD_PIECES, order="_place")


STAGES = [
    ("language", language),
    ("near_copies", near_copies),
    ("secrets", secrets),
    ("mixture", mixture),
    ("packing", packed),
]

#: Near copies by signatures and the tokenizer cannot be said in SQL; the tests compare with brute force.
ORACLE_SQL = None


def _without(docs: DataFrame, rejected: DataFrame) -> DataFrame:
    named = rejected.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").alias("_rejected")).distinct()
    return docs.join(named, F.col("doc_id").cast("long") == F.col("_rejected"), "left_anti")


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of ``sf_dir``; each but the last is stored before the next reads it."""
    docs = queries.table(spark, sf_dir, "documents")
    for place, (name, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if place < len(STAGES):
            docs = stored(docs, name)
    return docs


def llm_queries() -> dict[str, Query]:
    """Registered queries of the training-data operators and of the pipeline, by name."""
    return {**queries.REGISTRY, "pipeline": Query("pipeline", run, ORACLE_SQL)}
