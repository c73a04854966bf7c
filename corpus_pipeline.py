"""A corpus pipeline: stages over ``documents``, each written as Parquet and read again by the next one.

Every stage takes (spark, docs, sf_dir), works on all rows its predecessor kept, and returns their columns;
the last one returns token figures. Extra columns pass through. Defined cases: a text that is null or has
no letter goes in the first stage; a row without doc_id cannot be named by a verdict and passes the
filters that need one; repeated rows of a document become one row in the exact stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scopewise.llm import bpe, decontaminate, exact, language, near
from scopewise.llm.queries import VOCABULARY_FILE
from scopewise.session import discard, materialize, scratch_tables

#: A document must have this share of its letters in one language.
MIN_LANGUAGE_SHARE = 0.5
#: Documents are near duplicates from this similarity of their five-word shingles, in percent.
NEAR_PERCENT = 85


def without(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """The rows of docs whose doc_id is not in ``dropped``."""
    ids = dropped.select(F.col("doc_id").alias("dropped_doc_id"))
    return docs.join(ids, docs["doc_id"] == ids["dropped_doc_id"], "left_anti")


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without letters and those where no language has half of the letters."""
    return language.keep_identified(docs, language.train(docs.where(~language.held_out())), MIN_LANGUAGE_SHARE)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts keep the document with the largest doc_id, in one row.

    Rows are told apart by doc_id and text, so that different texts of one doc_id are judged each for itself.
    """
    return exact.drop_duplicates(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near duplicates keep the document with the smallest doc_id."""
    with scratch_tables() as keep:
        found = near.near_duplicates(docs, NEAR_PERCENT)
        dropped = keep(materialize(found.where(~F.col("kept")).select("doc_id"), "near-dropped"))
    return without(docs, dropped)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark item."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    with scratch_tables() as keep:
        found = decontaminate.find_items(docs, items)
        dropped = keep(materialize(found.select("doc_id").distinct(), "contaminated"))
    return without(docs, dropped)


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document and the digest of the text they decode to."""
    return bpe.round_trip(docs, VOCABULARY_FILE).select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


STAGES = [
    ("language", language_stage),
    ("exact_dedup", exact_stage),
    ("near_dedup", near_stage),
    ("decontaminate", decontaminate_stage),
    ("bpe", encode_stage),
]

#: Language identification and merging by rank are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        stored = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
        discard(docs)
        docs = stored
    return STAGES[-1][1](spark, docs, sf_dir)
