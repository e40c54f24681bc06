"""The corpus pipeline: five stages over documents, each written as Parquet and read again as the next one's input.

Defined results: documents with a null or empty text fail the quality rules and go; texts of any length are judged, compared and encoded
whole; repeated rows are near copies, so one of them stays, and the mix may take it several times; null ids and null sources are values
like others. The first four stages keep every column they find, also such as clash with names of their own; the last returns doc_id, lang and
source (null where documents have no such column) with the encoding, and leaves other columns out. Empty tables give an empty result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.llm import mixing, ngram_join, piece_encoding, quality_rules, toxicity
from gleaner.llm.common import stored, table


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the toxicity models reject."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that a quality rule rejects."""
    return quality_rules.keep_good(docs)


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies."""
    return ngram_join.keep_one(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes each document as often as its source's target weight asks."""
    return mixing.mixed_documents(docs)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encodes the mix; the ids decode to the text."""
    known = [F.col(c) if c in docs.columns else F.lit(None).cast("string").alias(c) for c in ("doc_id", "lang", "source", "text")]
    encoded = piece_encoding.encode_documents(docs.select(*known), ids="token_ids", decoded="round_trip")
    return encoded.select("doc_id", "lang", "source", F.size("token_ids").cast("long").alias("n_tokens"), "token_ids", "round_trip")


STAGES = [
    ("toxicity", toxicity_stage),
    ("quality_rules", quality_stage),
    ("ngram_jaccard_join", dedup_stage),
    ("mixing", mixing_stage),
    ("sentencepiece", encoding_stage),
]

#: Trained scores and the balanced sample can't be put in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
