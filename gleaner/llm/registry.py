"""Queries of the training-data operators: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import compression_score, mixing, nearest, ngram_join, personal_data, piece_encoding, preference, quality_rules, resampling, toxicity, warc, weak_labels, whitening
from .common import fold, table


def op7_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = nearest.usable(table(spark, sf_dir, "embeddings"))
    return nearest.search(vectors, vectors.where(F.pmod("vec_id", F.lit(20)) == 0))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_rules.apply_rules(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", F.array_join("failed_rules", ",").alias("failed_rules"), "n_lines", "n_stop_words"
    )


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select(F.col("page_id").alias("record_id"), "url", F.col("html").cast("binary").alias("payload"))
    manifest = warc.write_packages(warc.plan_revisits(pages))
    records = warc.read_records(manifest, with_payload=False)
    number = lambda c: F.nullif(F.col(c), F.lit("")).cast("long")
    return records.select(
        number("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", number("refers_to").alias("refers_to"), F.col("target_uri").alias("url")
    )


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = weak_labels.classify(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return scored.select("doc_id", "n_votes", "posterior", "score", F.col("good").alias("kept"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    fitted = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score_documents(docs, fitted)
    held_out = fold(F.col("doc_id"), toxicity.FOLDS) == toxicity.HELD_OUT_FOLD
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def op4_ppm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compression_score.score_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op5_preference_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = preference.format_pairs(preference.neighbours(table(spark, sf_dir, "conversations")))
    text = lambda c: F.array_join(F.transform(c, lambda s: s["text"]), "")
    return pairs.select(
        "pair_id",
        "chosen_id",
        "rejected_id",
        "prompt_turns",
        "prompt",
        text("chosen").alias("chosen_text"),
        text("rejected").alias("rejected_text"),
        preference.trained_text(F.col("chosen")).alias("chosen_trained"),
        preference.trained_text(F.col("rejected")).alias("rejected_trained"),
    )


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = piece_encoding.encode_documents(docs, ids="token_ids", decoded="round_trip")
    return encoded.select("doc_id", F.size("token_ids").cast("long").alias("n_tokens"), "token_ids", "round_trip")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark").select("text"))


def op12_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data.report(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "op1_warc": op1_warc,
    "op2_quality_classifier": op2_quality_classifier,
    "op3_toxicity": op3_toxicity,
    "op4_ppm_score": op4_ppm_score,
    "op5_preference_format": op5_preference_format,
    "op6_sentencepiece": op6_sentencepiece,
    "op7_nearest": op7_nearest,
    "op8_quality_rules": op8_quality_rules,
    "op9_mixing": op9_mixing,
    "op10_ngram_join": op10_ngram_join,
    "op11_importance_resampling": op11_importance_resampling,
    "op12_personal_data": op12_personal_data,
    "op13_whitening": op13_whitening,
    "pipeline": pipeline,
}
OP1_SQL = """
WITH p AS (SELECT page_id, url, coalesce(html, '') AS html, octet_length(encode(coalesce(html, ''))) AS n FROM pages),
d AS (SELECT *, CASE WHEN n >= 1000 THEN max(page_id) OVER (PARTITION BY html) END AS kept FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, sha1(html) AS payload_digest,
  CASE WHEN kept IS NOT NULL AND page_id IS DISTINCT FROM kept THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN kept IS NOT NULL AND page_id IS DISTINCT FROM kept THEN kept END AS refers_to, url
FROM d
"""

ORACLES: dict[str, str] = {"op1_warc": OP1_SQL, "op5_preference_format": preference.ORACLE_SQL, "op8_quality_rules": quality_rules.ORACLE_SQL}
