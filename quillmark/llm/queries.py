"""The operators as registered queries over whole tables, with SQL where SQL can express them."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmark.llm import (
    chat_trees,
    decontamination,
    divergence,
    fingerprints,
    html_text,
    language_id,
    lm_scoring,
    merkle,
    mixing,
    near_dedup,
    pii,
    secret_scan,
    token_counts,
)

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return _table(spark, sf_dir, "documents").select("doc_id", "text", *columns)


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir, "lang")
    held_out = language_id.held_out(F.col("doc_id"))
    model = language_id.fit(docs.where(~held_out).select("text", "lang"))
    found = language_id.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "known_share", "accepted")


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    return fingerprints.compare_with_next(docs, fingerprints.fit_rarity(docs))


def op3_chat_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_trees.round_trip(chat_trees.with_hostile_conversation(_table(spark, sf_dir, "conversations")))


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(_documents(spark, sf_dir), shingle_words=2)


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(_documents(spark, sf_dir))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(_documents(spark, sf_dir), token_counts.read_vocabulary())


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score_documents(_documents(spark, sf_dir))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    return pii.find_personal_data(docs, pii.fit(docs))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_documents(spark, sf_dir, "source"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination(_documents(spark, sf_dir), _table(spark, sf_dir, "benchmark"))


def op11_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(_table(spark, sf_dir, "pages"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.audit(_documents(spark, sf_dir, "lang", "source", "n_chars"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(_table(spark, sf_dir, "documents").select("text", "lang", "source"))


QUERIES: dict[str, Query] = {
    "op1_language_id": op1_language_id,
    "op2_fingerprints": op2_fingerprints,
    "op3_chat_trees": op3_chat_trees,
    "op4_near_dedup": op4_near_dedup,
    "op5_secret_scan": op5_secret_scan,
    "op6_token_counts": op6_token_counts,
    "op7_lm_scoring": op7_lm_scoring,
    "op8_pii": op8_pii,
    "op9_mixing": op9_mixing,
    "op10_decontamination": op10_decontamination,
    "op11_html_extraction": op11_html_extraction,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_source_divergence": op13_source_divergence,
}

ORACLE_SQL: dict[str, str] = {
    "op3_chat_trees": chat_trees.SQL,
    "op4_near_dedup": near_dedup.SQL,
    "op9_mixing": mixing.SQL,
    "op10_decontamination": decontamination.SQL,
    "op12_merkle_manifest": merkle.SQL,
    "op13_source_divergence": divergence.SQL,
}
