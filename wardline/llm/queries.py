"""Queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.llm import conversations, decontaminate, fingerprint, html_text, licenses, pii, ranked_search, token_store, toxicity
from wardline.llm.common import crc_fold, table
from wardline.llm.ctw import code_lengths
from wardline.llm.minhash import near_duplicates
from wardline.llm.packing import pack
from wardline.llm.suffix_dedup import drop_repeats


def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), shingle=3, percent=85)


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_personal_data(table(spark, sf_dir, "documents"))


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return code_lengths(table(spark, sf_dir, "documents"), crc_fold("doc_id", 7) != 2)


def toxicity_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> toxicity.Model:
    """Learned from the labelled rows outside the held-out fold."""
    labels = table(spark, sf_dir, "labels").where(crc_fold("doc_id", 4) != 2)
    return toxicity.fit(toxicity.training_rows(docs, labels))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(crc_fold("doc_id", 4) == 2, F.lit(True))
    return toxicity.score(docs, toxicity_model(spark, docs, sf_dir)).withColumn("held_out", held_out).select("doc_id", "held_out", "score", "predicted", "n_terms")


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return decontaminate.find_leaks(docs, decontaminate.build_index(docs, table(spark, sf_dir, "benchmark")))


def op8_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.with_edits(table(spark, sf_dir, "documents"))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_repeats(table(spark, sf_dir, "documents"), length=50)


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op11_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_store.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair(conversations.damage(table(spark, sf_dir, "conversations")))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_minhash, op2_pii, op3_html_extraction, op4_licenses, op5_lm_scoring, op6_toxicity, op7_decontaminate, op8_fingerprint, op9_suffix_dedup, op10_packing, op11_token_ids, op12_conversation_repair, op13_ranked_search)}


def oracle_sql() -> dict[str, str]:
    return {"op2_pii": pii.sql(), "op4_licenses": licenses.sql(), "op13_ranked_search": ranked_search.sql()}
