"""From raw documents to packed training sequences, in five stages.

Each stage works on all that the one before has kept, and its result is written as Parquet and read again, so a lost
executor costs no more than a stage. All stages but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.llm import decontaminate, pii, toxicity
from wardline.llm.common import Scratch, table
from wardline.llm.minhash import near_duplicates
from wardline.llm.packing import pack
from wardline.llm.queries import toxicity_model

#: No SQL has these models; tests/llm/test_pipeline.py holds each stage against a plain version.
ORACLE_SQL: str | None = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model accepts. Null and empty texts stay unless most labelled rows are toxic; ids play no part."""
    return toxicity.keep_clean(docs, toxicity_model(spark, docs, sf_dir))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies: that of the smallest id. Null and empty texts and rows without an id stay.

    Rows are decided one by one: different texts of one id are rows of their own; of rows with one id and text one stays.
    """
    scratch, some, text = Scratch(spark), docs.where("doc_id is not null"), F.xxhash64(F.coalesce("text", F.lit("")))
    repeated = scratch.save(some.groupBy("doc_id").agg(F.count("*").alias("n"), (F.min(text) != F.max(text)).alias("several")).where("n > 1").select("doc_id", "several"))
    if repeated.isEmpty():
        gone = near_duplicates(docs).where("not kept").select("doc_id")
        some = some.join(gone, "doc_id", "left_anti")
    else:
        keyed = some.join(repeated, "doc_id", "left")
        keyed = keyed.withColumn("_row", F.when(F.col("several"), F.xxhash64("doc_id", text)).otherwise(F.col("doc_id")))
        found = near_duplicates(keyed.select(F.col("_row").alias("doc_id"), "text")).select(F.col("doc_id").alias("_row"), "component_id").distinct()
        first = found.join(keyed.select("_row", "doc_id").distinct(), "_row").groupBy("component_id").agg(F.min(F.struct("doc_id", "_row")).alias("first"))
        kept = keyed.join(first.select("first._row"), "_row", "left_semi")
        # of equal rows the smallest by all its columns, so that a task run again keeps the same one
        once = kept.where("several is not null").groupBy("_row").agg(F.min(F.struct(docs.columns)).alias("one")).select("one.*")
        some = kept.where("several is null").select(docs.columns).unionByName(once)
    return some.select(docs.columns).union(docs.where("doc_id is null"))


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage. Null and empty texts have none and stay; ids play no part."""
    return decontaminate.drop_leaks(docs, decontaminate.build_index(docs, table(spark, sf_dir, "benchmark")))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind. Null texts stay null, with null as their number of characters."""
    return pii.redact(docs).withColumn("n_chars", F.length("text").cast("long"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, with their places in sequences of 2048 tokens. Null and empty texts are one end token."""
    import public_tokenizers

    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("minhash", drop_near_copies),
    ("decontamination", drop_benchmark),
    ("pii", redact_personal_data),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, scratch = table(spark, sf_dir, "documents"), Scratch(spark)
    for _, stage in STAGES[:-1]:
        docs = scratch.save(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
