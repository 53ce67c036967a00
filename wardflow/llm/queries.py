"""One query per operator, each over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.llm import (
    audit,
    collocations,
    lines,
    minhash,
    mixing,
    oracles,
    packing,
    quality,
    secrets,
    sharding,
    simhash,
    suffix_tree,
    topk,
    urls,
)
from wardflow.llm.common import fold, table, text_of

THRESHOLD = 0.3


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return topk.search(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)


def op2_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    model, figures = quality.fit(docs, labels)
    scored = quality.score_figures(figures, model)
    return scored.select(
        "doc_id", (fold() == 0).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )


def op3_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    kept = F.sha2(text_of().cast("binary"), 256)
    return lines.dedup_lines(docs).select("doc_id", "n_lines", "n_dropped", kept.alias("kept_sha256"))


def op4_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard_digests(table(spark, folder, "documents"))


def op5_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return simhash.edited_likeness(docs).drop("fp")


def op6_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    kept = F.col("doc_id").eqNullSafe(F.col("component_id"))
    return minhash.near_duplicates(docs).withColumn("kept", kept)


def op7_packing(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return packing.pack(docs, tokenizer_path(), with_ids=False)


def op8_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    mixed = mixing.mix(docs).withColumn("rate", F.round("rate", 9))
    return mixed.select("doc_id", "source", "lang", "text", "n_chars", *mixing.ADDED)


def op9_secrets(spark: SparkSession, folder: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, folder, "documents"))
    counts = [secrets.count_of(F.col("base"), k).alias(f"n_{k}") for k in secrets.KINDS[:3]]
    digest = F.sha2(secrets.as_text(F.col("base")).cast("binary"), 256)
    return found.select("doc_id", *counts, digest.alias("base_sha256"), secrets.as_text(F.col("spans")).alias("spans"))


def op10_lm_scores(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_tree.fit_and_score(table(spark, folder, "documents").select("doc_id", "text"))


def op11_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    return audit.audit(docs, table(spark, folder, "labels"))


def op12_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url")
    return urls.judge(pages, urls.spam_hosts(pages)).select("page_id", *urls.ADDED)


def op13_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(table(spark, folder, "documents").select("lang", "text"))


ALL: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_top_k": op1_top_k,
    "op2_quality": op2_quality,
    "op3_line_dedup": op3_line_dedup,
    "op4_sharding": op4_sharding,
    "op5_fingerprints": op5_fingerprints,
    "op6_near_dedup": op6_near_dedup,
    "op7_packing": op7_packing,
    "op8_mixing": op8_mixing,
    "op9_secrets": op9_secrets,
    "op10_lm_scores": op10_lm_scores,
    "op11_filter_audit": op11_filter_audit,
    "op12_url_filters": op12_url_filters,
    "op13_collocations": op13_collocations,
}

ORACLES: dict[str, str] = oracles.ALL
