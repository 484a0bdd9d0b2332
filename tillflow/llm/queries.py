"""The queries of the training-data operators: each applies its operator to the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from tillflow.llm import (
    hnsw_dedup,
    importance,
    kd_shards,
    lang_id,
    licences,
    mixing,
    near_dedup,
    oracles,
    periodic_runs,
    pieces,
    pii,
    toxicity,
    url_filter,
    va_search,
)
from tillflow.llm.common import table
from tillflow.llm.tokenizers import tokenizer_model

Query = Callable[[SparkSession, str], DataFrame]


def op1_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, folder, "documents"))


def op2_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.plan_mix(table(spark, folder, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op3_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    encoded = pieces.encode(table(spark, folder, "documents").select("doc_id", "text"), tokenizer_model(), decoded=True)
    ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    return encoded.select(
        "doc_id",
        F.array_size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(ids, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op4_kd_shards(spark: SparkSession, folder: str) -> DataFrame:
    planned = kd_shards.plan_shards(table(spark, folder, "documents"), shards=16)
    return planned.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op5_licence_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = licences.scan(table(spark, folder, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id",
        F.size("sentences").cast("bigint").alias("n_sentences"),
        F.array_join("sentences", ",").alias("sentences"),
        F.array_join("licences", ",").alias("licences"),
        "unmatched",
    )


def op6_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.judge(table(spark, folder, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op7_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.find(table(spark, folder, "documents").select("doc_id", "text"))
    base = F.filter("pii", lambda s: s["kind"].isin([k.name for k in pii.KINDS if k.base]))
    counts = [pii.count(F.col("pii"), kind.name).alias(f"n_{kind.name}") for kind in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(pii.shown(base), 256).alias("base_sha256"), pii.shown(F.col("pii")).alias("spans"), pii.scores(F.col("pii")).alias("scores"))


def op8_exact_top_k(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings").where(va_search.finite(F.col("embedding")))
    whole = vectors.select("vec_id", va_search.whole_numbers(F.col("embedding")).alias("vector"))
    return va_search.top_k(whole, F.col("vec_id") % 50 == 0, k=5)


def op9_language_id(spark: SparkSession, folder: str) -> DataFrame:
    found = lang_id.learn_and_identify(table(spark, folder, "documents").select("doc_id", "text", "lang"))
    return found.select("doc_id", "held_out", "lang_pred", "score", "rejected")


def op10_hnsw_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return hnsw_dedup.near_vectors(table(spark, folder, "embeddings"))


def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    return periodic_runs.digest(periodic_runs.collapse_runs(periodic_runs.plant(table(spark, folder, "documents"))))


def op12_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return toxicity.learn_and_score(docs, table(spark, folder, "labels")).select("doc_id", "held_out", "score", "predicted")


def op13_importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    ranked = importance.rank_documents(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return ranked.select("doc_id", "n_features", "weight", "score", "rank")


def registry() -> dict[str, Query]:
    found = [op1_minhash_near_dedup, op2_mix_sources, op3_sentencepiece, op4_kd_shards, op5_licence_scan, op6_url_filter, op7_personal_data, op8_exact_top_k, op9_language_id, op10_hnsw_near_dedup, op11_periodic_runs, op12_toxicity, op13_importance_resampling]
    return {query.__name__: query for query in found} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    return oracles.oracle_sql()
