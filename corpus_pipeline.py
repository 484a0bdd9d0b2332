"""A training corpus from ``documents``: STAGES in order, each over all that its predecessor kept.

Every stage is written to the shared folder and read back, so a lost executor costs one stage's task, not the pipeline.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow.llm import lang_id, mixing, near_dedup, pieces, pii
from tillflow.llm.common import materialise, table
from tillflow.llm.tokenizers import tokenizer_model


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the models recognise; those they reject, and those without a letter, go."""
    return lang_id.learn_and_identify(docs).where("NOT rejected").select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return near_dedup.deduplicate(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by the name of its kind; ``n_chars`` follows the text."""
    clean = pii.redact(docs)
    return clean.withColumn("n_chars", F.length("text").cast("bigint")) if "n_chars" in docs.columns else clean


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of the sources takes them."""
    return mixing.mix(docs)


def sentence_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document of the mix, with a checksum of what they decode to."""
    encoded = pieces.encode(docs.select("doc_id", "lang", "source", "text"), tokenizer_model(), decoded=True)
    n_tokens, checksum = F.array_size("ids").cast("bigint"), F.sha2("decoded", 256)
    return encoded.select("doc_id", "lang", "source", "ids", n_tokens.alias("n_tokens"), checksum.alias("decoded_sha256"))


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("mix_sources", mix_sources),
    ("sentence_pieces", sentence_pieces),
]

#: Language models, MinHash and SentencePiece are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir))
    return docs
