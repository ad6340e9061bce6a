"""From raw documents to token ids: five stages, each written as Parquet and read again."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reportloom.llm import language_id, line_dedup, mixing, ngram_join, sentencepiece
from reportloom.session import materialize

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified; pages give hosts, suffixes and declared languages."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return language_id.accepted_only(docs, pages).select(*COLUMNS)


def new_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that repeat earlier ones, up to a replaced word; ``n_chars`` follows the text."""
    deduped = line_dedup.dedup_lines(docs, classes=line_dedup.BY_LENGTH)
    return deduped.withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def one_of_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return ngram_join.one_of_each(docs).select(*COLUMNS)


def target_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixed(docs).select(*COLUMNS)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids per document, and whether they decode to the text again."""
    model = public_tokenizers.path("piece_bpe_32k.model")
    coded = docs.select("doc_id", "lang", "source", "text", sentencepiece.encode_column(F.col("text"), model).alias("ids"))
    decoded = sentencepiece.decode_column(F.col("ids"), model)
    plain = F.coalesce(F.replace(F.col("text"), F.lit(sentencepiece.SPACE), F.lit(" ")), F.lit(""))
    return coded.select(
        "doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", (decoded == plain).alias("decodes")
    )


STAGES = [
    ("language ID", known_language),
    ("line dedup", new_lines),
    ("n-gram Jaccard join", one_of_near),
    ("mixing sources", target_mix),
    ("SentencePiece", token_ids),
]

ORACLE_SQL = None  # the language model, MinHash classes and token ids have no SQL form


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order on ``documents``; each works on all that the one before it kept."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
