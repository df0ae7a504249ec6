"""From raw documents to token ids and back: five stages, each written before the next one reads it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkrisk.llm import mixing, near_duplicates, personal_data, pieces, quality_rules
from sparkrisk.session import materialize

VOCABULARY = "piece_bpe_32k.model"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go that fail the rules for texts, or whose host fails."""
    return quality_rules.filter_documents(docs)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return near_duplicates.keep_one(docs)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data gives way to its kind."""
    return personal_data.redact(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents stay as often as the mix of their sources takes them."""
    return mixing.mixed_rows(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids and the text they decode to, of every document and repeat."""
    import public_tokenizers

    return pieces.encode_table(docs, public_tokenizers.path(VOCABULARY)).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "decoded")


STAGES = [("quality rules", quality), ("near duplicates", deduplicate), ("personal data", redact), ("mixing", mix), ("pieces", encode)]

#: Shingle sets and piece merges are beyond SQL; tests compare run() with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
