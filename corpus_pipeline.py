"""The training-data pipeline: five stages over the documents, each written and read again."""

from __future__ import annotations

import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

import public_tokenizers  # noqa: E402
from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from opinara.llm import bpe, exact_dedup, language_id, mixing, near_dedup  # noqa: E402
from opinara.session import materialize  # noqa: E402

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages of the input; those that are rejected go."""
    return language_id.keep_identified(docs, language_id.fit(docs))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, that with the largest doc_id."""
    return exact_dedup.keep_one(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class, that with the smallest doc_id."""
    return near_dedup.keep_one(docs, heavy=near_dedup.EXACT)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixed_documents(docs, F.array("source"))


def tokenized(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document of the mix its token ids and the text they decode to."""
    return bpe.round_trip(docs, TOKENIZER)


STAGES = [
    ("language id", identified),
    ("exact dedup", exact_copies),
    ("near dedup", near_copies),
    ("mixing", mixed),
    ("bpe", tokenized),
]

# Learned languages, sampled classes and seeded selection have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to the documents; each reads what the one before it wrote."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
