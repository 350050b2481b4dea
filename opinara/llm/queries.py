"""Registered queries of the numbered operators, over whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opinara.llm import (
    bpe,
    conversations,
    exact_dedup,
    imatch,
    importance,
    language_id,
    line_quality,
    mixing,
    near_dedup,
    token_counter,
    token_files,
    url_filter,
    warc,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
WORD_BPE = "word_bpe_49k.json"
URL_RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)


def query(build: Callable[[SparkSession, str], DataFrame]):
    QUERIES[build.__name__] = build
    return build


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op1_imatch(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return imatch.edited_fingerprints(docs, imatch.lexicon(docs))


@query
def op2_bpe_codec(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path(WORD_BPE)
    coded = bpe.round_trip(table(spark, folder, "documents"), path)
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@query
def op3_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    found = language_id.identify(docs, language_id.fit(docs))
    return found.withColumn("held_out", language_id.held_out())


@query
def op4_warc(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    collection = warc.write(pages)
    keys = pages.select("page_id", "url").mapInArrow(warc.page_keys, "key string")
    return warc.read(collection, warc.lookup(collection, keys)).drop("html")


@query
def op5_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.judge(table(spark, folder, "pages"), URL_RULES)


@query
def op6_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return mixing.mix(docs, F.array("source")).select(
        "doc_id",
        "size",
        F.col("source_sizes")[0].alias("source_size"),
        F.col("targets")[0].alias("target"),
        "taken",
        F.col("pattern")[0].alias("source"),
        "passes",
    )


@query
def op7_token_files(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path(WORD_BPE)
    shards = token_files.placed(token_files.write(table(spark, folder, "documents"), path))
    return token_files.checksums(shards)


@query
def op8_token_counter(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").withColumn(
        "n_bytes", F.octet_length(F.coalesce("text", F.lit(""))).cast("long")
    )
    path = public_tokenizers.path(WORD_BPE)
    counted = token_counter.count_tokens(docs, path, ("doc_id", "n_bytes"))
    return counted.withColumn("over_limit", F.col("n_tokens") > 2048)


@query
def op9_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.decisions(table(spark, folder, "documents"))


@query
def op10_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.classes(table(spark, folder, "documents"), heavy=near_dedup.EXACT)


@query
def op11_line_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    field = line_quality.fit(docs, table(spark, folder, "labels"))
    return line_quality.score(docs, field).withColumn("held_out", line_quality.held_out())


@query
def op12_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    rows = conversations.damaged(table(spark, folder, "conversations"))
    return conversations.audits(rows)


@query
def op13_importance(spark: SparkSession, folder: str) -> DataFrame:
    return importance.resample(
        table(spark, folder, "documents"), table(spark, folder, "benchmark")
    )
