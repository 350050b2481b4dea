"""Exact deduplication that no group of copies can slow down.

Rows combine in three steps, each of which groups by the whole text beside its digest, so texts
with equal digests never meet: within a map task (the partial aggregate before the first
exchange), then within salted digest groups, then the winners of the salts globally. A group of
any size thus reaches a task as one row per map task and salt. Decisions go back to the rows
through digest marks on small rows, salted again; that two different texts share a mark is
checked, not assumed.

Null texts count as empty. The largest id of a group stays; a null id never wins over another.
Rows equal in both id and text cannot be told apart and share one decision: all are kept if
theirs is the id that stays. Empty tables give empty results. Extra columns, whatever their
names, are passed on by `keep_one` and ignored by `decisions`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinara.session import materialize

SALTS = 16
MARK = ("__sha", "__mark", "__length")


def _marked(docs: DataFrame, key: str, column: str, *kept: Column) -> DataFrame:
    """The row's id and text with marks of the text and a salt."""
    text = F.coalesce(F.col(column), F.lit(""))
    return docs.select(
        *kept,
        F.col(key).alias("__id"),
        text.alias("__text"),
        F.sha2(text.cast("binary"), 256).alias("__sha"),
        F.xxhash64(text).alias("__mark"),
        F.octet_length(text).alias("__length"),
        F.pmod(F.xxhash64(F.col(key)), F.lit(SALTS)).cast("int").alias("__salt"),
    )


def groups(docs: DataFrame, key: str = "doc_id", column: str = "text") -> DataFrame:
    """One row per different text: its marks, `keep_id` and `group_size`."""
    winners = (
        _marked(docs, key, column)
        .groupBy(*MARK, "__text", "__salt")
        .agg(F.max("__id").alias("keep_id"), F.count(F.lit(1)).alias("n"))
    )
    return (
        winners.groupBy(*MARK, "__text")
        .agg(F.max("keep_id").alias("keep_id"), F.sum("n").alias("group_size"))
        .drop("__text")
    )


def _with_decisions(rows: DataFrame, docs: DataFrame, key: str, column: str) -> DataFrame:
    table = materialize(groups(docs, key, column), "equal-texts")
    shared = table.groupBy(*MARK).count().filter("count > 1")
    if not shared.isEmpty():
        raise ValueError("different texts share SHA-256, xxHash64 and length")
    copied = table.filter("group_size > 1").withColumn(
        "__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    )
    keep = F.when(F.col("group_size").isNull(), F.col("__id")).otherwise(F.col("keep_id"))
    return (
        rows.join(copied, [*MARK, "__salt"], "left")
        .withColumn("keep_id", keep)
        .withColumn("kept", F.col("keep_id").eqNullSafe(F.col("__id")))
        .withColumn("group_size", F.coalesce("group_size", F.lit(1).cast("long")))
    )


def decisions(docs: DataFrame, key: str = "doc_id", column: str = "text") -> DataFrame:
    """Every row's id with `keep_id, group_size, kept, text_sha256`. Runs a job.

    The groups are written once, without their texts, to the shared folder.
    """
    rows = _marked(docs, key, column).drop("__text")
    return _with_decisions(rows, docs, key, column).select(
        F.col("__id").alias(key),
        "keep_id",
        "group_size",
        "kept",
        F.col("__sha").alias("text_sha256"),
    )


def keep_one(docs: DataFrame, key: str = "doc_id", column: str = "text") -> DataFrame:
    """The rows of `docs` that stay, with all their columns. Runs a job."""
    whole = F.struct(*(docs[f"`{c}`"] for c in docs.columns)).alias("__row")
    rows = _marked(docs, key, column, whole).drop("__text")
    return _with_decisions(rows, docs, key, column).filter("kept").select("__row.*")
