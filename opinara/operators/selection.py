"""Ranking within groups and feature selection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opinara.operators.word_stats import REVIEW
from opinara.session import PARTITION_SHIFT, materialize

# Fixed value: share of each review's words that selection keeps.
KEPT_SHARE = 0.75
# Digits of the logarithm of a score to which scores count as equal, whatever their size.
SCORE_DIGITS = 11
# Runs of groups in sorted partitions that are broadcast, at about a hundred bytes each.
MAX_RUNS = 200_000


def by_score(score: str) -> Column:
    """Best score first; scores that differ only by rounding errors count as equal."""
    return F.round(F.ln(score), SCORE_DIGITS).desc_nulls_last()


def rank_in_groups(
    df: DataFrame, group: list[str], order: list[Column], bounded_groups: bool = False
) -> DataFrame:
    """Add `rank` (from 1, by `order`, which must be total) and `group_rows`.

    Groups known to fit a task take a window. Otherwise one global sort cuts even a single
    giant group into range partitions, and each run of a group in a partition gets the number
    of group rows before it: no task ever sees more than a partition. The sorted rows are
    written once, because both the runs and the final join need the same row positions. Runs
    are written and counted: up to MAX_RUNS, as a few large groups have, they are broadcast, and
    the sorted rows are not shuffled again; more are joined by a shuffle.
    """
    if bounded_groups:
        whole = Window.partitionBy(*group)
        return df.withColumn(
            "rank", F.row_number().over(whole.orderBy(*order)).cast("long")
        ).withColumn("group_rows", F.count(F.lit(1)).over(whole))
    ordered = df.orderBy(*group, *order).withColumn("_pos", F.monotonically_increasing_id())
    rows = materialize(ordered, "ranked").withColumn(
        "_slice", F.shiftright("_pos", PARTITION_SHIFT)
    )
    runs = rows.groupBy(*group, "_slice").agg(
        F.count(F.lit(1)).alias("_rows"), F.min("_pos").alias("_first")
    )
    whole = Window.partitionBy(*group)
    before = whole.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    runs = materialize(runs, "runs")
    few = runs.count() <= MAX_RUNS
    runs = runs.select(
        *[F.col(c).alias(f"_run_{c}") for c in [*group, "_slice"]],
        (F.col("_first") - F.coalesce(F.sum("_rows").over(before), F.lit(0)) - 1).alias("_base"),
        F.sum("_rows").over(whole).alias("group_rows"),
    )
    runs = F.broadcast(runs) if few else runs
    same_run = [F.col(c).eqNullSafe(F.col(f"_run_{c}")) for c in [*group, "_slice"]]
    return rows.join(runs, same_run).select(
        *df.columns, (F.col("_pos") - F.col("_base")).alias("rank"), "group_rows"
    )


def top_fraction_per_group(
    df: DataFrame,
    group: list[str],
    order: list[Column],
    fraction: float,
    bounded_groups: bool = False,
) -> DataFrame:
    """The best `ceil(fraction * n)` rows of each group of n, with their `rank`."""
    ranked = rank_in_groups(df, group, order, bounded_groups)
    return ranked.filter(F.col("rank") <= F.ceil(F.col("group_rows") * fraction)).drop("group_rows")


def feature_selection(
    scored: DataFrame, fraction: float = KEPT_SHARE, one_row_per_review: bool = False
) -> DataFrame:
    """Each review's best words by TF-IDF, equal scores in word order.

    When every review was one input row, its words fit one task.
    """
    order = [by_score("tfidf"), F.col("word").asc()]
    return top_fraction_per_group(
        scored.select(*REVIEW, "word", "tfidf"), REVIEW, order, fraction, one_row_per_review
    )


def feature_text(features: DataFrame) -> DataFrame:
    """Each review's kept words as one text, best word first.

    For reviews that fit a row. Where ids are shared, one id may hold much of the input; use the
    rows of `features`, which hold the same ranks and words, instead.
    """
    ranked = F.sort_array(F.collect_list(F.struct("rank", "word")))
    return (
        features.groupBy(*REVIEW)
        .agg(ranked.alias("ranked"))
        .select(*REVIEW, F.trim(F.array_join("ranked.word", " ")).alias("text"))
    )
