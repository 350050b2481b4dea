"""Class balancing, splitting, ordering and indexing.

All choices hash a row key, so they need no shuffle and no seed-dependent row order. Each use
has its own seed: one hash for both balancing and splitting would tie the two together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinara.functions.sampling import SEED, hash_fraction, hash_key
from opinara.operators.order_statistics import smallest_per_group
from opinara.operators.reviews import is_negative, is_positive
from opinara.session import PARTITION_SHIFT, materialize


def class_counts(reviews: DataFrame) -> DataFrame:
    """One row with both class sizes, from one pass."""
    return reviews.agg(
        F.count_if(is_negative()).alias("n_negative"),
        F.count_if(is_positive()).alias("n_positive"),
    )


def balanced_sample(
    reviews: DataFrame,
    key: str = "review_id",
    seed: int = SEED,
    fraction: float | None = None,
    exact: bool = False,
) -> DataFrame:
    """All negatives and a Bernoulli sample of positives of about the same size.

    `fraction`, the share of positives to keep, is counted if it is not given. With `exact` there
    are as many positives as negatives, or all if there are fewer: those with the smallest hashes,
    rows that share a key in the order of all their columns. That runs jobs.
    """
    if exact:
        return _exactly_balanced(reviews, key, seed)
    if fraction is None:
        counts = class_counts(reviews)
        share = F.least(F.lit(1.0), F.try_divide("n_negative", "n_positive"))
        kept = counts.select(share).scalar()
    else:
        kept = F.lit(fraction)
    sampled = hash_fraction(F.col(key), f"{seed}:balance") < kept
    return reviews.filter(is_negative() | (is_positive() & sampled))


def _exactly_balanced(reviews: DataFrame, key: str, seed: int) -> DataFrame:
    rows = reviews.withColumn("_class", F.when(is_negative(), "n").when(is_positive(), "p"))
    counts = rows.groupBy("_class").agg(F.count(F.lit(1)).alias("_wanted"))
    wanted = counts.agg(F.coalesce(F.sum(F.when(F.col("_class") == "n", F.col("_wanted"))), F.lit(0)).alias("_wanted"))
    hashed = F.coalesce(hash_key(F.col(key), f"{seed}:balance"), F.lit(""))
    positives = smallest_per_group(
        rows.filter("_class = 'p'"),
        "_class",
        hashed,
        wanted.select(F.lit("p").alias("_class"), "_wanted"),
        [F.col(c).asc() for c in (key, *(c for c in reviews.columns if c != key))],
    )
    return rows.filter("_class = 'n'").unionByName(positives).drop("_class")


def union_classes(negatives: DataFrame, positives: DataFrame) -> DataFrame:
    return negatives.unionByName(positives)


def train_test_split(
    reviews: DataFrame, key: str = "review_id", train: float = 0.8, seed: int = SEED
) -> tuple[DataFrame, DataFrame]:
    """Disjoint split that covers every row, the same under any partitioning."""
    chosen = in_train(key, train, seed)
    return reviews.filter(chosen), reviews.filter(~chosen)


def in_train(key: str = "review_id", train: float = 0.8, seed: int = SEED) -> Column:
    """Whether `train_test_split` puts a row into the first part."""
    return hash_fraction(F.col(key), f"{seed}:split") < train


def shuffled_rows(reviews: DataFrame, key: str = "review_id", seed: int = SEED) -> DataFrame:
    """Pseudo-random total order. A global sort: use it for exports only."""
    return reviews.orderBy(hash_key(F.col(key), f"{seed}:order"), key)


def index_rows(reviews: DataFrame, text: str, contiguous: bool = False) -> DataFrame:
    """Unique increasing index from 1 as first column.

    It has gaps between partitions unless `contiguous`. Then the rows are written once, because
    their places must not change between counting and numbering, and each partition's rows
    start after the number of rows before it: no task sees more than its partition.
    """
    place = F.monotonically_increasing_id()
    if not contiguous:
        return reviews.select((place + 1).alias("index"), "overall", F.col(text))
    placed = materialize(reviews.select(place.alias("_pos"), "overall", F.col(text)), "placed")
    part = F.shiftright("_pos", PARTITION_SHIFT)
    counts = placed.groupBy(part.alias("_part")).count().orderBy("_part").collect()
    starts, before = [], 0
    for row in counts:  # one row for each partition
        starts.append((row["_part"], before))
        before += row["count"]
    table = reviews.sparkSession.createDataFrame(starts, "_part long, _before long")
    within = F.col("_pos") - F.shiftleft(part, PARTITION_SHIFT)
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(table), "_part")
        .select((F.col("_before") + within + 1).alias("index"), "overall", text)
    )
