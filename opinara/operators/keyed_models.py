"""Naive Bayes models by key: one chain of jobs trains and evaluates a model for every key.

A key may be a text variant, a product category or a customer. Every frame of `word_stats` and
`naive_bayes` has the key as a further column here: words are counted by key and word, and the
totals of a model, which a single model reads as scalar subqueries, are a row of a table by key.
The number of models does not change the number of jobs.

Rows are `key, review_id, sentiment, text`, one for each review of a key. Lookups by key and word,
and of totals by key, are those of `joins`: a key that holds much of the input is spread. A null
key is no model: its rows are left out.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinara.functions import text as fn
from opinara.operators import naive_bayes as nb
from opinara.operators import selection
from opinara.operators.joins import keyed_lookup
from opinara.operators.reviews import POSITIVE
from opinara.operators.word_stats import unpack_bags
from opinara.session import materialize

#: Keys whose totals are broadcast, at about a hundred bytes each.
MAX_BROADCAST = 200_000


@dataclass(frozen=True)
class Models:
    """Trained models: `key, word, pos_count, neg_count` and one row of totals for each key."""

    key: str
    words: DataFrame
    statistics: DataFrame


def bags(reviews: DataFrame, key: str, *others: str) -> DataFrame:
    """`key, review_id, sentiment, review_len, n_pieces, bag` and `others`, without a shuffle."""
    pieces = fn.split_words(F.coalesce("text", F.lit("")))
    return reviews.filter(F.col(key).isNotNull()).select(
        key,
        "review_id",
        "sentiment",
        *others,
        F.size(F.array_remove(pieces, "")).cast("long").alias("review_len"),
        F.size(pieces).cast("long").alias("n_pieces"),
        fn.word_bag(pieces).alias("bag"),
    )


def _side(side: str):
    positive = F.col("sentiment") == POSITIVE
    return positive if side == "pos" else ~positive


def document_frequency(counts: DataFrame, key: str) -> DataFrame:
    """`key, word, df, pos_df, neg_df` from rows by key, review and word."""
    return counts.groupBy(key, "word").agg(
        F.count(F.lit(1)).alias("df"),
        *(F.count_if(_side(side)).alias(f"{side}_df") for side in ("pos", "neg")),
    )


def _review_totals(train_bags: DataFrame, key: str) -> DataFrame:
    """By key the reviews, those with words, and these by class."""
    worded = F.col("review_len") > 0
    return train_bags.groupBy(key).agg(
        F.count(F.lit(1)).alias("n_reviews"),
        F.count_if(worded).alias("reviews"),
        *(F.count_if(worded & _side(s)).alias(f"{s}_reviews") for s in ("pos", "neg")),
    )


def _with_totals(rows: DataFrame, totals: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """`rows` with the written `totals` of their keys, a row each: broadcast up to MAX_BROADCAST
    keys, beyond that looked up with the rows of hot keys spread."""
    if totals.count() <= MAX_BROADCAST:
        return rows.join(F.broadcast(totals), key, how)
    return keyed_lookup(rows, totals, key, how)


def train(train_bags: DataFrame, key: str) -> Models:
    """A model for each key of written `bags`. Writes the frequencies, words and totals.

    A word scores above 0 in a review exactly when it is not in all reviews of its key, so class
    word totals are sums over the frequencies.
    """
    counts = unpack_bags(train_bags.select(key, "review_id", "sentiment", "review_len", "bag"))
    reviews = materialize(_review_totals(train_bags, key), "keyed-reviews")
    frequencies = materialize(document_frequency(counts, key), "keyed-frequencies")
    frequencies = _with_totals(frequencies, reviews.select(key, "n_reviews"), key)
    scoring = F.col("df") < F.col("n_reviews")
    class_words = frequencies.groupBy(key).agg(
        *(
            F.sum(F.when(scoring, F.col(f"{s}_df")).otherwise(0)).alias(f"{s}_words")
            for s in ("pos", "neg")
        )
    )
    scored = keyed_lookup(
        counts,
        frequencies.select(key, "word", "n_reviews", "df"),
        [key, "word"],
        key_counts=frequencies.select(key, "word", F.col("df").alias("n_rows")),
    ).withColumn(
        "tfidf", F.col("n") / F.col("review_len") * F.ln(F.col("n_reviews") / F.col("df"))
    )
    chosen = selection.top_fraction_per_group(
        scored.select(key, "review_id", "sentiment", "word", "tfidf"),
        [key, "review_id", "sentiment"],
        [selection.by_score("tfidf"), F.col("word").asc()],
        selection.KEPT_SHARE,
        bounded_groups=True,
    )
    words = materialize(
        chosen.groupBy(key, "word").agg(
            *(F.count_if(_side(s)).alias(f"{s}_count") for s in ("pos", "neg"))
        ),
        "keyed-words",
    )
    vocabulary = words.groupBy(key).agg(F.count(F.lit(1)).alias("vocabulary"))
    statistics = (
        reviews.drop("n_reviews")
        .join(class_words, key, "left")
        .join(vocabulary, key, "left")
        .fillna(0, ["pos_words", "neg_words", "vocabulary"])
    )
    return Models(key, words, materialize(statistics, "keyed-statistics"))


def score(models: Models, test_bags: DataFrame, mode: str = "reference") -> DataFrame:
    """`key, review_id, sentiment, pos_ll, neg_ll` of written `bags`; keys without a model have
    null scores.

    As in `naive_bayes`, every token is first charged an unknown word's probability from the
    numbers in the row, and only known words are joined.
    """
    key = models.key
    weight, empty_weight = nb.SCORE_WEIGHTS[mode]
    sides = ("pos", "neg")
    known = (
        keyed_lookup(unpack_bags(test_bags.select(key, "review_id", "bag")), models.words, [key, "word"])
        .groupBy(key, "review_id")
        .agg(
            *(
                F.sum(weight * F.col("n") * F.ln(F.col(f"{s}_count") + 1)).alias(f"{s}_known")
                for s in sides
            )
        )
    )
    tokens = F.col("review_len") * weight + (F.col("n_pieces") - F.col("review_len")) * empty_weight
    rows = test_bags.select(key, "review_id", "sentiment", tokens.alias("tokens"))
    priors = models.statistics.select(
        key,
        *(
            F.when(F.col(f"{s}_reviews") > 0, F.ln(F.try_divide(f"{s}_reviews", "reviews")))
            .when(F.col("reviews") > 0, F.lit(float("-inf")))
            .alias(f"{s}_prior")
            for s in sides
        ),
        *(F.ln(F.col(f"{s}_words") + F.col("vocabulary")).alias(f"{s}_unknown") for s in sides),
    )
    charged = _with_totals(rows, priors, key, "left")
    return charged.join(known, [key, "review_id"], "left").select(
        key,
        "review_id",
        "sentiment",
        *(
            (
                F.col(f"{s}_prior")
                - F.col("tokens") * F.col(f"{s}_unknown")
                + F.coalesce(f"{s}_known", F.lit(0.0))
            ).alias(f"{s}_ll")
            for s in sides
        ),
    )


def evaluate(models: Models, test_bags: DataFrame, mode: str = "reference") -> DataFrame:
    """`key` with confusion counts and metrics, a row for each model, also one without test rows."""
    predicted = nb.predict_sentiment(score(models, test_bags, mode))
    positive = F.col("predicted") == POSITIVE
    cells = {
        "tp": positive & _side("pos"),
        "fp": positive & _side("neg"),
        "tn": ~positive & _side("neg"),
        "fn": ~positive & _side("pos"),
    }
    counted = predicted.groupBy(models.key).agg(
        *(F.count_if(cell).alias(name) for name, cell in cells.items())
    )
    every = models.statistics.select(models.key).join(counted, models.key, "left")
    return nb.classification_metrics(every.fillna(0, list(cells)))
