"""The naive Bayes model: training counts, probabilities, scores and evaluation.

A model is its word counts (`word, pos_count, neg_count`) and its one-row statistics
(`reviews, pos_reviews, neg_reviews, pos_words, neg_words, vocabulary`). Statistics reach
expressions as scalar subqueries, which Spark runs once and inlines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinara.functions import text as fn
from opinara.operators.joins import keyed_lookup
from opinara.operators.reviews import NEGATIVE, POSITIVE
from opinara.operators.word_stats import unpack_bags

# How often a token counts in a score, as (non-empty, empty) weights. The
# reference behaviour counts non-empty tokens twice and empty ones once.
SCORE_WEIGHTS = {"reference": (2, 1), "standard": (1, 0)}
TIE_DIGITS = 9


def train_word_counts(features: DataFrame) -> DataFrame:
    """Reviews of each class that selected the word."""
    positive = F.col("sentiment") == POSITIVE
    return features.groupBy("word").agg(
        F.count_if(positive).alias("pos_count"), F.count_if(~positive).alias("neg_count")
    )


def vocabulary_size(word_counts: DataFrame) -> DataFrame:
    return word_counts.agg(F.count(F.lit(1)).alias("vocabulary"))


def with_vocabulary(statistics: DataFrame, word_counts: DataFrame) -> DataFrame:
    return statistics.withColumn("vocabulary", vocabulary_size(word_counts).scalar())


def class_priors(statistics: DataFrame) -> DataFrame:
    return statistics.select(
        F.try_divide("pos_reviews", "reviews").alias("pos_prior"),
        F.try_divide("neg_reviews", "reviews").alias("neg_prior"),
    )


def _denominator(statistics: DataFrame, side: str) -> Column:
    return statistics.select(F.col(f"{side}_words") + F.col("vocabulary")).scalar()


def word_probabilities(word_counts: DataFrame, statistics: DataFrame) -> DataFrame:
    """(count + 1) / (class words + vocabulary) for every word of the model."""
    return word_counts.select(
        "*",
        *[
            F.try_divide(F.col(f"{side}_count") + 1, _denominator(statistics, side)).alias(
                f"{side}_prob"
            )
            for side in ("pos", "neg")
        ],
    )


def review_bags(reviews: DataFrame, key: str = "review_id") -> DataFrame:
    """`key, bag` of test texts, without a shuffle."""
    return reviews.select(key, fn.word_bag(fn.split_words(F.col("text"))).alias("bag"))


def model_lookup_join(
    words: DataFrame, word_counts: DataFrame, statistics: DataFrame
) -> DataFrame:
    """Both class probabilities of each test word, 1 / denominator for words not in the model."""
    probabilities = word_probabilities(word_counts, statistics).select(
        "word", "pos_prob", "neg_prob"
    )
    joined = keyed_lookup(words, probabilities, "word", how="left")
    return joined.select(
        *words.columns,
        *[
            F.coalesce(
                f"{side}_prob", F.try_divide(F.lit(1), _denominator(statistics, side))
            ).alias(f"{side}_prob")
            for side in ("pos", "neg")
        ],
    )


def _log_prior(statistics: DataFrame, side: str) -> Column:
    prior = class_priors(statistics).select(f"{side}_prior").scalar()
    return F.when(prior > 0, F.ln(prior)).when(prior == 0, F.lit(float("-inf")))


def score_reviews(
    reviews: DataFrame,
    bags: DataFrame,
    word_counts: DataFrame,
    statistics: DataFrame,
    mode: str = "reference",
    key: str = "review_id",
) -> DataFrame:
    """Log-likelihood of each class: adds `pos_ll`, `neg_ll`.

    A known word's probability is (count + 1) times the unknown word's. So every token is first
    charged the unknown word's, from the token numbers in the row, and only known words then
    add ln(count + 1): an inner join, from which unknown words drop out, and a row-local part.
    `bags` are the `review_bags` of `reviews`; `key` must be unique.
    """
    weight, empty_weight = SCORE_WEIGHTS[mode]
    known = (
        keyed_lookup(unpack_bags(bags), word_counts, "word")
        .groupBy(key)
        .agg(
            *[
                F.sum(weight * F.col("n") * F.ln(F.col(f"{side}_count") + 1)).alias(f"{side}_known")
                for side in ("pos", "neg")
            ]
        )
    )
    pieces = fn.split_words(F.col("text"))
    n_words = F.size(F.array_remove(pieces, ""))
    tokens = n_words * weight + (F.size(pieces) - n_words) * empty_weight
    scored = reviews.withColumn("_tokens", tokens).join(known, key, "left")
    return scored.select(
        *reviews.columns,
        *[
            (
                _log_prior(statistics, side)
                - F.col("_tokens") * F.ln(_denominator(statistics, side))
                + F.coalesce(F.col(f"{side}_known"), F.lit(0.0))
            ).alias(f"{side}_ll")
            for side in ("pos", "neg")
        ],
    )


def predict_sentiment(scored: DataFrame) -> DataFrame:
    """POSITIVE when that class is likelier, NEGATIVE otherwise and for ties."""
    likelier = F.round(F.col("pos_ll") - F.col("neg_ll"), TIE_DIGITS) > 0
    return scored.withColumn("predicted", F.when(likelier, POSITIVE).otherwise(NEGATIVE))


def confusion_matrix(predictions: DataFrame) -> DataFrame:
    """One row `tp, fp, tn, fn` from `sentiment` (actual) and `predicted`."""
    actual, predicted = F.col("sentiment") == POSITIVE, F.col("predicted") == POSITIVE
    return predictions.agg(
        F.count_if(predicted & actual).alias("tp"),
        F.count_if(predicted & ~actual).alias("fp"),
        F.count_if(~predicted & ~actual).alias("tn"),
        F.count_if(~predicted & actual).alias("fn"),
    )


def classification_metrics(confusion: DataFrame) -> DataFrame:
    """Adds accuracy, precision, recall and f1; NULL where the denominator is 0."""
    tp, fp, tn, fn_ = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    return confusion.select(
        "*",
        F.try_divide(tp + tn, tp + fp + tn + fn_).alias("accuracy"),
        F.try_divide(tp, tp + fp).alias("precision"),
        F.try_divide(tp, tp + fn_).alias("recall"),
        F.try_divide(2 * tp, 2 * tp + fp + fn_).alias("f1"),
    )


def metrics_report(metrics: DataFrame) -> DataFrame:
    """The one-row metrics as `metric, value` lines."""
    names = ["tp", "fp", "fn", "tn", "accuracy", "precision", "recall", "f1"]
    doubles = metrics.select(*[F.col(n).cast("double") for n in names])
    return doubles.unpivot([], names, "metric", "value")
