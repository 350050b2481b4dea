"""Labelled texts -> features -> model -> evaluation.

Inputs are `review_id, overall, text`. By default ids are unique, as indexing makes them; then
counting needs no shuffle. With `one_row_per_review=False` training rows that share an id and a
sentiment form one review, and test rows are scored one by one whatever their ids.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinara.operators import keyed_models, selection, word_stats
from opinara.operators import naive_bayes as nb
from opinara.operators.reviews import VARIANTS, sentiment_label
from opinara.operators.sampling import in_train
from opinara.plans.prepare import balanced_variants, cleaned_classes
from opinara.session import materialize


@dataclass(frozen=True)
class WordFrames:
    """The intermediate frames of training. What several of them read is written, the rest lazy."""

    tf: DataFrame
    n_reviews: Column
    frequencies: DataFrame
    scored: DataFrame
    statistics: DataFrame
    one_row_per_review: bool
    #: Scored words dealt out by review, where that needs no shuffle of words.
    by_review: DataFrame | None = None

    @cached_property
    def selected(self) -> DataFrame:
        """The selected words for one reader, who finds them dealt out by review if `by_review`."""
        scored = self.scored if self.by_review is None else self.by_review
        return selection.feature_selection(scored, one_row_per_review=self.one_row_per_review)

    @cached_property
    def features(self) -> DataFrame:
        """The selected words, written when first asked for."""
        return materialize(self.selected, "features")


def word_frames(
    reviews: DataFrame, lines: DataFrame | None = None, one_row_per_review: bool = True
) -> WordFrames:
    """`lines` is the raw input when it has more rows than could be parsed: all of them count
    as reviews in the document frequency ratio.

    Written are the counted words, which document frequencies and the score join pass over, the
    frequencies, which the join and the class totals share, and, on demand, the selected features.
    Where the frequencies are few enough to be broadcast, words are scored where they are; for the
    selection the bags are shuffled by review then, not the words they unpack to.
    """
    labelled = sentiment_label(reviews)
    if one_row_per_review:
        bags = materialize(word_stats.bag_of_words(labelled), "bags")
        tf, rows = word_stats.bag_term_frequency(bags), bags
    else:
        counts = materialize(word_stats.word_count(labelled), "counts")
        tf, rows = materialize(word_stats.term_frequency(counts), "tf"), reviews
    n_reviews = word_stats.review_total(rows if lines is None else lines).scalar()
    frequencies = materialize(word_stats.document_frequency(tf), "frequencies")
    few, by_review = word_stats.few_words(frequencies), None
    scored = word_stats.tf_idf(tf, frequencies, n_reviews, few)
    if one_row_per_review:
        statistics = word_stats.class_statistics_of_bags(bags, frequencies, n_reviews)
        if few:
            dealt = word_stats.bag_term_frequency(word_stats.dealt_by_review(bags))
            by_review = word_stats.tf_idf(dealt, frequencies, n_reviews, few)
    else:
        statistics = word_stats.class_statistics(scored)
    return WordFrames(tf, n_reviews, frequencies, scored, statistics, one_row_per_review, by_review)


def train_model(frames: WordFrames) -> tuple[DataFrame, DataFrame]:
    """Word counts and statistics, both written: scoring reads each several times."""
    word_counts = materialize(nb.train_word_counts(frames.features), "model-words")
    statistics = materialize(nb.with_vocabulary(frames.statistics, word_counts), "model-statistics")
    return word_counts, statistics


def evaluate(
    test: DataFrame,
    word_counts: DataFrame,
    statistics: DataFrame,
    mode: str = "reference",
    one_row_per_review: bool = True,
) -> DataFrame:
    """Predictions of labelled test reviews, missing texts as empty ones. The test bags are
    written, as the bags above."""
    key = "review_id"
    test = test.withColumn("text", F.coalesce("text", F.lit("")))
    if not one_row_per_review:
        key = "row_id"
        test = materialize(test.withColumn(key, F.monotonically_increasing_id()), "test")
    bags = materialize(nb.review_bags(test, key), "test-bags")
    scored = nb.score_reviews(sentiment_label(test), bags, word_counts, statistics, mode, key)
    return nb.predict_sentiment(scored)


def train_and_evaluate(train: DataFrame, test: DataFrame, mode: str = "reference") -> DataFrame:
    """Confusion counts and metrics, one row."""
    word_counts, statistics = train_model(word_frames(train))
    predictions = evaluate(test, word_counts, statistics, mode)
    return nb.classification_metrics(nb.confusion_matrix(predictions))


def variant_comparison(reviews: DataFrame, mode: str = "reference") -> DataFrame:
    """Metrics of all text variants of raw reviews, one row each.

    Cleaning runs once, one pass over the cleaned texts counts the words of all variants' samples,
    and the variant is a key of the models: one chain of jobs trains and scores them all.
    """
    rows = sentiment_label(balanced_variants(cleaned_classes(reviews)))
    counted = keyed_models.bags(rows.withColumn("in_train", in_train()), "variant", "in_train")
    counted = materialize(counted, "variant-bags")
    models = keyed_models.train(counted.filter("in_train"), "variant")
    metrics = keyed_models.evaluate(models, counted.filter("NOT in_train"), mode)
    names = reviews.sparkSession.createDataFrame([(v,) for v in VARIANTS], "variant string")
    # A variant whose sample is empty has no model and no test rows.
    return names.join(metrics, "variant", "left").fillna(0, ["tp", "fp", "tn", "fn"])


def repeated_ids(reviews: DataFrame) -> DataFrame:
    """Review ids that several rows share."""
    return reviews.groupBy("review_id").count().filter("count > 1").select("review_id")
