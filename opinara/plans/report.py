"""Word reports over a training set, or over its stage files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opinara.operators import reports
from opinara.operators.reviews import NEGATIVE, POSITIVE, exclude_words, explode_words
from opinara.operators.reviews import nonempty_tokens
from opinara.plans.train import WordFrames
from opinara.session import materialize
from opinara.sources.readers import read_stage
from opinara.sources.writers import split_key


def _tables(frequency: DataFrame, scored: DataFrame, features: DataFrame) -> dict[str, DataFrame]:
    """The report tables by name. Mean scores are written once, two tables read them."""
    averages = materialize(reports.avg_tfidf_by_sentiment(scored), "mean-scores")
    return {
        "word_frequency": exclude_words(frequency, reports.EXCLUDED_WORDS),
        "avg_tfidf_by_sentiment": averages,
        "top_words_by_sentiment": reports.top_words_by_sentiment(averages),
        "feature_word_frequency": reports.feature_word_frequency(features),
    }


def word_reports(frames: WordFrames) -> dict[str, DataFrame]:
    return _tables(frames.frequencies.select("word", "frequency"), frames.scored, frames.features)


def stage_reports(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The same tables from the stage files `wordcount, tfidf, features` in a folder."""
    counts = split_key(
        read_stage(spark, f"{folder}/wordcount", "wordcount"), "word_review", ("word", "review"), last=True
    )
    scored = split_key(
        read_stage(spark, f"{folder}/tfidf", "tfidf"), "review_word", ("review", "word")
    ).withColumn("sentiment", F.when(F.endswith("review", F.lit("+")), POSITIVE).otherwise(NEGATIVE))
    texts = read_stage(spark, f"{folder}/features", "features")
    return _tables(
        reports.word_frequency(counts.withColumnRenamed("count", "n")),
        scored,
        nonempty_tokens(explode_words(texts.select("text"))),
    )
