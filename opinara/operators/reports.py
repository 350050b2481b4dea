"""Word reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from opinara.operators.selection import by_score

# The word the frequency report leaves out, and the length of the top lists.
EXCLUDED_WORDS = ["phone"]
TOP_WORDS = 10


def word_frequency(counts: DataFrame) -> DataFrame:
    return counts.groupBy("word").agg(F.sum("n").alias("frequency"))


def avg_tfidf_by_sentiment(scored: DataFrame) -> DataFrame:
    return scored.groupBy("word", "sentiment").agg(F.avg("tfidf").alias("avg_tfidf"))


def top_words_by_sentiment(averages: DataFrame, k: int = TOP_WORDS) -> DataFrame:
    """The k words of highest mean score of each sentiment, equal means in word order.

    Spark cuts each task's rows to k per sentiment before the shuffle (window group limit).
    """
    order = [by_score("avg_tfidf"), F.col("word").asc()]
    ranks = F.row_number().over(Window.partitionBy("sentiment").orderBy(*order))
    top = averages.withColumn("rank", ranks).filter(F.col("rank") <= k)
    return top.withColumn("rank", F.col("rank").cast("long"))


def feature_word_frequency(features: DataFrame) -> DataFrame:
    """How many reviews selected each word."""
    return features.groupBy("word").agg(F.count(F.lit(1)).alias("frequency"))


def head_preview(df: DataFrame, order: list, n: int = 10) -> DataFrame:
    """First n rows of a total order; Spark keeps only n rows per task."""
    return df.orderBy(*order).limit(n)
