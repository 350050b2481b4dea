"""Row-level operators on review frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinara.functions import text as fn
from opinara.functions.lemmas import lemmatize
from opinara.functions.stemming import stem_words
from opinara.operators.joins import keyed_lookup

# Output columns of the three cleaning variants, and the rating classes.
VARIANTS = {
    "plain": "cleaned_reviewText",
    "stemmed": "cleaned_reviewText_stemmed",
    "lemmatized": "cleaned_reviewText_lemmatized",
}
NEGATIVE_RATINGS = (1.0, 2.0)
POSITIVE_RATING = 5.0
POSITIVE, NEGATIVE = "POSITIVE", "NEGATIVE"


def clean_text(
    reviews: DataFrame,
    text: str = "reviewText",
    mode: str = "strip",
    variants: tuple[str, ...] = tuple(VARIANTS),
) -> DataFrame:
    """Replace `text` by its plain, stemmed and lemmatized variants; other columns stay.

    The first two come from the stop-word-filtered tokens, the last from the raw lower-cased
    text. The texts leave through a one-row generator: a filter on them, such as the
    multi-word filter, would otherwise be pushed below their computation and repeat it.
    """
    others = [c for c in reviews.columns if c != text]
    filtered = reviews.withColumn(
        "filtered_words", fn.remove_stopwords(fn.tokenize(F.col(text), mode))
    )
    build = {
        "plain": lambda: F.col("filtered_words"),
        "stemmed": lambda: stem_words(F.col("filtered_words")),
        "lemmatized": lambda: lemmatize(F.col(text)),
    }
    names = [VARIANTS[v] for v in variants]
    cleaned = filtered.select(
        *others, *[fn.join_tokens(build[v]()).alias(VARIANTS[v]) for v in variants]
    )
    return cleaned.select(*others, F.inline_outer(F.array(F.struct(*names))))


def is_negative() -> Column:
    return F.col("overall").isin(*NEGATIVE_RATINGS)


def is_positive() -> Column:
    return F.col("overall") == POSITIVE_RATING


def class_filter(reviews: DataFrame) -> DataFrame:
    """Ratings 1, 2 and 5; the undecided 3 and 4 and missing ratings go."""
    return reviews.filter(is_negative() | is_positive())


def sentiment_label(reviews: DataFrame) -> DataFrame:
    """POSITIVE for the top rating, NEGATIVE for everything else, missing ratings included."""
    return reviews.withColumn(
        "sentiment", F.when(is_positive(), POSITIVE).otherwise(NEGATIVE)
    )


def multiword(text: Column) -> Column:
    return fn.token_count(text) > 1


def multiword_filter(reviews: DataFrame, text: str) -> DataFrame:
    return reviews.filter(multiword(F.col(text)))


def explode_words(reviews: DataFrame, text: str = "text") -> DataFrame:
    """One row per piece between single spaces, empty pieces included."""
    return explode_rows(reviews.withColumn(text, fn.split_words(F.col(text))), text, "word")


def explode_rows(df: DataFrame, column: str, name: str) -> DataFrame:
    """Explode an array that holds no nulls.

    A plain explode makes Spark infer a filter on the array's size and push it, with all the
    expressions that build the array, down to the scan: the array is then built twice. The
    outer form with a filter behind it gives the same rows without that.
    """
    others = [c for c in df.columns if c != column]
    exploded = df.select(*others, F.explode_outer(column).alias(name))
    return exploded.filter(F.col(name).isNotNull())


def nonempty_tokens(words: DataFrame) -> DataFrame:
    return words.filter(F.col("word") != "")


def exclude_words(words: DataFrame, excluded: list[str] | DataFrame) -> DataFrame:
    """Rows whose word is not excluded. Long lists come as a table with a column `word`, which is
    joined, with the rows of frequent words spread; rows without a word stay then."""
    if isinstance(excluded, DataFrame):
        return keyed_lookup(words, excluded.select("word").distinct(), "word", "left_anti")
    return words.filter(~F.col("word").isin(*excluded))


def only_words(words: DataFrame, wanted: DataFrame) -> DataFrame:
    """Rows whose word is in the table `wanted`, joined in the same way."""
    return keyed_lookup(words, wanted.select("word").distinct(), "word", "left_semi")


def sentiment_slice(words: DataFrame, sentiment: str) -> DataFrame:
    return words.filter(F.col("sentiment") == sentiment)


def positive_score_filter(scored: DataFrame) -> DataFrame:
    return scored.filter(F.col("tfidf") > 0)
