"""Word counts, term frequency, document frequency and TF-IDF.

A review frame here has `review_id, sentiment, text`; (review_id, sentiment) names a review.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinara.functions import text as fn
from opinara.operators.joins import keyed_lookup
from opinara.operators.reviews import POSITIVE, nonempty_tokens
from opinara.session import materialize

REVIEW = ["review_id", "sentiment"]
#: Words whose frequencies are broadcast, at about a hundred bytes each.
MAX_WORDS = 1_000_000
WORDS_PER_TASK = 2_000_000


def bag_of_words(reviews: DataFrame) -> DataFrame:
    """`review_id, sentiment, review_len, bag`, computed row by row without a shuffle.

    Only for frames with one row per review.
    """
    words = fn.split_words(F.coalesce("text", F.lit("")))
    return reviews.select(
        *REVIEW,
        F.size(F.array_remove(words, "")).cast("long").alias("review_len"),
        fn.word_bag(words).alias("bag"),
    )


def unpack_bags(bags: DataFrame) -> DataFrame:
    """One row `word, n` per bag entry. The outer form for the reason given at `explode_rows`."""
    others = [c for c in bags.columns if c != "bag"]
    return bags.select(*others, F.inline_outer("bag")).filter(F.col("word").isNotNull())


def counted_words(rows: DataFrame, keys: list[str], words: str = "words") -> DataFrame:
    """Occurrences of each word, the empty one too, of an array in the rows of each key:
    `keys, word, n`. Runs jobs.

    Words are counted within their row and the counts written. Only those of keys that several
    rows share are added up by a shuffle: a task that groups the words of all its rows would hold
    each of them in memory, although hardly any two belong together.
    """
    bags = rows.select(*keys, fn.word_bag(F.col(words), keep_empty=True).alias("bag"))
    bags = materialize(bags, "bags")
    shared = bags.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    shared = materialize(shared.select(*(F.col(k).alias(f"_{k}") for k in keys)), "shared-keys")
    if shared.isEmpty():
        return unpack_bags(bags)
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    several = unpack_bags(bags.join(shared, same, "left_semi")).groupBy(*keys, "word")
    single = unpack_bags(bags.join(shared, same, "left_anti"))
    return single.unionByName(several.agg(F.sum("n").alias("n")))


def word_count(reviews: DataFrame, one_row_per_review: bool = False) -> DataFrame:
    """Occurrences of each word in each review: `review_id, sentiment, word, n`.

    Rows that share an id and a sentiment form one review. Callers that know there are none
    save the search for them, which runs jobs, with `one_row_per_review`.
    """
    if one_row_per_review:
        return unpack_bags(bag_of_words(reviews).drop("review_len"))
    words = reviews.select(*REVIEW, fn.split_words(F.col("text")).alias("words"))
    return nonempty_tokens(counted_words(words, REVIEW))


def review_total(lines: DataFrame) -> DataFrame:
    """Number of input lines, unusable ones included."""
    return lines.agg(F.count(F.lit(1)).alias("n_reviews"))


def _with_tf(counts: DataFrame) -> DataFrame:
    return counts.withColumn("tf", F.col("n") / F.col("review_len"))


def term_frequency(counts: DataFrame) -> DataFrame:
    """`review_id, sentiment, word, n, review_len, tf` from word counts.

    One id may hold much of the input here, so lengths are looked up like word totals.
    """
    per_review = counts.groupBy(*REVIEW).agg(
        F.sum("n").alias("review_len"), F.count(F.lit(1)).alias("n_rows")
    )
    joined = keyed_lookup(
        counts, per_review.drop("n_rows"), REVIEW, key_counts=per_review.drop("review_len")
    )
    return _with_tf(joined).select(*REVIEW, "word", "n", "review_len", "tf")


def bag_term_frequency(bags: DataFrame) -> DataFrame:
    """The same from bags, where the length is at hand and nothing is shuffled."""
    return _with_tf(unpack_bags(bags)).select(*REVIEW, "word", "n", "review_len", "tf")


def document_frequency(counts: DataFrame) -> DataFrame:
    """Reviews holding each word, in all and by class, and its occurrences:
    `word, df, pos_df, neg_df, frequency`."""
    positive = F.col("sentiment") == POSITIVE
    return counts.groupBy("word").agg(
        F.sum("n").alias("frequency"),
        F.count(F.lit(1)).alias("df"),
        F.count_if(positive).alias("pos_df"),
        F.count_if(~positive).alias("neg_df"),
    )


def dealt_by_review(bags: DataFrame) -> DataFrame:
    """Written bags shuffled by review. Runs a job.

    The number of tasks follows the words: adaptive execution would merge partitions by the bytes
    of the bags, which are a small part of those of the rows that they unpack to.
    """
    words = bags.agg(F.sum("review_len")).first()[0] or 0
    least = int(bags.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return bags.repartition(max(least, -(-words // WORDS_PER_TASK)), *REVIEW)


def few_words(frequencies: DataFrame) -> bool:
    """Whether a table of words may be broadcast. Runs a job."""
    return frequencies.count() <= MAX_WORDS


def tf_idf(
    tf: DataFrame, frequencies: DataFrame, n_reviews: Column, broadcast: bool = False
) -> DataFrame:
    """tf * ln(N / df), unsmoothed: a word of every review scores 0.

    With `broadcast`, for `few_words`, the rows of `tf` stay where they are.
    """
    df_table = frequencies.select("word", "df")
    if broadcast:
        scored = tf.join(F.broadcast(df_table), "word")
    else:
        scored = keyed_lookup(
            tf, df_table, "word", key_counts=df_table.withColumnRenamed("df", "n_rows")
        )
    return scored.withColumn("tfidf", F.col("tf") * F.ln(n_reviews / F.col("df")))


def class_statistics(scored: DataFrame) -> DataFrame:
    """Review and word totals by class, one row.

    The word totals count each review's words with a score above 0, before any selection.
    """
    per_review = scored.groupBy(*REVIEW).agg(F.count_if(F.col("tfidf") > 0).alias("n_words"))
    positive = F.col("sentiment") == POSITIVE
    return per_review.agg(
        F.count(F.lit(1)).alias("reviews"),
        F.count_if(positive).alias("pos_reviews"),
        F.count_if(~positive).alias("neg_reviews"),
        F.coalesce(F.sum(F.when(positive, F.col("n_words"))), F.lit(0)).alias("pos_words"),
        F.coalesce(F.sum(F.when(~positive, F.col("n_words"))), F.lit(0)).alias("neg_words"),
    )


def class_statistics_of_bags(
    bags: DataFrame, frequencies: DataFrame, n_reviews: Column
) -> DataFrame:
    """The same totals without scores: a score is above 0 exactly when df < N, so the word
    totals are sums over the vocabulary and the review totals need no grouping."""
    positive = F.col("sentiment") == POSITIVE
    words = frequencies.filter(F.col("df") < n_reviews)
    return (
        bags.filter(F.col("review_len") > 0)
        .agg(
            F.count(F.lit(1)).alias("reviews"),
            F.count_if(positive).alias("pos_reviews"),
            F.count_if(~positive).alias("neg_reviews"),
        )
        .withColumn("pos_words", words.agg(F.coalesce(F.sum("pos_df"), F.lit(0))).scalar())
        .withColumn("neg_words", words.agg(F.coalesce(F.sum("neg_df"), F.lit(0))).scalar())
    )
