"""Registered queries: each maps a session and a table folder to a DataFrame.

Doubles are rounded to six digits, because the two engines add in different orders.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opinara.functions import text as fn
from opinara.functions.lemmas import lemmatize
from opinara.functions.sampling import hash_key
from opinara.functions.stemming import stem_words
from opinara.operators import naive_bayes as nb
from opinara.operators import (
    order_statistics,
    reports,
    reviews,
    sampling,
    selection,
    word_stats,
)
from opinara.operators.reviews import VARIANTS
from opinara.plans import prepare, report, train
from opinara.session import materialize, scratch_path
from opinara.sources import inferred, readers, writers

DIGITS = 6
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


class Tables:
    """The test tables as the frames the operators work on."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @property
    def reviews(self) -> DataFrame:
        return readers.reviews_from_documents(self.table("documents"), self.table("labels"))

    @property
    def words(self) -> DataFrame:
        """Every review with its filtered tokens."""
        return self.reviews.withColumn("words", fn.tokenize_strip(F.col("reviewText")))

    @property
    def texts(self) -> DataFrame:
        """Every review with its plain cleaned text, `review_id, overall, text`."""
        return reviews.clean_text(self.reviews, variants=("plain",)).select(
            "review_id", "overall", F.col(VARIANTS["plain"]).alias("text")
        )

    @property
    def labelled(self) -> DataFrame:
        return reviews.sentiment_label(self.texts)

    @property
    def counts(self) -> DataFrame:
        return word_stats.word_count(self.labelled, one_row_per_review=True)

    @property
    def frames(self) -> train.WordFrames:
        return train.word_frames(self.texts)

    @property
    def classes(self) -> DataFrame:
        """Multi-word reviews of the two classes, plain text."""
        cleaned = prepare.cleaned_classes(self.reviews, ("plain",))
        return reviews.multiword_filter(
            cleaned.select("review_id", "overall", F.col(VARIANTS["plain"]).alias("text")), "text"
        )

    @property
    def balanced(self) -> DataFrame:
        cleaned = prepare.cleaned_classes(self.reviews, ("plain",))
        return prepare.balanced_variant(cleaned, "plain")

    def split(self) -> tuple[DataFrame, DataFrame]:
        return sampling.train_test_split(self.balanced)

    def model(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        """Test set, word counts and statistics of the plain variant."""
        train_set, test_set = self.split()
        return test_set, *train.train_model(train.word_frames(train_set))

    def predictions(self, mode: str = "reference") -> DataFrame:
        return train.evaluate(*self.model(), mode)


def query(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    QUERIES[build.__name__] = lambda spark, folder: build(Tables(spark, folder))
    return build


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, DIGITS) for c in columns})


# Sources and sinks


@query
def json_reviews(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "json")
    t.reviews.write.json(path)
    schema = f"review_id long, {readers.JSON_REVIEW_SCHEMA}"
    return readers.read_json_reviews(t.spark, path, schema)


def _mixed_json(t: Tables) -> str:
    """Reviews as JSON lines with every third rating quoted, nested fields and a bad line in fifty."""
    path = scratch_path(t.spark, "mixed")
    id_, rating = F.col("review_id"), F.col("overall")
    row = F.to_json(
        F.struct(
            "review_id",
            F.when(id_ % 3 != 0, rating).alias("overall"),
            F.when(id_ % 3 == 0, rating.cast("string")).alias("quoted"),
            "reviewText",
            F.struct((id_ % 5).alias("stars")).alias("extra"),
        )
    )
    row = F.replace(row, F.lit('"quoted":'), F.lit('"overall":'))
    line = F.when(id_ % 50 == 0, F.concat(F.lit("[1] "), id_.cast("string"))).otherwise(row)
    t.reviews.select(line.alias("value")).write.text(path)
    return path


@query
def json_reviews_inferred(t: Tables) -> DataFrame:
    """Reviews and rejected lines, with 0 for their ids, in one frame."""
    rows, _, rejects = inferred.read_json_inferred(t.spark, _mixed_json(t))
    return rows.withColumn("rejected", F.lit(None).cast("string")).unionByName(
        rejects.select(F.lit(0).cast("long").alias("review_id"), F.col("value").alias("rejected")),
        allowMissingColumns=True,
    )


@query
def json_field_types(t: Tables) -> DataFrame:
    return inferred.json_field_types(t.spark.read.text(_mixed_json(t)))


@query
def csv_reviews(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "csv")
    writers.write_csv(t.texts, path)
    return readers.read_csv_reviews(t.spark, path)


@query
def lenient_lines(t: Tables) -> DataFrame:
    """One-line texts behind id and rating, 0 if unrated, and a bad line for each hundredth id:
    one of two fields or one whose rating is no number. Reviews and rejects in one frame."""
    one_line = F.regexp_replace("reviewText", r"[\r\n]+", " ")
    rating = F.coalesce(F.col("overall").cast("string"), F.lit("0.0"))
    line = F.concat_ws(",", "review_id", rating, one_line)
    id_ = F.col("review_id")
    bad = F.when(id_ % 200 == 0, F.concat(id_, F.lit(",5.0,,"))).when(
        id_ % 200 == 100, F.concat(id_, F.lit(",five,text"))
    )
    path = scratch_path(t.spark, "lines")
    lines = t.reviews.select(F.explode(F.array_compact(F.array(line, bad))).alias("value"))
    lines.write.text(path)
    lines = readers.read_lines(t.spark, path)
    good = readers.lenient_lines(lines, drop_bad_ratings=True)
    rejected = readers.rejected_lines(lines).select(
        F.col("value").alias("review_id"), F.lit(None).cast("double").alias("overall"),
        F.col("reason").alias("text"),
    )
    return good.unionByName(rejected)


@query
def tsv_stage_scan(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "wordcount")
    writers.write_tsv(writers.stage_wordcount(t.counts), path)
    stage = readers.read_stage(t.spark, path, "wordcount")
    return writers.split_key(stage, "word_review", ("word", "review"), last=True)


@query
def csv_export(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "csv")
    writers.write_csv(t.texts.select("overall", "text"), path)
    return readers.read_csv_reviews(t.spark, path, readers.BALANCED_SCHEMA)


@query
def csv_line_breaks(t: Tables) -> DataFrame:
    """Whole texts with line breaks, quotes and backslashes put in for some letters."""
    text = F.coalesce("reviewText", F.lit(""))
    for letter, characters in (("a", "\n"), ("e", "\r\n"), ("i", '"'), ("o", "\\n"), ("u", "\\")):
        text = F.replace(text, F.lit(letter), F.lit(characters))
    path = scratch_path(t.spark, "breaks")
    rows = t.reviews.select(F.col("review_id").alias("index"), "overall", text.alias("text"))
    writers.write_csv(rows, path)
    return readers.read_csv_reviews(t.spark, path)


@query
def tsv_export(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "tf")
    tf = word_stats.bag_term_frequency(word_stats.bag_of_words(t.labelled))
    writers.write_tsv(writers.stage_tf(tf), path)
    return readers.read_stage(t.spark, path, "tf")


@query
def overwrite_sink(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "training")
    stage = writers.stage_training(materialize(nb.train_word_counts(t.counts), "model-words"))
    for _ in range(2):
        writers.write_tsv(stage, path, mode="overwrite")
    return readers.read_stage(t.spark, path, "training")


@query
def merged_export(t: Tables) -> DataFrame:
    source, target = scratch_path(t.spark, "features"), scratch_path(t.spark, "merged")
    writers.write_tsv(writers.stage_features(selection.feature_text(t.frames.selected)), source)
    writers.merged_export(t.spark, source, target)
    return readers.read_stage(t.spark, target, "features")


@query
def metrics_report(t: Tables) -> DataFrame:
    metrics = nb.classification_metrics(nb.confusion_matrix(t.predictions()))
    return rounded(nb.metrics_report(metrics), "value")


# Projections and filters


@query
def project_review_columns(t: Tables) -> DataFrame:
    return t.reviews.select("overall", "reviewText")


@query
def rename_columns(t: Tables) -> DataFrame:
    return t.texts.select("review_id", "text").withColumnsRenamed(
        {"review_id": "column_1", "text": "column_2"}
    )


@query
def multiword_filter(t: Tables) -> DataFrame:
    return reviews.multiword_filter(t.texts, "text")


@query
def class_filter(t: Tables) -> DataFrame:
    return reviews.class_filter(t.reviews)


@query
def sentiment_label(t: Tables) -> DataFrame:
    return reviews.sentiment_label(t.reviews.select("review_id", "overall"))


@query
def nonempty_tokens(t: Tables) -> DataFrame:
    pieces = fn.split_words(fn.lowercase_text(F.col("reviewText")))
    raw = t.reviews.select("review_id", pieces.alias("words"))
    return reviews.nonempty_tokens(word_stats.counted_words(raw, ["review_id"]))


@query
def exclude_words(t: Tables) -> DataFrame:
    return reviews.exclude_words(reports.word_frequency(t.counts), reports.EXCLUDED_WORDS)


@query
def exclude_word_table(t: Tables) -> DataFrame:
    """Occurrences by review of the words that no benchmark text has, all others anti-joined."""
    items = t.table("benchmark").select(F.explode(fn.tokenize_strip(F.col("text"))).alias("word"))
    return reviews.exclude_words(t.counts, items)


@query
def only_word_table(t: Tables) -> DataFrame:
    items = t.table("benchmark").select(F.explode(fn.tokenize_strip(F.col("text"))).alias("word"))
    return reviews.only_words(t.counts, items)


@query
def sentiment_slice(t: Tables) -> DataFrame:
    averages = reports.avg_tfidf_by_sentiment(t.frames.scored)
    return rounded(reviews.sentiment_slice(averages, reviews.NEGATIVE), "avg_tfidf")


@query
def positive_score_filter(t: Tables) -> DataFrame:
    return reviews.positive_score_filter(t.frames.scored).select("review_id", "word")


# Text functions


@query
def lowercase_text(t: Tables) -> DataFrame:
    return t.reviews.select("review_id", fn.lowercase_text(F.col("reviewText")).alias("text"))


@query
def tokenize_strip(t: Tables) -> DataFrame:
    return word_stats.counted_words(t.words, ["review_id"])


@query
def tokenize_literal(t: Tables) -> DataFrame:
    return t.reviews.select(
        "review_id", fn.join_tokens(fn.tokenize_literal(F.col("reviewText"))).alias("tokens")
    )


@query
def remove_stopwords(t: Tables) -> DataFrame:
    kept = fn.remove_stopwords(F.col("words"))
    return t.words.select("review_id", F.size(kept).alias("n_words"), fn.join_tokens(kept).alias("text"))


@query
def stem_words_(t: Tables) -> DataFrame:
    kept = t.words.select("review_id", fn.remove_stopwords(F.col("words")).alias("words"))
    return kept.select("review_id", fn.join_tokens(stem_words(F.col("words"))).alias("text"))


@query
def lemmatize_words(t: Tables) -> DataFrame:
    return t.reviews.select(
        "review_id", fn.join_tokens(lemmatize(F.col("reviewText"))).alias("text")
    )


@query
def join_tokens(t: Tables) -> DataFrame:
    return t.words.select("review_id", fn.join_tokens(F.col("words")).alias("text"))


@query
def explode_words(t: Tables) -> DataFrame:
    return reviews.explode_words(t.texts.select("review_id", "text"))


@query
def token_count(t: Tables) -> DataFrame:
    return t.texts.select("review_id", fn.token_count(F.col("text")).alias("n_tokens"))


@query
def clean_text(t: Tables) -> DataFrame:
    return reviews.clean_text(t.reviews)


@query
def composite_key(t: Tables) -> DataFrame:
    keyed = writers.stage_wordcount(t.counts)
    return writers.split_key(
        keyed.withColumn("whole_key", F.col("word_review")),
        "word_review",
        ("word", "review"),
        last=True,
    )


@query
def trimmed_text(t: Tables) -> DataFrame:
    return t.reviews.select("review_id", F.trim("reviewText").alias("text"))


# Sampling, splitting, indexing


@query
def class_counts(t: Tables) -> DataFrame:
    return sampling.class_counts(t.reviews)


@query
def balanced_sample(t: Tables) -> DataFrame:
    return t.balanced


@query
def balanced_sample_exact(t: Tables) -> DataFrame:
    """Classes of equal size."""
    return sampling.balanced_sample(t.classes, exact=True)


@query
def smallest_per_group(t: Tables) -> DataFrame:
    """A tenth of the lines of one flag and a third of each other's, by a hash."""
    lines = t.table("lineitem").select("l_returnflag", "l_orderkey", "l_linenumber")
    share = F.when(F.col("l_returnflag") == "N", 10).otherwise(3)
    wanted = lines.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"))
    wanted = wanted.select("l_returnflag", F.floor(F.col("n") / share).alias("_wanted"))
    key = hash_key(F.concat_ws("-", "l_orderkey", "l_linenumber"))
    ties = [F.col("l_orderkey").asc(), F.col("l_linenumber").asc()]
    return order_statistics.smallest_per_group(lines, "l_returnflag", key, wanted, ties, few=100)


@query
def union_classes(t: Tables) -> DataFrame:
    classes = t.reviews
    return sampling.union_classes(
        classes.filter(reviews.is_negative()), classes.filter(reviews.is_positive())
    )


@query
def shuffled_rows(t: Tables) -> DataFrame:
    return sampling.shuffled_rows(t.texts)


@query
def train_test_split(t: Tables) -> DataFrame:
    parts = [
        part.select("review_id", "overall", F.lit(name).alias("part"))
        for name, part in zip(("train", "test"), t.split())
    ]
    return reduce(DataFrame.unionByName, parts)


@query
def index_rows(t: Tables) -> DataFrame:
    """Index values depend on the partitioning; what must hold is checked instead."""
    indexed = sampling.index_rows(t.texts, "text")
    return indexed.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct("index").alias("n_indexes"),
        (F.min("index") >= 1).alias("from_one"),
    )


@query
def index_rows_contiguous(t: Tables) -> DataFrame:
    """Consecutive numbers in the pseudo-random order."""
    return sampling.index_rows(sampling.shuffled_rows(t.texts), "text", contiguous=True)


# Word statistics


@query
def word_count(t: Tables) -> DataFrame:
    return word_stats.word_count(t.labelled)


@query
def review_total(t: Tables) -> DataFrame:
    return word_stats.review_total(t.table("documents"))


@query
def term_frequency(t: Tables) -> DataFrame:
    counts = materialize(word_stats.word_count(t.labelled), "counts")
    return rounded(word_stats.term_frequency(counts), "tf")


@query
def document_frequency(t: Tables) -> DataFrame:
    return word_stats.document_frequency(t.counts)


@query
def tf_idf(t: Tables) -> DataFrame:
    return rounded(t.frames.scored, "tf", "tfidf")


@query
def feature_selection(t: Tables) -> DataFrame:
    return rounded(t.frames.selected, "tfidf")


@query
def feature_text(t: Tables) -> DataFrame:
    return selection.feature_text(t.frames.selected)


@query
def class_statistics(t: Tables) -> DataFrame:
    return word_stats.class_statistics(t.frames.scored)


@query
def word_frequency(t: Tables) -> DataFrame:
    return reports.word_frequency(t.counts)


@query
def avg_tfidf_by_sentiment(t: Tables) -> DataFrame:
    return rounded(reports.avg_tfidf_by_sentiment(t.frames.scored), "avg_tfidf")


@query
def feature_word_frequency(t: Tables) -> DataFrame:
    return reports.feature_word_frequency(t.frames.selected)


# Naive Bayes


@query
def train_word_counts(t: Tables) -> DataFrame:
    return nb.train_word_counts(train.word_frames(t.split()[0]).features)


@query
def vocabulary_size(t: Tables) -> DataFrame:
    return nb.vocabulary_size(train_word_counts(t))


@query
def class_priors(t: Tables) -> DataFrame:
    statistics = train.word_frames(t.split()[0]).statistics
    return rounded(nb.class_priors(statistics), "pos_prior", "neg_prior")


@query
def word_probabilities(t: Tables) -> DataFrame:
    _, counts, statistics = t.model()
    return nb.word_probabilities(counts, statistics).withColumns(
        {c: F.round(c, 9) for c in ("pos_prob", "neg_prob")}
    )


@query
def score_reviews(t: Tables) -> DataFrame:
    return rounded(t.predictions().select("review_id", "pos_ll", "neg_ll"), "pos_ll", "neg_ll")


@query
def score_reviews_standard(t: Tables) -> DataFrame:
    scored = t.predictions("standard")
    return rounded(scored.select("review_id", "pos_ll", "neg_ll"), "pos_ll", "neg_ll")


@query
def predict_sentiment(t: Tables) -> DataFrame:
    return t.predictions().select("review_id", "text", "predicted")


@query
def confusion_matrix(t: Tables) -> DataFrame:
    return nb.confusion_matrix(t.predictions())


@query
def classification_metrics(t: Tables) -> DataFrame:
    metrics = nb.classification_metrics(nb.confusion_matrix(t.predictions()))
    return rounded(metrics, "accuracy", "precision", "recall", "f1")


@query
def model_lookup_join(t: Tables) -> DataFrame:
    test, counts, statistics = t.model()
    words = word_stats.unpack_bags(materialize(nb.review_bags(test), "test-bags"))
    joined = nb.model_lookup_join(words, counts, statistics)
    return joined.withColumns({c: F.round(c, 9) for c in ("pos_prob", "neg_prob")})


@query
def scalar_stats_join(t: Tables) -> DataFrame:
    """Job-wide totals next to each word's document frequency."""
    n_reviews = word_stats.review_total(t.table("documents")).scalar()
    frequencies = word_stats.document_frequency(t.counts).select("word", "df")
    return frequencies.withColumn("n_reviews", n_reviews)


# Ranking


@query
def top_fraction_per_group(t: Tables) -> DataFrame:
    lines = t.table("lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    order = [F.col("l_extendedprice").desc(), F.col("l_linenumber").asc()]
    return selection.top_fraction_per_group(
        lines, ["l_orderkey"], order, selection.KEPT_SHARE, bounded_groups=True
    )


@query
def top_fraction_of_large_groups(t: Tables) -> DataFrame:
    """The same operator where each group holds about a third of the table."""
    lines = t.table("lineitem").select(
        "l_returnflag", "l_orderkey", "l_linenumber", "l_extendedprice"
    )
    order = [F.col("l_extendedprice").desc(), F.col("l_orderkey"), F.col("l_linenumber")]
    return selection.top_fraction_per_group(lines, ["l_returnflag"], order, selection.KEPT_SHARE)


@query
def top_words_by_sentiment(t: Tables) -> DataFrame:
    averages = reports.avg_tfidf_by_sentiment(t.frames.scored)
    return rounded(reports.top_words_by_sentiment(averages), "avg_tfidf")


@query
def head_preview(t: Tables) -> DataFrame:
    return reports.head_preview(t.counts, ["review_id", "word"])


# Whole jobs


@query
def prepare_datasets(t: Tables) -> DataFrame:
    """Writes the nine datasets and sums up what arrived in each: class sizes, the lengths of
    the texts, and a checksum of ratings and texts that no order changes."""
    summaries = []
    for name, path in prepare.prepare_datasets(t.reviews, scratch_path(t.spark, "datasets")).items():
        schema = readers.BALANCED_SCHEMA if name.startswith("final") else readers.CSV_REVIEW_SCHEMA
        rows = readers.read_csv_reviews(t.spark, path, schema)
        mark = F.conv(F.substring(F.md5(F.concat_ws(":", F.col("overall").cast("int"), "text")), 1, 8), 16, 10)
        summaries.append(
            rows.agg(
                F.lit(name).alias("dataset"),
                F.count_if(reviews.is_negative()).alias("n_negative"),
                F.count_if(reviews.is_positive()).alias("n_positive"),
                F.sum(F.length("text")).alias("n_characters"),
                F.sum(mark.cast("long")).alias("checksum"),
            )
        )
    return reduce(DataFrame.unionByName, summaries)


@query
def train_and_evaluate(t: Tables) -> DataFrame:
    metrics = train.train_and_evaluate(*t.split())
    return rounded(metrics, "accuracy", "precision", "recall", "f1")


@query
def variant_comparison(t: Tables) -> DataFrame:
    return rounded(
        train.variant_comparison(t.reviews), "accuracy", "precision", "recall", "f1"
    )


@query
def word_reports(t: Tables) -> DataFrame:
    """All report tables of the plain training set in one long frame."""
    tables = report.word_reports(train.word_frames(t.split()[0]))
    values = {
        "word_frequency": "frequency",
        "avg_tfidf_by_sentiment": "avg_tfidf",
        "top_words_by_sentiment": "avg_tfidf",
        "feature_word_frequency": "frequency",
    }
    parts = [
        frame.select(
            F.lit(name).alias("report"),
            F.col("sentiment") if "sentiment" in frame.columns else F.lit("ALL").alias("sentiment"),
            "word",
            F.round(F.col(values[name]).cast("double"), DIGITS).alias("value"),
        )
        for name, frame in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


QUERIES["stem_words"] = QUERIES.pop("stem_words_")
