import math

import pytest
from pyspark.sql import functions as F

from opinara.operators import naive_bayes as nb
from opinara.operators import reports, word_stats
from opinara.operators.joins import keyed_lookup
from opinara.operators.reviews import sentiment_label
from opinara.operators.selection import feature_selection, feature_text
from opinara.plans import report, train


@pytest.fixture(scope="module", params=[True, False], ids=["bags", "grouped"])
def frames(golden, request):
    """Both ways to count must train the same model."""
    lines, reviews = golden
    return train.word_frames(reviews, lines, one_row_per_review=request.param)


@pytest.fixture(scope="module")
def model(frames):
    return train.train_model(frames)


def rows(df, *keys):
    return {tuple(r[k] for k in keys): r for r in df.collect()}


# TF-IDF and selection rank worked out by hand; None means trimmed.
EXPECTED = {
    ("1", "great"): (0.204330, 1), ("1", "battery"): (0.183258, 2),
    ("1", "love"): (0.183258, 3), ("1", "screen"): (0.183258, None),
    ("2", "fit"): (0.402359, 1), ("2", "case"): (0.229073, 2),
    ("2", "love"): (0.229073, 3), ("2", "great"): (0.127706, None),
    ("3", "died"): (0.402359, 1), ("3", "battery"): (0.229073, 2),
    ("3", "broken"): (0.229073, 3), ("3", "screen"): (0.229073, None),
    ("4", "broken"): (0.366516, 1), ("4", "refund"): (0.321888, 2),
    ("4", "case"): (0.183258, 3), ("4", "great"): (0.102165, None),
}
MODEL = {
    "battery": (1, 1), "broken": (0, 2), "case": (1, 1), "died": (0, 1),
    "fit": (1, 0), "great": (1, 0), "love": (2, 0), "refund": (0, 1),
}


def test_tf_idf_uses_all_lines_and_no_smoothing(frames):
    scored = rows(frames.scored, "review_id", "word")
    assert {k: round(r["tfidf"], 6) for k, r in scored.items()} == {
        k: v for k, (v, _) in EXPECTED.items()
    }


def test_word_of_every_review_scores_zero(spark):
    reviews = spark.createDataFrame(
        [(1, 5.0, "all good"), (2, 1.0, "all bad")], "review_id long, overall double, text string"
    )
    frames = train.word_frames(reviews)
    scored = rows(frames.scored, "review_id", "word")
    assert scored[(1, "all")]["tfidf"] == 0
    stats = frames.statistics.first()
    assert (stats["pos_words"], stats["neg_words"]) == (1, 1)
    assert word_stats.class_statistics(frames.scored).first().asDict() == stats.asDict()


@pytest.mark.parametrize("one_row_per_review", [True, False])
def test_feature_selection(frames, one_row_per_review):
    selected = rows(
        feature_selection(frames.scored, one_row_per_review=one_row_per_review), "review_id", "word"
    )
    assert {k: r["rank"] for k, r in selected.items()} == {
        k: rank for k, (_, rank) in EXPECTED.items() if rank
    }


def test_feature_text(frames):
    texts = {r["review_id"]: r["text"] for r in feature_text(frames.features).collect()}
    assert texts == {
        "1": "great battery love",
        "2": "fit case love",
        "3": "died battery broken",
        "4": "broken refund case",
    }


def test_class_statistics_count_before_the_trim(frames):
    expected = dict(reviews=4, pos_reviews=2, neg_reviews=2, pos_words=8, neg_words=8)
    assert frames.statistics.first().asDict() == expected
    assert word_stats.class_statistics(frames.scored).first().asDict() == expected


def test_model_counts_and_probabilities(model):
    counts, statistics = model
    got = {r["word"]: (r["pos_count"], r["neg_count"]) for r in counts.collect()}
    assert got == MODEL
    assert statistics.first()["vocabulary"] == 8
    probs = rows(nb.word_probabilities(counts, statistics), "word")
    for word, (pos, neg) in MODEL.items():
        assert probs[(word,)]["pos_prob"] == (pos + 1) / 16
        assert probs[(word,)]["neg_prob"] == (neg + 1) / 16
    priors = nb.class_priors(statistics).first()
    assert (priors["pos_prior"], priors["neg_prior"]) == (0.5, 0.5)


@pytest.mark.parametrize(
    "mode, expected",
    [
        ("reference", {
            "1": (-13.745161, -17.328680), "2": (-13.169796, -10.972572),
            "3": (-17.328680, -13.745161), "4": (-8.199983, -11.783502),
        }),
        ("standard", {
            "1": (-7.219154, -9.010913), "2": (-5.545177, -4.446565),
            "3": (-9.010913, -7.219154), "4": (-4.446565, -6.238325),
        }),
    ],
)
def test_scores(golden_test, model, mode, expected):
    predictions = train.evaluate(golden_test, *model, mode=mode)
    got = {r["review_id"]: r for r in predictions.collect()}
    assert {k: (round(r["pos_ll"], 6), round(r["neg_ll"], 6)) for k, r in got.items()} == expected
    assert {k: r["predicted"] for k, r in got.items()} == {
        "1": "POSITIVE", "2": "NEGATIVE", "3": "NEGATIVE", "4": "POSITIVE",
    }
    metrics = nb.classification_metrics(nb.confusion_matrix(predictions)).first().asDict()
    assert metrics == dict(
        tp=1, fp=1, tn=1, fn=1, accuracy=0.5, precision=0.5, recall=0.5, f1=0.5
    )


def test_long_reviews_do_not_underflow(spark, model):
    test = spark.createDataFrame(
        [("9", 5.0, " ".join(["love"] * 5000))], "review_id string, overall double, text string"
    )
    row = train.evaluate(test, *model).first()
    assert math.isfinite(row["pos_ll"]) and row["predicted"] == "POSITIVE"


def test_review_without_known_words_is_kept_and_ties_are_negative(spark, model):
    test = spark.createDataFrame(
        [("7", 5.0, "unseen words"), ("8", 1.0, "")], "review_id string, overall double, text string"
    )
    got = {r["review_id"]: r for r in train.evaluate(test, *model).collect()}
    assert round(got["7"]["pos_ll"], 6) == round(math.log(0.5) - 4 * math.log(16), 6)
    assert round(got["8"]["pos_ll"], 6) == round(math.log(0.5) - math.log(16), 6)
    assert {r["predicted"] for r in got.values()} == {"NEGATIVE"}


def test_test_rows_with_one_id_are_scored_one_by_one(spark, model):
    test = spark.createDataFrame(
        [("1", 5.0, "love"), ("1", 1.0, "broken")], "review_id string, overall double, text string"
    )
    predictions = train.evaluate(test, *model, one_row_per_review=False)
    got = {r["text"]: r["predicted"] for r in predictions.collect()}
    assert got == {"love": "POSITIVE", "broken": "NEGATIVE"}


def test_lookup_join_defaults(spark, golden_test, model):
    counts, statistics = model
    joined = rows(nb.model_lookup_join(word_stats.unpack_bags(nb.review_bags(golden_test)), counts, statistics), "review_id", "word")
    assert len(joined) == 10
    assert joined[("1", "charger")]["pos_prob"] == 1 / 16
    assert joined[("1", "love")]["pos_prob"] == 3 / 16


def test_metrics_are_null_without_predicted_positives(spark):
    predictions = spark.createDataFrame(
        [("NEGATIVE", "NEGATIVE")], "sentiment string, predicted string"
    )
    row = nb.classification_metrics(nb.confusion_matrix(predictions)).first()
    assert row["accuracy"] == 1.0 and row["precision"] is None and row["recall"] is None
    report_lines = nb.metrics_report(nb.classification_metrics(nb.confusion_matrix(predictions)))
    assert report_lines.count() == 8


def test_ids_shared_by_lines_form_one_review(spark):
    reviews = spark.createDataFrame(
        [(1, "POSITIVE", "a b"), (1, "POSITIVE", "a"), (1, "NEGATIVE", "a")],
        "review_id long, sentiment string, text string",
    )
    counts = word_stats.word_count(reviews)
    got = {(r["sentiment"], r["word"]): r["n"] for r in counts.collect()}
    assert got == {("POSITIVE", "a"): 2, ("POSITIVE", "b"): 1, ("NEGATIVE", "a"): 1}
    tf = word_stats.term_frequency(counts)
    assert {r["review_len"] for r in tf.collect() if r["sentiment"] == "POSITIVE"} == {3}
    df = {r["word"]: r["df"] for r in word_stats.document_frequency(counts).collect()}
    assert df == {"a": 2, "b": 1}


def test_bag_and_grouped_counts_agree(golden):
    labelled = sentiment_label(golden[1])
    grouped = word_stats.word_count(labelled)
    bags = word_stats.word_count(labelled, one_row_per_review=True)
    assert grouped.schema.simpleString() == bags.schema.simpleString()
    assert grouped.exceptAll(bags).isEmpty() and bags.exceptAll(grouped).isEmpty()
    slow = word_stats.term_frequency(grouped)
    fast = word_stats.bag_term_frequency(word_stats.bag_of_words(labelled))
    assert slow.exceptAll(fast).isEmpty() and fast.exceptAll(slow).isEmpty()


def test_tf_sums_to_one(frames):
    sums = frames.tf.groupBy("review_id").agg(F.sum("tf").alias("s")).collect()
    assert all(abs(r["s"] - 1) < 1e-9 for r in sums)


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("rows_per_task", [1, 4, 1000])
def test_keyed_lookup_equals_a_join(spark, how, rows_per_task):
    """A third of the rows share one key; one hot and some rare keys are not in the table."""
    rows_ = [("hot", i) for i in range(60)] + [("gone", i) for i in range(60)] + [
        (f"k{i}", i) for i in range(60)
    ]
    facts = spark.createDataFrame(rows_, "k string, v int")
    table = spark.createDataFrame([("hot", 1)] + [(f"k{i}", i) for i in range(0, 60, 2)], "k string, t int")
    got = keyed_lookup(facts, table, "k", how, rows_per_task=rows_per_task)
    want = facts.join(table, "k", how)
    assert got.columns == want.columns
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_keyed_lookup_refuses_other_joins(spark):
    frame = spark.range(1)
    with pytest.raises(ValueError):
        keyed_lookup(frame, frame, "id", "full")


def test_reports(frames):
    tables = report.word_reports(frames)
    frequency = {r["word"]: r["frequency"] for r in tables["word_frequency"].collect()}
    assert frequency["great"] == 4 and frequency["broken"] == 3
    top = tables["top_words_by_sentiment"].collect()
    assert {(r["sentiment"], r["word"]) for r in top if r["rank"] == 1} == {
        ("POSITIVE", "fit"), ("NEGATIVE", "died"),
    }
    features = {r["word"]: r["frequency"] for r in tables["feature_word_frequency"].collect()}
    assert features == {w: p + n for w, (p, n) in MODEL.items()}


def test_top_words_are_cut_per_sentiment(spark):
    averages = spark.createDataFrame(
        [(f"w{i:02d}", s, 1.0) for i in range(15) for s in ("POSITIVE", "NEGATIVE")],
        "word string, sentiment string, avg_tfidf double",
    )
    top = reports.top_words_by_sentiment(averages)
    assert top.count() == 20
    assert {r["word"] for r in top.collect()} == {f"w{i:02d}" for i in range(10)}


def test_results_do_not_depend_on_partitioning(golden, golden_test, model):
    lines, reviews = golden
    counts, _ = train.train_model(train.word_frames(reviews.repartition(7), lines))
    assert counts.exceptAll(model[0]).isEmpty() and model[0].exceptAll(counts).isEmpty()


def test_rows_of_a_moderately_hot_key_are_split(spark):
    """A key of 0.009 % of the rows, on tables that are not broadcast."""
    rows = spark.range(200_000).select(
        F.when(F.col("id") < 18, -1).otherwise(F.col("id")).alias("k"), F.col("id").alias("i")
    )
    table = rows.select("k").distinct().withColumn("v", F.col("k") * 2)
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        joined = keyed_lookup(rows, table, "k", rows_per_task=4)
        tasks = joined.filter("k = -1").select(F.spark_partition_id().alias("p"), "v").collect()
    finally:
        for name in settings:
            spark.conf.unset(name)
    assert len(tasks) == 18 and {r["v"] for r in tasks} == {-2}
    assert len({r["p"] for r in tasks}) > 1


def test_lookup_reads_its_rows_once(spark, tmp_path):
    path = str(tmp_path / "rows")
    spark.range(10).select(F.col("id").alias("k")).write.parquet(path)
    rows = spark.read.parquet(path)
    table = spark.range(10).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    counts = spark.range(10).select(F.col("id").alias("k"), F.lit(1).alias("n_rows"))
    plan = keyed_lookup(rows, table, "k", key_counts=counts)._jdf.queryExecution().toString()
    assert plan.split("== Physical Plan ==")[1].count("FileScan parquet") == 1


def test_missing_test_texts_are_empty_texts(spark, golden):
    frames = train.word_frames(golden[1], golden[0])
    model = train.train_model(frames)
    rows = [(1, 5.0, None), (2, 5.0, "")]
    tests = spark.createDataFrame(rows, "review_id long, overall double, text string")
    scores = train.evaluate(tests, *model).orderBy("review_id").collect()
    assert scores[0]["pos_ll"] == scores[1]["pos_ll"] is not None


def test_close_scores_of_long_reviews_keep_their_order(spark):
    """Scores that differ by a ten-millionth of themselves, all below 10**-9."""
    rows = [("r", "POSITIVE", "a", 5e-10), ("r", "POSITIVE", "b", 5.0000005e-10)]
    scored = spark.createDataFrame(rows, "review_id string, sentiment string, word string, tfidf double")
    kept = feature_selection(scored, 0.5, one_row_per_review=True)
    assert [r["word"] for r in kept.collect()] == ["b"]


def test_words_are_counted_without_grouping_all_of_them(spark):
    """Only keys of several rows are grouped by word; a null key is one key."""
    rows = [(1, ["a", "b", "a", ""]), (2, ["a"]), (3, None), (None, ["c"])]
    single = word_stats.counted_words(spark.createDataFrame(rows, "id long, words array<string>"), ["id"])
    assert "Aggregate" not in single._jdf.queryExecution().executedPlan().toString()
    want = [(1, "", 1), (1, "a", 2), (1, "b", 1), (2, "a", 1), (None, "c", 1)]
    assert sorted(map(tuple, single.collect()), key=str) == sorted(want, key=str)
    rows += [(1, ["a", "d"]), (None, ["c", "c"])]
    shared = word_stats.counted_words(spark.createDataFrame(rows, "id long, words array<string>"), ["id"])
    want = [(1, "", 1), (1, "a", 3), (1, "b", 1), (1, "d", 1), (2, "a", 1), (None, "c", 3)]
    assert sorted(map(tuple, shared.collect()), key=str) == sorted(want, key=str)


def test_few_words_are_scored_and_selected_without_a_shuffle_of_words(spark):
    """One exchange, that of the bags by review, lies below the selected words' texts."""
    rows = [(i, 5.0 if i % 2 else 1.0, f"a b{i % 3} c{i % 5} c{i % 5} d") for i in range(40)]
    frames = train.word_frames(spark.createDataFrame(rows, "review_id long, overall double, text string"))
    texts = feature_text(frames.selected)
    plan = texts._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning") == 1
    wide = word_stats.tf_idf(frames.tf, frames.frequencies, frames.n_reviews)
    assert sorted(map(tuple, wide.select(frames.scored.columns).collect())) == sorted(map(tuple, frames.scored.collect()))
    assert sorted(map(tuple, feature_text(feature_selection(wide)).collect())) == sorted(map(tuple, texts.collect()))
