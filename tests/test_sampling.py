import pytest
from pyspark.sql import functions as F

from opinara.operators import sampling, selection
from opinara.operators.reviews import class_filter, sentiment_label
from opinara.operators.selection import top_fraction_per_group


def reviews(spark, negatives, positives):
    rows = [(i, 1.0 + i % 2) for i in range(negatives)]
    rows += [(negatives + i, 5.0) for i in range(positives)]
    return spark.createDataFrame(rows, "review_id long, overall double")


def ids(df):
    return {r["review_id"] for r in df.collect()}


def test_class_filter_and_label_disagree_on_undecided(spark):
    frame = spark.createDataFrame(
        [(r,) for r in (1.0, 2.0, 3.0, 4.0, 5.0, None)], "overall double"
    )
    assert {r["overall"] for r in class_filter(frame).collect()} == {1.0, 2.0, 5.0}
    labels = {r["overall"]: r["sentiment"] for r in sentiment_label(frame).collect()}
    assert labels == {5.0: "POSITIVE"} | dict.fromkeys((1.0, 2.0, 3.0, 4.0, None), "NEGATIVE")


def test_balanced_sample(spark):
    frame = reviews(spark, 500, 2000)
    balanced = sampling.balanced_sample(frame)
    counts = sampling.class_counts(balanced).first()
    assert counts["n_negative"] == 500
    assert 400 < counts["n_positive"] < 600
    assert ids(balanced) == ids(sampling.balanced_sample(frame.repartition(7)))


def test_balanced_sample_with_few_or_no_positives(spark):
    assert sampling.balanced_sample(reviews(spark, 20, 5)).count() == 25
    assert sampling.balanced_sample(reviews(spark, 20, 0)).count() == 20
    assert sampling.balanced_sample(reviews(spark, 0, 20)).count() == 0


def test_split_is_disjoint_complete_and_stable(spark):
    frame = reviews(spark, 500, 500)
    train, test = sampling.train_test_split(frame)
    assert not ids(train) & ids(test)
    assert ids(train) | ids(test) == ids(frame)
    assert 740 < train.count() < 860
    again, _ = sampling.train_test_split(frame.repartition(5))
    assert ids(again) == ids(train)


def test_split_is_independent_of_balancing(spark):
    """The sampled positives must split like the negatives do."""
    train, _ = sampling.train_test_split(sampling.balanced_sample(reviews(spark, 500, 5000)))
    counts = sampling.class_counts(train).first()
    assert 320 < counts["n_positive"] < 480


def test_index_rows(spark):
    frame = reviews(spark, 50, 50).repartition(4).withColumn("text", F.lit("x"))
    indexed = sampling.index_rows(frame, "text")
    assert indexed.columns == ["index", "overall", "text"]
    index = [r["index"] for r in indexed.collect()]
    assert len(set(index)) == 100 and min(index) >= 1


def test_shuffled_rows_is_a_repeatable_permutation(spark):
    frame = reviews(spark, 50, 50)
    order = [r["review_id"] for r in sampling.shuffled_rows(frame).collect()]
    again = [r["review_id"] for r in sampling.shuffled_rows(frame.repartition(5)).collect()]
    assert order == again and sorted(order) == list(range(100)) and order != sorted(order)


def test_union_keeps_duplicates(spark):
    frame = reviews(spark, 3, 0)
    assert sampling.union_classes(frame, frame).count() == 6


def brute_top(rows, fraction):
    groups = {}
    for row in rows:
        groups.setdefault(row[0], []).append(row)
    return {
        (*row, rank)
        for group in groups.values()
        for rank, row in enumerate(sorted(group, key=lambda r: (-r[1], r[2])), 1)
        if rank <= -(-len(group) * fraction // 1)
    }


def test_top_fraction_with_a_group_of_a_third_and_equal_scores(spark):
    rows = [("giant", float(i % 3), i) for i in range(4000)]
    rows += [(f"g{i % 900}", float(i % 7), i) for i in range(6000)]
    rows += [(None, 1.0, i) for i in range(10)] + [("single", 1.0, 0)]
    frame = spark.createDataFrame(rows, "g string, score double, id long")
    order = [F.col("score").desc(), F.col("id").asc()]
    expected = brute_top(rows, 0.75)
    for bounded in (True, False):
        top = top_fraction_per_group(frame, ["g"], order, 0.75, bounded_groups=bounded)
        got = {tuple(r) for r in top.select("g", "score", "id", "rank").collect()}
        assert got == expected


@pytest.mark.parametrize("most, joined", [(0, "SortMergeJoin"), (100, "BroadcastHashJoin")])
def test_few_runs_are_broadcast_and_many_are_not(spark, monkeypatch, most, joined):
    monkeypatch.setattr(selection, "MAX_RUNS", most)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = [("a" if i % 3 else None, float(i % 5), i) for i in range(300)]
        frame = spark.createDataFrame(rows, "g string, score double, id long")
        order = [F.col("score").desc(), F.col("id").asc()]
        top = top_fraction_per_group(frame, ["g"], order, 0.75)
        assert joined in top._jdf.queryExecution().toString()
        assert {tuple(r) for r in top.select("g", "score", "id", "rank").collect()} == brute_top(rows, 0.75)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_ranks_run_on_across_the_slices_of_one_group(spark):
    frame = spark.range(200_000).select(F.lit("one").alias("g"), F.col("id"))
    top = top_fraction_per_group(frame, ["g"], [F.col("id").asc()], 0.5)
    assert top.count() == 100_000
    assert top.agg(F.max("rank")).first()[0] == 100_000
