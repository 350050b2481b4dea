from pathlib import Path

import pytest
from pyspark.sql import functions as F

from opinara import session
from opinara.operators import naive_bayes as nb
from opinara.operators import selection, word_stats
from opinara.plans import prepare, train
from opinara.sources import inferred, readers, writers


@pytest.fixture
def path(spark, tmp_path):
    return str(tmp_path / "out")


def test_lenient_lines(spark):
    lines = ["1,5.0,good", "2,1.0,", "3,1.0,,,", "4,2.0,a,b,c", "5", "", '6,5.0,"quoted, text"']
    frame = spark.createDataFrame([(line,) for line in lines], "value string")
    got = [tuple(r) for r in readers.lenient_lines(frame).orderBy("review_id").collect()]
    assert got == [("1", 5.0, "good"), ("4", 2.0, "a"), ("6", 5.0, '"quoted')]
    assert word_stats.review_total(frame).first()["n_reviews"] == 7


def test_bad_rating_fails(spark):
    frame = spark.createDataFrame([("1,good,text",)], "value string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        readers.lenient_lines(frame).collect()


def test_csv_round_trip_keeps_quotes_and_commas(spark, path):
    rows = [(1, 5.0, 'say "hi", ok'), (2, 1.0, "back\\slash"), (3, 2.0, "")]
    frame = spark.createDataFrame(rows, readers.CSV_REVIEW_SCHEMA)
    writers.write_csv(frame, path)
    back = readers.read_csv_reviews(spark, path).orderBy("index")
    assert [tuple(r) for r in back.collect()] == rows
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        writers.write_csv(frame, path)


BROKEN = ["a\nb", "c\r\nd", "\n", '"\n"', "x\\", "\\n", "\\\\n\\", '\\"', "\t", " blanks ", "a,b\r", "", None]


def test_csv_keeps_line_breaks(spark, path):
    rows = [(i, 5.0, t) for i, t in enumerate(BROKEN)]
    frame = spark.createDataFrame(rows, readers.CSV_REVIEW_SCHEMA)
    writers.write_csv(frame, path)
    assert spark.read.text(path).count() == len(rows)
    back = readers.read_csv_reviews(spark, path).orderBy("index").collect()
    assert [r["text"] for r in back] == [t or "" for t in BROKEN]
    lines = frame.select(writers.csv_line(["index", "overall", "text"])).collect()
    assert sorted(r[0] for r in lines) == sorted(r[0] for r in spark.read.text(path).collect())


def test_csv_of_others_keeps_backslashes(spark, path):
    spark.createDataFrame([("1,5.0,a\\nb",)], "value string").write.text(path)
    assert readers.read_csv_reviews(spark, path, escaped=False).first()["text"] == "a\\nb"
    assert readers.read_csv_reviews(spark, path).first()["text"] == "a\nb"


def test_json_of_unknown_layout(spark, path):
    lines = [
        '{"n": 1, "mixed": 5.0, "big": 12345678901234567890, "none": null, "x.y": true}',
        '{"n": 2.5, "mixed": "5", "deep": {"a": [1, 2]}, "big": 1, "x.y": false}',
        '{"n": null, "deep": [3], "text": "t"}',
        "{}",
        "  ",
        "[1]",
        "7",
        '{"cut": ',
        '{"twice": 1, "twice": 2}',
    ]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    rows, kinds, rejects = inferred.read_json_inferred(spark, path)
    assert rows.dtypes == [
        ("big", "string"), ("deep", "string"), ("mixed", "string"), ("n", "double"),
        ("none", "string"), ("text", "string"), ("x.y", "boolean"),
    ]
    assert [tuple(r) for r in rows.collect()] == [
        ("12345678901234567890", None, "5.0", 1.0, None, None, True),
        ("1", '{"a":[1,2]}', "5", 2.5, None, None, False),
        (None, "[3]", None, None, None, "t", None),
        (None, None, None, None, None, None, None),
    ]
    assert [r["value"] for r in rejects.collect()] == lines[5:]
    found = {(r["field"], r["kind"]): r["n_rows"] for r in kinds.collect()}
    assert found[("mixed", "string")] == found[("mixed", "decimal")] == 1
    assert found[("none", "void")] == 1 and ("twice", "bigint") not in found


def test_json_fields_that_cannot_be_told_apart(spark, path):
    spark.createDataFrame([('{"a": 1, "A": 2}',)], "value string").write.text(path)
    with pytest.raises(ValueError, match="case only"):
        inferred.read_json_inferred(spark, path)


def test_json_without_rows(spark, path):
    spark.createDataFrame([], "value string").write.text(path)
    rows, kinds, rejects = inferred.read_json_inferred(spark, path)
    assert rows.count() == kinds.count() == rejects.count() == 0


def test_csv_with_a_bad_value_fails(spark, path):
    spark.createDataFrame([("x,5.0,t",)], "value string").write.text(path)
    with pytest.raises(Exception):
        readers.read_csv_reviews(spark, path).collect()


def test_json_reads_two_fields(spark, path):
    frame = spark.createDataFrame(
        [(5.0, "line\nbreak", "x"), (None, None, "y")], "overall double, reviewText string, asin string"
    )
    frame.write.json(path)
    back = readers.read_json_reviews(spark, path)
    assert back.columns == ["overall", "reviewText"]
    assert {tuple(r) for r in back.collect()} == {(5.0, "line\nbreak"), (None, None)}


def test_stage_files_round_trip(spark, golden, path):
    frames = train.word_frames(golden[1], golden[0])
    stages = {
        "wordcount": writers.stage_wordcount(frames.tf),
        "tf": writers.stage_tf(frames.tf),
        "tfidf": writers.stage_tfidf(frames.scored),
        "features": writers.stage_features(selection.feature_text(frames.features)),
        "training": writers.stage_training(nb.train_word_counts(frames.features)),
    }
    for name, stage in stages.items():
        writers.write_tsv(stage, f"{path}/{name}")
        back = readers.read_stage(spark, f"{path}/{name}", name)
        assert sorted(map(tuple, back.collect())) == sorted(map(tuple, stage.collect()))
    tf = readers.read_stage(spark, f"{path}/tf", "tf")
    assert tf.filter("word_review = 'great@1+'").first()["tf"] == "2/5"
    parts = writers.split_key(tf, "word_review", ("word", "review"), last=True)
    assert parts.filter("word = 'refund'").first()["review"] == "4"


def test_merged_export_is_one_file_when_small(spark, path):
    frame = spark.range(1000).repartition(7).select(F.col("id").cast("string"), F.lit("x"))
    writers.write_tsv(frame, path)
    writers.merged_export(spark, path, path + "-merged")
    merged = spark.read.text(path + "-merged")
    assert len(merged.inputFiles()) == 1 and merged.count() == 1000


def test_predictions_are_sorted_by_key(spark):
    frame = spark.createDataFrame([("2", "b", "P"), ("1", "a", "N")], "review_id string, text string, predicted string")
    assert [r[0] for r in writers.stage_output(frame, ordered=True).collect()] == ["1@a", "2@b"]


def test_prepare_datasets(spark, path):
    rows = [(i, 1.0 if i % 4 == 0 else 5.0, f"Nice phone number{i} works") for i in range(200)]
    rows += [(300, 3.0, "so so thing"), (301, None, "no rating here"), (302, 1.0, "single")]
    frame = spark.createDataFrame(rows, "review_id long, overall double, reviewText string")
    paths = prepare.prepare_datasets(frame, path)
    assert len(paths) == 9
    written = {
        name: readers.read_csv_reviews(
            spark, p, readers.BALANCED_SCHEMA if "final" in name else readers.CSV_REVIEW_SCHEMA
        )
        for name, p in paths.items()
    }
    for variant in ("plain", "stemmed", "lemmatized"):
        sizes = {part: written[f"{part}_{variant}"].count() for part in ("train", "test", "final")}
        assert sizes["train"] + sizes["test"] == sizes["final"]
        assert 50 + 25 < sizes["final"] < 50 + 80
        assert written[f"final_{variant}"].columns == ["overall", "text"]


def test_copies_of_a_review_are_sampled_one_by_one(spark, path):
    """When most rows are copies of one text, the sample must still balance and split."""
    rows = [(1.0, "bad bad thing")] * 300 + [(5.0, "good good thing")] * 900
    frame = spark.createDataFrame(rows, readers.JSON_REVIEW_SCHEMA)
    paths = prepare.prepare_datasets(prepare.with_row_id(frame), path, variants=("plain",))
    sizes = {name: spark.read.text(p).count() for name, p in paths.items()}
    assert 500 < sizes["final_plain"] < 700
    assert 0.7 < sizes["train_plain"] / sizes["final_plain"] < 0.9


def test_scratch_folder_is_the_one_the_session_names(spark):
    root = spark.conf.get(session.CHECKPOINT_CONF)
    assert session.scratch_path(spark, "x").startswith(root)


def test_scratch_scope_deletes_what_was_written_inside(spark):
    with session.scratch_scope(spark):
        table = session.materialize(spark.range(3), "inside")
        folder = Path(table.inputFiles()[0].removeprefix("file:")).parent
        assert folder.exists()
    assert not folder.exists()


BAD_JSON = ['{"overall": 5.0, "reviewText": "a"}', '{"overall": "4.0", "reviewText": "b"}',
            '{"overall": 1.0, "revi', '{"overall": "five", "reviewText": "c"}', '{"reviewText": "d"}']


def test_json_fails_at_cut_lines_and_reads_quoted_ratings(spark, path):
    spark.createDataFrame([(line,) for line in BAD_JSON], "value string").write.text(path)
    with pytest.raises(Exception):
        readers.read_json_reviews(spark, path).collect()
    good, rejected = readers.read_json_reviews_with_rejects(spark, path)
    assert {tuple(r) for r in good.collect()} == {(5.0, "a"), (4.0, "b"), (None, "d")}
    assert {r[0] for r in rejected.collect()} == {BAD_JSON[2], BAD_JSON[3]}


def test_lenient_rejects(spark):
    lines = ["1,5.0,good", "2,1.0,", "3,five,text", ""]
    frame = spark.createDataFrame([(line,) for line in lines], "value string")
    assert readers.lenient_lines(frame, drop_bad_ratings=True).count() == 1
    rejected = {tuple(r) for r in readers.rejected_lines(frame).collect()}
    assert rejected == {("2,1.0,", "fields"), ("3,five,text", "rating"), ("", "fields")}


@pytest.mark.parametrize("word", ["@", "a@b", "tab\there", 'quo"te', "back\\slash", "\\t", "line\nend", ""])
def test_stage_words_come_back(spark, path, word):
    counts = spark.createDataFrame([("7", "POSITIVE", word, 2)], "review_id string, sentiment string, word string, n long")
    writers.write_tsv(writers.stage_wordcount(counts), path)
    assert "\0" not in "".join(r[0] for r in spark.read.text(path).collect())
    stage = readers.read_stage(spark, path, "wordcount")
    parts = writers.split_key(stage, "word_review", ("word", "review"), last=True)
    assert tuple(parts.first()) == (word, "7+", 2)
    scored = counts.withColumn("tfidf", F.lit(0.5))
    first = writers.split_key(writers.stage_tfidf(scored), "review_word", ("review", "word"))
    assert tuple(first.first()) == ("7+", word, 0.5)
