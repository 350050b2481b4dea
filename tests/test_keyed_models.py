"""Models by key against single models, one key at a time."""

import pytest
from pyspark.sql import functions as F

from opinara.operators import keyed_models
from opinara.operators import naive_bayes as nb
from opinara.operators.reviews import sentiment_label
from opinara.plans import train as plan
from opinara.sources import files, writers

TEXTS = ["great battery love", "great  screen", "bad case refund", "", "broken screen bad bad", " ", "love love fit case"]
SCHEMA = "category string, review_id long, overall double, text string"


def rows(key, n, shift):
    return [
        (key, i, [5.0, 1.0, 2.0, 5.0, None][(i + shift) % 5], TEXTS[(i * 3 + shift) % len(TEXTS)] if i % 9 else None)
        for i in range(n)
    ]


@pytest.fixture(scope="module")
def reviews(spark):
    data = rows("a", 40, 0) + rows("b", 7, 2) + rows("c", 1, 1) + rows(None, 5, 0)
    return sentiment_label(spark.createDataFrame(data, SCHEMA))


def single(reviews, test, mode):
    counts, statistics = plan.train_model(plan.word_frames(reviews))
    scored = plan.evaluate(test, counts, statistics, mode)
    return scored, nb.classification_metrics(nb.confusion_matrix(scored))


@pytest.mark.parametrize("mode", ["reference", "standard"])
@pytest.mark.parametrize("broadcast", [True, False])
def test_equal_single_models(spark, reviews, mode, broadcast, monkeypatch):
    if not broadcast:
        monkeypatch.setattr(keyed_models, "MAX_BROADCAST", 0)
    bags = keyed_models.bags(reviews, "category")
    models = keyed_models.train(bags, "category")
    got = {r["category"]: r.asDict() for r in keyed_models.evaluate(models, bags, mode).collect()}
    scores = {
        (r["category"], r["review_id"]): (r["pos_ll"], r["neg_ll"])
        for r in keyed_models.score(models, bags, mode).collect()
    }
    assert set(got) == {"a", "b", "c"}
    for key in got:
        own = reviews.filter(F.col("category") == key).select("review_id", "overall", "text")
        scored, metrics = single(own, own, mode)
        want = metrics.first().asDict()
        assert {name: got[key][name] for name in want} == want
        for r in scored.collect():
            assert scores.pop((key, r["review_id"])) == pytest.approx((r["pos_ll"], r["neg_ll"]), nan_ok=True)
    assert not scores


def test_keys_without_test_rows_or_training(spark, reviews):
    bags = keyed_models.bags(reviews, "category")
    models = keyed_models.train(bags.filter("category <> 'b'"), "category")
    metrics = {r["category"]: r for r in keyed_models.evaluate(models, bags.filter("category = 'a'")).collect()}
    assert set(metrics) == {"a", "c"} and metrics["c"]["tp"] == 0 and metrics["c"]["accuracy"] is None
    unknown = keyed_models.score(models, bags.filter("category = 'b'")).collect()
    assert len(unknown) == 7 and all(r["pos_ll"] is None for r in unknown)
    nothing = bags.limit(0)
    assert keyed_models.evaluate(keyed_models.train(nothing, "category"), nothing).count() == 0


def lines(spark, tag):
    data = [("one", f"{tag}-{i}") for i in range(20)] + [("two", tag)]
    return spark.createDataFrame(data, "dataset string, value string").orderBy("dataset", "value")


def read(spark, path):
    return sorted(r["value"] for r in spark.read.schema("value string").text(path).collect())


def test_datasets_are_written_by_one_job_and_published(spark, tmp_path):
    folder = str(tmp_path / "sets")
    paths = writers.write_datasets(lines(spark, "x"), folder, ["one", "two", "none"])
    assert read(spark, paths["one"]) == sorted(f"x-{i}" for i in range(20))
    assert read(spark, paths["two"]) == ["x"] and read(spark, paths["none"]) == []
    assert sorted(p.name for p in (tmp_path / "sets").iterdir()) == ["none", "one", "two"]
    with pytest.raises(FileExistsError):
        writers.write_datasets(lines(spark, "y"), folder, ["two"])
    writers.write_datasets(lines(spark, "y"), folder, ["two"], mode="overwrite")
    assert read(spark, paths["two"]) == ["y"] and len(read(spark, paths["one"])) == 20


def test_a_failed_job_leaves_the_folders_as_they_were(spark, tmp_path):
    folder = str(tmp_path / "sets")
    paths = writers.write_datasets(lines(spark, "x"), folder, ["one", "two"])
    broken = lines(spark, "y").withColumn("value", F.when(F.col("value") == "y", F.raise_error("lost")).otherwise("value"))
    with pytest.raises(Exception, match="lost"):
        writers.write_datasets(broken, folder, ["one", "two"], mode="overwrite")
    assert read(spark, paths["two"]) == ["x"] and len(read(spark, paths["one"])) == 20
    assert sorted(p.name for p in (tmp_path / "sets").iterdir()) == ["one", "two"]


def test_replace_puts_the_old_folder_back(spark, tmp_path):
    (tmp_path / "old").mkdir()
    (tmp_path / "old" / "kept").write_text("x")
    with pytest.raises(Exception):
        files.Files(spark).replace(str(tmp_path / "missing"), str(tmp_path / "old"))
    assert (tmp_path / "old" / "kept").read_text() == "x"
