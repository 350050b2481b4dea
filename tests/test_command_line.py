import pytest

from opinara.__main__ import main
from opinara.sources import readers, writers


def test_prepare_train_and_report(spark, tmp_path, capsys):
    good = [(5.0, f"Great phone, works number{i} well and fast") for i in range(60)]
    bad = [(1.0, f"Broken screen number{i} bad refund") for i in range(60)]
    source = str(tmp_path / "in")
    spark.createDataFrame(good + bad, readers.JSON_REVIEW_SCHEMA).write.json(source)
    main(["prepare", source, str(tmp_path / "data")])
    train, test = str(tmp_path / "data/train_plain"), str(tmp_path / "data/test_plain")
    metrics = []
    for flags in ([], ["--lenient"]):
        for _ in range(2):  # the second run replaces the first one's stages
            main(["train", train, test, str(tmp_path / "out"), *flags])
        metrics.append(capsys.readouterr().out.split("+\n")[-2])
        for stage in readers.STAGE_SCHEMAS:
            assert readers.read_stage(spark, f"{tmp_path}/out/{stage}", stage).count() > 0
    assert metrics[0] == metrics[1] and "accuracy" in metrics[0]
    main(["report", train, str(tmp_path / "reports")])
    top = spark.read.parquet(str(tmp_path / "reports/top_words_by_sentiment"))
    # digits are stripped, so the texts hold six positive and five negative words
    assert top.count() == 11
    main(["train", train, test, str(tmp_path / "out")])
    main(["stage-report", str(tmp_path / "out"), str(tmp_path / "stage-reports")])
    for name in ("word_frequency", "top_words_by_sentiment", "feature_word_frequency"):
        tables = [spark.read.parquet(f"{tmp_path}/{folder}/{name}") for folder in ("reports", "stage-reports")]
        rows = [
            sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in row) for row in t.select(sorted(t.columns)).collect())
            for t in tables
        ]
        assert rows[0] == rows[1]
    main(["compare", source, str(tmp_path / "compared")])
    assert spark.read.parquet(f"{tmp_path}/compared/variants").count() == 3


def test_shared_ids_must_be_asked_for(spark, tmp_path):
    path = str(tmp_path / "train")
    rows = [(1, 5.0, "good one"), (1, 5.0, "good two"), (2, 1.0, "bad one")]
    spark.createDataFrame(rows, readers.CSV_REVIEW_SCHEMA).write.csv(path)
    with pytest.raises(ValueError, match="shared-ids"):
        main(["train", path, path, str(tmp_path / "out")])
    main(["train", path, path, str(tmp_path / "out"), "--shared-ids"])
    assert spark.read.text(f"{tmp_path}/out/features").count() > 2


def test_a_failed_run_leaves_the_earlier_one(spark, tmp_path, monkeypatch):
    path, out = str(tmp_path / "train"), tmp_path / "out"
    rows = [(i, 5.0 if i % 2 else 1.0, f"word{i % 3} and word{i}") for i in range(12)]
    spark.createDataFrame(rows, readers.CSV_REVIEW_SCHEMA).write.csv(path)
    main(["train", path, path, str(out)])
    before = {s: sorted(p.read_text() for p in (out / s).glob("part*")) for s in readers.STAGE_SCHEMAS}
    write, done = writers.write_tsv, []

    def failing(frame, target, *args, **kwargs):
        if len(done) == 3:
            raise RuntimeError("lost in stage 4")
        done.append(target)
        write(frame, target, *args, **kwargs)

    monkeypatch.setattr(writers, "write_tsv", failing)
    with pytest.raises(RuntimeError, match="stage 4"):
        main(["train", path, path, str(out), "--mode", "standard"])
    after = {s: sorted(p.read_text() for p in (out / s).glob("part*")) for s in readers.STAGE_SCHEMAS}
    assert after == before and sorted(p.name for p in out.iterdir()) == sorted(readers.STAGE_SCHEMAS)
