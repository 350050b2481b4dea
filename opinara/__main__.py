"""Command line: the three programs as spark-submit jobs.

    spark-submit ... -m opinara prepare REVIEWS_JSON OUTPUT
    spark-submit ... -m opinara train TRAIN_CSV TEST_CSV OUTPUT [--lenient] [--shared-ids]
        [--mode standard]
    spark-submit ... -m opinara report TRAIN_CSV OUTPUT [--lenient] [--shared-ids]
    spark-submit ... -m opinara stage-report STAGE_FOLDER OUTPUT
    spark-submit ... -m opinara compare REVIEWS_JSON OUTPUT [--mode standard]

Review ids are taken to be unique, which is checked; rows that share an id form one review with
--shared-ids, and with --lenient. Intermediates are deleted when the results are written.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from opinara.operators import naive_bayes as nb
from opinara.operators import selection
from opinara.plans import prepare, report, train
from opinara.session import materialize, scratch_scope
from opinara.sources import readers, writers


def _labelled(spark: SparkSession, path: str, lenient: bool) -> tuple[DataFrame, DataFrame | None]:
    """Reviews and, for lenient reading, the raw lines behind them."""
    if lenient:
        lines = readers.read_lines(spark, path)
        return readers.lenient_lines(lines), lines
    return readers.read_csv_reviews(spark, path).withColumnRenamed("index", "review_id"), None


def run_prepare(spark: SparkSession, args: argparse.Namespace) -> None:
    reviews = prepare.with_row_id(readers.read_json_reviews(spark, args.reviews))
    for path in prepare.prepare_datasets(reviews, args.output).values():
        print(path)


def run_train(spark: SparkSession, args: argparse.Namespace) -> None:
    """Write the six stage folders and print the metrics. Old folders are replaced when all six
    are written; a run that fails leaves them as they were."""
    reviews, lines = _labelled(spark, args.train, args.lenient)
    test, _ = _labelled(spark, args.test, args.lenient)
    unique = _unique(reviews, args)
    frames = train.word_frames(reviews, lines, one_row_per_review=unique)
    word_counts, statistics = train.train_model(frames)
    predictions = train.evaluate(test, word_counts, statistics, args.mode, unique)
    predictions = materialize(predictions, "predictions")
    if unique:
        features = writers.stage_features(selection.feature_text(frames.features))
    else:
        features = writers.stage_feature_rows(frames.features)
    stages = {
        "wordcount": writers.stage_wordcount(frames.tf),
        "tf": writers.stage_tf(frames.tf),
        "tfidf": writers.stage_tfidf(frames.scored),
        "features": features,
        "training": writers.stage_training(word_counts),
        "output": writers.stage_output(predictions),
    }
    targets = {name: f"{args.output}/{name}" for name in stages}
    with writers.staged(spark, args.output, targets) as beside:
        for name, frame in stages.items():
            writers.write_tsv(frame, f"{beside}/{name}")
    metrics = nb.classification_metrics(nb.confusion_matrix(predictions))
    nb.metrics_report(metrics).show(truncate=False)


def run_report(spark: SparkSession, args: argparse.Namespace) -> None:
    reviews, lines = _labelled(spark, args.train, args.lenient)
    frames = train.word_frames(reviews, lines, one_row_per_review=_unique(reviews, args))
    _write_tables(report.word_reports(frames), args.output)


def run_stage_report(spark: SparkSession, args: argparse.Namespace) -> None:
    _write_tables(report.stage_reports(spark, args.stages), args.output)


def run_compare(spark: SparkSession, args: argparse.Namespace) -> None:
    reviews = prepare.with_row_id(readers.read_json_reviews(spark, args.reviews))
    _write_tables({"variants": train.variant_comparison(reviews, args.mode)}, args.output)


def _write_tables(tables: dict[str, DataFrame], folder: str) -> None:
    for name, frame in tables.items():
        frame.write.mode("overwrite").parquet(f"{folder}/{name}")
        print(f"{folder}/{name}")


def _unique(reviews: DataFrame, args: argparse.Namespace) -> bool:
    """Whether every row is a review of its own; fails if that is wanted but not so."""
    if args.lenient or args.shared_ids:
        return False
    if not train.repeated_ids(reviews).isEmpty():
        raise ValueError("rows share review ids; --shared-ids makes one review of them")
    return True


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="opinara")
    commands = parser.add_subparsers(required=True)
    for name, run, paths in (
        ("prepare", run_prepare, ("reviews", "output")),
        ("train", run_train, ("train", "test", "output")),
        ("report", run_report, ("train", "output")),
        ("stage-report", run_stage_report, ("stages", "output")),
        ("compare", run_compare, ("reviews", "output")),
    ):
        command = commands.add_parser(name)
        command.set_defaults(run=run)
        for path in paths:
            command.add_argument(path)
        if name in ("train", "report"):
            command.add_argument("--lenient", action="store_true", help="split raw lines at commas")
            command.add_argument("--shared-ids", action="store_true", help="rows may share ids")
        if name in ("train", "compare"):
            command.add_argument("--mode", choices=list(nb.SCORE_WEIGHTS), default="reference")
    args = parser.parse_args(argv)
    spark = SparkSession.builder.appName("opinara").getOrCreate()
    with scratch_scope(spark):
        args.run(spark, args)


if __name__ == "__main__":
    main()
