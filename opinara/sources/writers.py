"""Exports. Every one is a folder of part files, written by all tasks.

`compact` evens out the part files with a rebalance: adaptive execution then writes one file
for a small result and as many files of the advisory size as a large one needs, where a
`coalesce(1)` would push everything through one task.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opinara.operators.reviews import POSITIVE
from opinara.sources.files import Files
from opinara.sources.readers import CSV_ESCAPES, CSV_OPTIONS, ESCAPES


def _sized(df: DataFrame, compact: bool) -> DataFrame:
    return df.hint("rebalance") if compact else df


def write_csv(df: DataFrame, path: str, mode: str = "error", compact: bool = False) -> None:
    """Headerless CSV; an existing path is an error unless `mode` says otherwise.

    Line ends and backslashes in texts are escaped: a row is a line, so readers can split files.
    """
    texts = [name for name, kind in df.dtypes if kind == "string"]
    df = df.withColumns({c: _escaped(F.col(c), CSV_ESCAPES) for c in texts})
    _sized(df, compact).write.mode(mode).options(**CSV_OPTIONS).csv(path)


def csv_line(columns: list[str], texts: tuple[str, ...] = ("text",)) -> Column:
    """The line that `write_csv` writes for these columns, of which `texts` are strings."""
    options = {**CSV_OPTIONS, "emptyValue": '""', "nullValue": ""}
    fields = [_escaped(F.col(c), CSV_ESCAPES).alias(c) if c in texts else F.col(c) for c in columns]
    return F.to_csv(F.struct(*fields), options)


def write_datasets(
    lines: DataFrame, folder: str, names: list[str], mode: str = "error"
) -> dict[str, str]:
    """Write rows `dataset, value` as one folder of text files for each name, by one job.

    All of them are written beside the targets first and moved there when they are complete: a job
    that fails leaves the folders as they were. A name without rows is an empty folder. `mode` is
    "error" for existing targets, or "overwrite". Returns the paths by name.
    """
    if mode not in ("error", "overwrite"):
        raise ValueError(f"unknown mode {mode!r}")
    paths = {name: f"{folder.rstrip('/')}/{name}" for name in names}
    files = Files(lines.sparkSession)
    there = [path for path in paths.values() if files.exists(path)]
    if there and mode == "error":
        raise FileExistsError(f"already there: {', '.join(there)}")
    folders = {f"dataset={name}": path for name, path in paths.items()}
    with staged(lines.sparkSession, folder, folders) as beside:
        chosen = lines.filter(F.col("dataset").isin(names))
        chosen.write.mode("append").partitionBy("dataset").text(beside)
    return paths


@contextmanager
def staged(spark: SparkSession, folder: str, targets: dict[str, str]) -> Iterator[str]:
    """A new folder inside `folder` to write into; at the end its parts, the keys of `targets`,
    replace the folders that `targets` names.

    Nothing is replaced if what is done inside fails, so an earlier run stays whole. A part that
    was not written is an empty folder.
    """
    files = Files(spark)
    beside = f"{folder.rstrip('/')}/_staged-{uuid.uuid4().hex}"
    try:
        yield beside
        for part, path in targets.items():
            files.ready(f"{beside}/{part}")
            files.replace(f"{beside}/{part}", path)
    finally:
        files.delete(beside)


def write_tsv(df: DataFrame, path: str, mode: str = "error", compact: bool = False) -> None:
    """Tab-separated stage files; tabs and line ends in texts are escaped, null is empty."""
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns]
    line = F.concat_ws("\t", *(_escaped(f, ESCAPES) for f in fields))
    _sized(df.select(line.alias("value")), compact).write.mode(mode).text(path)


def _escaped(field: Column, escapes: tuple[tuple[str, str], ...]) -> Column:
    for plain, escaped in escapes:
        field = F.replace(field, F.lit(plain), F.lit(escaped))
    return field


def merged_export(spark: SparkSession, source: str, target: str, mode: str = "error") -> None:
    """Merge a stage's part files into few files of even size; one file when small."""
    _sized(spark.read.text(source), True).write.mode(mode).text(target)


def _marked_review():
    """Review id with a trailing + for positive reviews, the key format of stage files."""
    mark = F.when(F.col("sentiment") == POSITIVE, "+").otherwise("")
    return F.concat(F.col("review_id").cast("string"), mark)


def stage_wordcount(counts: DataFrame) -> DataFrame:
    return counts.select(F.concat_ws("@", "word", _marked_review()).alias("word_review"), "n")


def stage_tf(tf: DataFrame) -> DataFrame:
    return tf.select(
        F.concat_ws("@", "word", _marked_review()).alias("word_review"),
        F.concat_ws("/", "n", "review_len").alias("tf"),
    )


def stage_tfidf(scored: DataFrame) -> DataFrame:
    return scored.select(F.concat_ws("@", _marked_review(), "word").alias("review_word"), "tfidf")


def stage_features(feature_texts: DataFrame) -> DataFrame:
    return feature_texts.select(_marked_review().alias("review_id"), "text")


def stage_feature_rows(features: DataFrame) -> DataFrame:
    """The same a word a line, for reviews of any length: the words in any order."""
    return features.select(_marked_review().alias("review_id"), F.col("word").alias("text"))


def stage_training(word_counts: DataFrame) -> DataFrame:
    return word_counts.select("word", F.concat_ws("@", "pos_count", "neg_count").alias("counts"))


def stage_output(predictions: DataFrame, ordered: bool = False) -> DataFrame:
    """Predictions, in the order of their ids if a global sort is wanted."""
    rows = predictions.orderBy("review_id") if ordered else predictions
    return rows.select(F.concat_ws("@", "review_id", "text").alias("review_text"), "predicted")


def split_key(
    df: DataFrame, key: str, names: tuple[str, str], last: bool = False
) -> DataFrame:
    """Undo a composite key at its first `@`, or its `last`.

    Words may hold an `@`, review ids do not: `word@review` is split at the last one,
    `review@word` at the first.
    """
    whole = F.col(key)
    at = F.instr(whole, "@")
    if last:
        at = F.length(whole) + 1 - F.instr(F.reverse(whole), "@")
    return df.select(
        F.substring(whole, F.lit(1), at - 1).alias(names[0]),
        F.substring(whole, at + 1, F.length(whole)).alias(names[1]),
        *[c for c in df.columns if c != key],
    )
