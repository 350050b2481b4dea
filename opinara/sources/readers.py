"""Readers of review files and stage files of known layouts; `inferred` finds unknown ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# File layouts. CSV files have no header and double embedded quotes.
JSON_REVIEW_SCHEMA = "overall double, reviewText string"
CORRUPT = "_corrupt_record"
CSV_REVIEW_SCHEMA = "index long, overall double, text string"
BALANCED_SCHEMA = "overall double, text string"
STAGE_SCHEMAS = {
    "wordcount": "word_review string, count long",
    "tf": "word_review string, tf string",
    "tfidf": "review_word string, tfidf double",
    "features": "review_id string, text string",
    "training": "word string, counts string",
    "output": "review_text string, predicted string",
}
CSV_OPTIONS = {
    "quote": '"',
    "escape": '"',
    "header": "false",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}
# Characters that would break a line of a stage file, with what stands for them.
ESCAPES = (("\\", "\\\\"), ("\t", "\\t"), ("\n", "\\n"), ("\r", "\\r"))
# In CSV files, where a tab breaks nothing.
CSV_ESCAPES = tuple(pair for pair in ESCAPES if pair[0] != "\t")


def _as_text(schema: str) -> str:
    """The schema with ratings as text, because JSON files quote some of them."""
    return schema.replace("overall double", "overall string")


def read_json_reviews(spark: SparkSession, path: str, schema: str = JSON_REVIEW_SCHEMA) -> DataFrame:
    """JSON lines; fields outside the schema are not parsed.

    A line that is no JSON and a rating that is no number, quoted or not, fail the job.
    """
    rows = spark.read.schema(_as_text(schema)).option("mode", "FAILFAST").json(path)
    return rows.withColumn("overall", F.col("overall").cast("double"))


def read_json_reviews_with_rejects(
    spark: SparkSession, path: str, schema: str = JSON_REVIEW_SCHEMA
) -> tuple[DataFrame, DataFrame]:
    """Reviews, and the lines `value` that `read_json_reviews` would fail at."""
    text = _as_text(schema) + f", {CORRUPT} string"
    lines = spark.read.text(path)
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    parsed = lines.filter(F.trim("value") != "").select(
        "value", F.from_json("value", text, options).alias("r")
    )
    rating = F.expr("try_cast(r.overall AS double)")
    bad = F.col(f"r.{CORRUPT}").isNotNull() | (
        F.col("r.overall").isNotNull() & rating.isNull()
    )
    names = [c for c in lines.sparkSession.createDataFrame([], schema).columns if c != "overall"]
    good = parsed.filter(~bad).withColumn("overall", rating)
    ordered = [n.split()[0] for n in schema.split(", ")]
    columns = {n: F.col(f"r.{n}").alias(n) for n in names} | {"overall": F.col("overall")}
    return good.select(*(columns[n] for n in ordered)), parsed.filter(bad).select("value")


def read_csv_reviews(
    spark: SparkSession, path: str, schema: str = CSV_REVIEW_SCHEMA, escaped: bool = True
) -> DataFrame:
    """Headerless CSV with quoting; a value that does not fit its type fails the job.

    Line ends and backslashes in texts are escaped, as `write_csv` does it, so that files can be
    split; `escaped=False` reads files of others, whose backslashes stand for themselves. The
    format cannot tell an empty text from a missing one; both are read as empty.
    """
    rows = spark.read.schema(schema).options(mode="FAILFAST", **CSV_OPTIONS).csv(path)
    text = F.coalesce("text", F.lit(""))
    return rows.withColumn("text", _unescaped(text, CSV_ESCAPES) if escaped else text)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def _fields() -> Column:
    return F.split(F.regexp_replace("value", ",+$", ""), ",").alias("fields")


def lenient_lines(lines: DataFrame, drop_bad_ratings: bool = False) -> DataFrame:
    """Positional split of raw lines at commas; lines with fewer than three fields are dropped.

    Trailing commas do not count as fields, and text after the third comma is cut, quoted or
    not. A rating that is no number fails the job, or drops its line if so asked; what is dropped
    is in `rejected_lines`.
    """
    rating = F.col("fields")[1]
    rows = lines.select(_fields()).filter(F.size("fields") >= 3)
    if drop_bad_ratings:
        rows = rows.filter(rating.try_cast("double").isNotNull())
    return rows.select(
        F.col("fields")[0].alias("review_id"),
        rating.cast("double").alias("overall"),
        F.col("fields")[2].alias("text"),
    )


def rejected_lines(lines: DataFrame) -> DataFrame:
    """The lines `value` of which `lenient_lines` makes no review, and the `reason`."""
    reason = F.when(F.size("fields") < 3, "fields").when(
        F.get("fields", 1).try_cast("double").isNull(), "rating"
    )
    return (
        lines.select("value", _fields())
        .select("value", reason.alias("reason"))
        .filter("reason IS NOT NULL")
    )


def read_stage(spark: SparkSession, path: str, stage: str) -> DataFrame:
    """Tab-separated `key, value` files of one stage, under their given names."""
    fields = F.split("value", "\t")
    columns = []
    for i, column in enumerate(STAGE_SCHEMAS[stage].split(", ")):
        name, kind = column.split()
        columns.append(_unescaped(fields[i]).cast(kind).alias(name))
    return spark.read.text(path).select(*columns)


def _unescaped(field: Column, escapes: tuple[tuple[str, str], ...] = ESCAPES) -> Column:
    """Undo the escapes of a file; most fields hold none."""

    def plain_part(part: Column) -> Column:
        for plain, escaped in escapes[1:]:
            part = F.replace(part, F.lit(escaped), F.lit(plain))
        return part

    parts = F.transform(F.split(field, r"\\\\", -1), plain_part)
    return F.when(F.contains(field, F.lit("\\")), F.array_join(parts, "\\")).otherwise(field)


def reviews_from_documents(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The test tables as reviews: `review_id, overall, reviewText`.

    Good quality gives 5, or 4 when toxic; poor quality 2, or 1 when toxic; unlabelled
    documents have no rating. Labels grow with the documents, so neither side is broadcast.
    """
    toxic = F.col("toxic") == 1
    rating = F.when(F.col("quality") == 1, F.when(toxic, 4.0).otherwise(5.0)).when(
        F.col("quality") == 0, F.when(toxic, 1.0).otherwise(2.0)
    )
    return documents.join(labels.hint("merge"), "doc_id", "left").select(
        F.col("doc_id").alias("review_id"), rating.alias("overall"), F.col("text").alias("reviewText")
    )
