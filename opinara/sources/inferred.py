"""JSON lines of unknown layout: their fields' types are found by one distributed count.

Each line is parsed as a VARIANT, and its fields are counted by name and kind. From these counts
follows a schema that loses nothing: scalars of a field of several kinds are read as the text that
stands in the file, nested ones as JSON without blanks.

Fields that are null everywhere are texts. Blank lines are skipped. Lines that are no JSON object,
name a field twice or are too large for a VARIANT are rejects.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Kinds of VARIANT values, and the types of fields that hold one kind only.
VOID, BIGINT, DECIMAL, DOUBLE = "void", "bigint", "decimal", "double"
TYPES = {
    "boolean": T.BooleanType(),
    BIGINT: T.LongType(),
    DECIMAL: T.DoubleType(),
    DOUBLE: T.DoubleType(),
    "string": T.StringType(),
}
# Digits that a double keeps.
DOUBLE_DIGITS = 15
MAX_FIELDS = 10_000


def _parsed(lines: DataFrame) -> DataFrame:
    parsed = lines.filter(F.trim("value") != "").select(
        "value", F.try_parse_json("value").alias("parsed")
    )
    kind = F.schema_of_variant("parsed")
    return parsed.withColumn("good", F.coalesce(F.startswith(kind, F.lit("OBJECT<")), F.lit(False)))


def json_field_types(lines: DataFrame) -> DataFrame:
    """`field, kind, digits, n_rows`: the kinds of values of each field of JSON lines `value`.

    `digits` is the largest precision of decimals, which include integers beyond 64 bits, and 0 of
    other kinds.
    """
    objects = _parsed(lines).filter("good").select("parsed")
    fields = objects.lateralJoin(
        objects.sparkSession.tvf.variant_explode(F.col("parsed").outer())
    ).select(F.col("key").alias("field"), F.schema_of_variant("value").alias("type"))
    return fields.groupBy(
        "field", F.lower(F.regexp_extract("type", "^[A-Z]+", 0)).alias("kind")
    ).agg(
        F.coalesce(
            F.max(F.regexp_extract("type", r"^DECIMAL\((\d+)", 1).try_cast("int")), F.lit(0)
        ).alias("digits"),
        F.count(F.lit(1)).alias("n_rows"),
    )


def inferred_schema(field_types: DataFrame) -> T.StructType:
    """The schema of fields in the order of their names, from `json_field_types`. Runs a job."""
    counted = field_types.filter(F.col("field").isNotNull())
    rows = counted.limit(MAX_FIELDS + 1).collect()
    if len(rows) > MAX_FIELDS:
        raise ValueError(f"over {MAX_FIELDS} fields: their names seem to be data")
    kinds: dict[str, dict[str, int]] = {}
    for row in rows:
        found = kinds.setdefault(row["field"], {})
        if row["kind"] != VOID:
            found[row["kind"]] = row["digits"]
    folded: dict[str, str] = {}
    for field in sorted(kinds):
        if folded.setdefault(field.lower(), field) != field:
            raise ValueError(f"fields differ by case only: {folded[field.lower()]}, {field}")
    return T.StructType([T.StructField(f, _type(kinds[f])) for f in sorted(kinds)])


def _type(kinds: dict[str, int]) -> T.DataType:
    if kinds.get(DECIMAL, 0) > DOUBLE_DIGITS:
        return T.StringType()
    if len(kinds) > 1 and kinds.keys() <= {BIGINT, DECIMAL, DOUBLE}:
        return T.DoubleType()
    return TYPES.get(next(iter(kinds)), T.StringType()) if len(kinds) == 1 else T.StringType()


def read_json_inferred(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The rows of JSON lines, their `json_field_types`, and the rejected lines `value`.

    Runs one job for the schema; files without a field give rows without columns.
    """
    lines = spark.read.text(path)
    field_types = json_field_types(lines)
    schema = inferred_schema(field_types)
    parsed = _parsed(lines)
    rows = parsed.filter("good").select(F.from_json("value", schema).alias("row")).select("row.*")
    return rows, field_types, parsed.filter(~F.col("good")).select("value")
