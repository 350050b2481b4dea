from pyspark.sql import functions as F

from opinara.llm import bitmaps


def test_all_wanted_rows_and_few_others(spark):
    rows = spark.range(20_000).select((F.col("id") * 7 - 50_000).alias("key"), F.lit("x").alias("at"))
    wanted = rows.filter("key % 10 = 0").select(F.col("key").alias("other"))
    got = bitmaps.likely(rows, "key", wanted)
    assert got.columns == rows.columns
    assert got.join(wanted, F.col("key") == F.col("other"), "left_semi").count() == wanted.count()
    # A sixteenth of the bits is set, and so many of the other rows pass.
    assert got.count() - 2_000 < 18_000 / 16 * 1.1


def test_strings_nulls_and_empty_keys(spark):
    rows = spark.createDataFrame([("a",), ("b",), (None,), ("",)], "key string")
    keys = spark.createDataFrame([("a",), (None,), ("",)], "key string")
    found = {r["key"] for r in bitmaps.likely(rows, "key", keys).collect()}
    assert {"a", ""} <= found
    assert bitmaps.likely(rows, "key", keys.limit(0)).count() == 0


def test_more_keys_than_bits(spark, monkeypatch):
    monkeypatch.setattr(bitmaps, "MOST_BITS", bitmaps.BUCKET_BITS)
    rows = spark.range(100_000)
    assert bitmaps.likely(rows, "id", rows.filter("id >= 0")).count() == 100_000
