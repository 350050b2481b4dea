import pytest
from pyspark.sql import functions as F

from opinara.operators import reviews
from opinara.operators.joins import keyed_lookup

SCHEMA = "word string, n int"


def frames(spark):
    rows = [("hot", i) for i in range(200)] + [("a", 1), ("b", 2), (None, 3), ("", 4), ("hot", 5)]
    table = [("hot",), ("hot",), ("b",), (None,), ("unused",)]
    return spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(table, "word string")


def test_semi_and_anti_with_hot_keys(spark):
    rows, table = frames(spark)
    for per_task in (10, 1_000_000):
        kept = keyed_lookup(rows, table, "word", "left_semi", rows_per_task=per_task)
        gone = keyed_lookup(rows, table, "word", "left_anti", rows_per_task=per_task)
        assert kept.columns == gone.columns == rows.columns
        assert kept.groupBy("word").count().orderBy("word").collect() == [("b", 1), ("hot", 201)]
        assert sorted((r["n"] for r in gone.collect())) == [1, 3, 4]


@pytest.fixture
def uncoalesced(spark):
    """Small partitions stay apart and small tables are not broadcast, as with large ones."""
    settings = {
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield
    for name in settings:
        spark.conf.unset(name)


def test_hot_key_is_spread(spark, uncoalesced):
    rows, table = frames(spark)
    for per_task, spread in ((10, True), (1_000_000, False)):
        joined = keyed_lookup(rows.repartition(4), table, "word", "left_semi", rows_per_task=per_task)
        tasks = joined.filter("word = 'hot'").select(F.spark_partition_id().alias("part")).distinct()
        assert (tasks.count() > 1) == spread


def test_word_lists_and_tables_agree(spark):
    rows, _ = frames(spark)
    few = spark.createDataFrame([("hot",), ("zzz",)], "word string")
    by_list = reviews.exclude_words(rows.filter("word IS NOT NULL"), ["hot", "zzz"])
    by_table = reviews.exclude_words(rows.filter("word IS NOT NULL"), few)
    assert sorted(by_list.collect()) == sorted(by_table.collect())
    assert reviews.only_words(rows, few).count() == 201
    nothing = few.limit(0)
    assert reviews.exclude_words(rows, nothing).count() == rows.count()
    assert reviews.only_words(rows, nothing).count() == 0
