from pyspark.sql import functions as F

from opinara.llm import exact_dedup

SCHEMA = "doc_id long, text string, kept string, __row int"
ROWS = [
    (1, "a", "x", 1), (5, "a", "y", 2), (3, "a", None, 3), (2, None, "x", 4), (9, "", "x", 5),
    (4, "b", "x", 6), (4, "b", "x", 7), (None, "a", "x", 8), (None, "c", "x", 9), (6, "A", "x", 10),
]


def brute_force(rows):
    groups = {}
    for doc, text, *_ in rows:
        groups.setdefault(text or "", []).append(doc)
    found = []
    for doc, text, *_ in rows:
        group = groups[text or ""]
        keep = max((d for d in group if d is not None), default=None)
        found.append((doc, keep, len(group), doc == keep))
    return sorted(found, key=str)


def test_decisions(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    got = exact_dedup.decisions(docs).select("doc_id", "keep_id", "group_size", "kept")
    assert sorted(map(tuple, got.collect()), key=str) == brute_force(ROWS)


def test_keep_one_keeps_rows_whole(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    kept = exact_dedup.keep_one(docs)
    assert kept.columns == docs.columns
    # the two equal rows of id 4 cannot be told apart
    assert sorted(r["__row"] for r in kept.collect()) == [2, 5, 6, 7, 9, 10]


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert exact_dedup.decisions(docs).count() == 0 and exact_dedup.keep_one(docs).count() == 0


def test_long_texts_and_large_groups(spark):
    long = F.repeat(F.lit("word "), 200_000)
    docs = spark.range(400).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") < 300, "same").when(F.col("id") < 304, long).otherwise(F.concat(F.lit("t"), F.col("id"))).alias("text"),
    )
    got = exact_dedup.decisions(docs).groupBy("group_size").agg(F.count(F.lit(1)), F.count_if("kept"))
    assert {tuple(r) for r in got.collect()} >= {(300, 300, 1), (4, 4, 1)}


def test_no_python_runs(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    plan = exact_dedup.decisions(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
