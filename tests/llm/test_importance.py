import hashlib
import math
import re
import zlib

import pytest
from pyspark.sql import functions as F

from opinara.llm import importance

SCHEMA = "doc_id long, text string, row string, rank int, line string"
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = str.maketrans(importance.UPPER, importance.LOWER)


def runs(text, longest):
    words = WORD.findall((text or "").translate(LOWER))
    return words, [
        " ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)
    ]


def brute_force(docs, targets, longest=1, buckets=10_000, percent=10, least_words=20, seed=2024):
    """Rows `doc_id, n_features, weight, score, rank` of `(doc_id, text)` pairs."""

    def counted(texts):
        counts = [0] * buckets
        for text in texts:
            for feature in runs(text, longest)[1]:
                counts[zlib.crc32(feature.encode()) % buckets] += 1
        return counts, sum(counts)

    (s, total), (t, target) = counted(d[1] for d in docs), counted(targets)
    gain = [
        math.floor(1000 * math.log((b + 1.0) * (total + buckets) / ((a + 1.0) * (target + buckets))))
        for a, b in zip(s, t)
    ]
    found = []
    for doc, text in docs:
        words, features = runs(text, longest)
        sums = sum(gain[zlib.crc32(f.encode()) % buckets] for f in features)
        weight = sums // len(features) if features else 0
        name = f"{seed}:{'' if doc is None else doc}"
        h = int(hashlib.sha256(name.encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        found.append([doc, len(features), weight, score, None, len(words) >= least_words])
    fit = sorted((r for r in found if r[5]), key=lambda r: (-r[3], -1 if r[0] is None else r[0], r[1]))
    for rank, row in enumerate(fit[: len(fit) * percent // 100], 1):
        row[4] = rank
    return sorted((tuple(r[:5]) for r in found), key=str)


def got(frame):
    columns = ["doc_id", "n_features", "weight", "score", "rank"]
    return sorted((tuple(r) for r in frame.select(columns).collect()), key=str)


TEXTS = [
    None, "", "\n\n", "...", "Ähre Über STRASSE über", "one\ntwo three\n\nfour", "one two three four",
    "a b c\na b c\na b c", "x", "same line here\nother\nsame line here", "tab\tand\x00nul\x7fdel 9",
    "\U0001f600 emoji \U00010437 word", "word " * 50, "word " * 50, "Deep " + "mid " * 9 + "end\nnext line",
]


@pytest.mark.parametrize("longest", [1, 2, 3, 4])
def test_equals_brute_force(spark, longest):
    docs = [(i, t) for i, t in enumerate(TEXTS * 3)] + [(7, "again same id"), (None, "no id " * 9), (None, "no id " * 9)]
    targets = ["one two three", None, "word word line", "Über"]
    rows = [(d, t, "x", 1, None) for d, t in docs]
    target = spark.createDataFrame([(i, t) for i, t in enumerate(targets)], "item_id int, text string")
    options = dict(longest=longest, buckets=97, percent=30, least_words=2)
    frame = importance.resample(spark.createDataFrame(rows, SCHEMA).repartition(5), target, **options)
    assert got(frame) == brute_force(docs, targets, **options)


def test_lines_are_brought_together_once(spark):
    docs = spark.createDataFrame([(i, "hot line\nown %d" % i) for i in range(50)], "doc_id int, text string")
    lines = importance.distinct_lines(docs, "text", 1, 97)
    assert lines.count() == 51
    assert lines.agg(F.max("occurrences")).first()[0] == 50


def test_empty_tables(spark):
    docs = spark.createDataFrame([], SCHEMA)
    target = spark.createDataFrame([(1, "one two")], "item_id int, text string")
    assert importance.resample(docs, target).count() == 0
    some = spark.createDataFrame([(1, "one two " * 20)] * 10, "doc_id int, text string")
    frame = importance.resample(some, target.limit(0))
    assert got(frame) == brute_force([(1, "one two " * 20)] * 10, [])


def test_long_text_and_no_python(spark):
    long = "lang Wort\n" * 20_000 + "ende " * 10_000
    docs = [(1, long), (2, "kurz " * 30)]
    target = spark.createDataFrame([(1, "kurz")], "item_id int, text string")
    frame = importance.resample(spark.createDataFrame(docs, "doc_id int, text string"), target, longest=2)
    assert got(frame) == brute_force(docs, ["kurz"], longest=2)
    plan = frame._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
