import hashlib
import random

import pytest
from pyspark.sql import functions as F

from opinara.operators import order_statistics, sampling

SCHEMA = "grp string, id long, key string, note string"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(4)


def brute_force(rows, wanted):
    kept = []
    for group, n in wanted.items():
        own = sorted((r for r in rows if r[0] == group), key=lambda r: (r[2], r[1], r[3]))
        kept += own[: max(n, 0)]
    return sorted(kept)


@pytest.mark.parametrize("few", [1, 7, 10_000])
@pytest.mark.parametrize("broadcast", [True, False])
def test_equals_sorting(spark, few, broadcast, monkeypatch):
    if not broadcast:
        monkeypatch.setattr(order_statistics, "MAX_BROADCAST", 0)
    draw = random.Random(few)
    rows = [("hash", i, hashlib.md5(str(i).encode()).hexdigest()[:8], "") for i in range(400)]
    rows += [("ties", i, draw.choice(["00000000", "0000000f", "ffffffff"]), str(i % 3)) for i in range(90)]
    rows += [("one key", 5, "abcabcab", n) for n in "ab" * 30] + [("all", i, "12345678", "") for i in range(9)]
    rows += [("none", 1, "00000000", ""), ("unwanted", 1, "00000000", ""), (None, 1, "00000000", "")]
    wanted = {"hash": 123, "ties": 40, "one key": 31, "all": 99, "none": 0, "missing": 5}
    table = spark.createDataFrame(list(wanted.items()), "grp string, _wanted long")
    got = order_statistics.smallest_per_group(
        frame(spark, rows), "grp", F.col("key"), table, [F.col("id").asc(), F.col("note").asc()], 8, few
    )
    assert got.columns == ["grp", "id", "key", "note"]
    assert sorted(map(tuple, got.collect())) == brute_force(rows, wanted)


def test_empty_tables(spark):
    nothing = frame(spark, [])
    table = spark.createDataFrame([("a", 3)], "grp string, _wanted long")
    some = frame(spark, [("a", 1, "00", "")])
    for rows, wanted in ((nothing, table), (some, table.limit(0))):
        assert order_statistics.smallest_per_group(rows, "grp", F.col("key"), wanted, [F.col("id")], 2).count() == 0


@pytest.mark.parametrize("negatives, positives", [(40, 100), (100, 40), (0, 5), (5, 0), (0, 0)])
def test_exact_balance(spark, negatives, positives):
    """Ties at the border: every positive id stands in three rows."""
    rows = [(i, 1.0 + i % 2, "n") for i in range(negatives)]
    rows += [(1000 + i // 3, 5.0, str(i)) for i in range(positives)] + [(1, 3.0, "x"), (2, None, "y")]
    reviews = spark.createDataFrame(rows, "review_id long, overall double, text string")
    got = sampling.balanced_sample(reviews, exact=True)
    assert got.columns == reviews.columns
    found = [tuple(r) for r in got.collect()]
    digest = lambda r: hashlib.md5(f"{r[0]}:123:balance".encode()).hexdigest()
    order = sorted((r for r in rows if r[1] == 5.0), key=lambda r: (digest(r), r[0], r[2]))
    want = [r for r in rows if r[1] in (1.0, 2.0)] + order[:negatives]
    assert sorted(found) == sorted(want)
