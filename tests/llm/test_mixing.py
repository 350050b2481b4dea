import random
from itertools import product

import pytest
from pyspark.sql import functions as F

from opinara.llm import mixing

SCHEMA = "doc_id long, text string, source string, size int"


def test_targets():
    assert mixing.targets({"b": 100, "a": 100, None: 100}) == {"a": 50.0, "b": 100.0, None: 150.0}
    found = mixing.targets({"a": 900, "b": 10, "c": 90})
    assert found["b"] == 30 and sum(found.values()) == 1000
    assert found["a"] == 970 / 4 or found["c"] == 270  # c stops at three times its size
    assert mixing.targets({"a": 0}) == {"a": 0.0} and mixing.targets({}) == {}


def cost(flows, supplies):
    """Repetition cost: the words of pass k cost k - 1 each."""
    total = 0
    for (_, words), given in zip(supplies, flows):
        left = sum(given.values())
        for k in range(3):
            total += k * min(left, words)
            left -= min(left, words)
        assert left == 0
    return total


@pytest.mark.parametrize("seed", range(6))
def test_flow_is_full_and_cheapest(seed):
    draw = random.Random(seed)
    names = ["a", "b", None]
    supplies = [(p, draw.randrange(1, 4)) for p in (("a",), ("a", "b"), ("b", None))]
    quotas = {n: draw.randrange(0, 6) for n in names}
    flows = mixing.route(supplies, quotas)
    best = None
    ranges = [range(3 * w + 1) for p, w in supplies for _ in p]
    arcs = [(i, s) for i, (p, _) in enumerate(supplies) for s in p]
    for amounts in product(*ranges):
        out = [dict.fromkeys(p, 0) for p, _ in supplies]
        for (i, s), n in zip(arcs, amounts):
            out[i][s] = n
        if any(sum(o.values()) > 3 * w for o, (_, w) in zip(out, supplies)):
            continue
        if any(sum(o.get(s, 0) for o in out) > quotas[s] for s in names):
            continue
        key = (-sum(amounts), cost(out, supplies))
        best = key if best is None else min(best, key)
    assert (-sum(sum(f.values()) for f in flows), cost(flows, supplies)) == best


@pytest.mark.parametrize("fan, buckets", [(2, 64), (3, 30), (1024, 30), (3, 1)])
def test_borders_are_those_of_running_sums(spark, monkeypatch, fan, buckets):
    monkeypatch.setattr(mixing, "FAN", fan)
    draw = random.Random(fan * buckets)
    rests = {"a": 150, "b": 0, "c": 10**6, "d": 37}
    sums = {n: {b: draw.randrange(0, 30) for b in range(buckets) if draw.random() < 0.8 or b == 0} for n in rests}
    want = {}
    for name, by_bucket in sums.items():
        left = rests[name]
        for bucket in sorted(by_bucket):
            if by_bucket[bucket] > left:
                want[name] = (bucket, left)
                break
            left -= by_bucket[bucket]
    rows = [(n, b, rests[n], w) for n, found in sums.items() for b, w in found.items()]
    frame = spark.createDataFrame(rows, "pattern_key string, bucket long, rest long, words long")
    got = mixing._borders(frame, buckets).collect()
    assert {r["pattern_key"]: (r["border"], r["left"]) for r in got} == want


def test_sources_come_near_their_targets(spark):
    draw = random.Random(1)
    rows = [
        (i, " ".join(["w"] * draw.randrange(1, 60)), None if i % 40 == 0 else f"s{min(i % 9, 5)}", 1)
        for i in range(3000)
    ] + [(5000, None, "s1", 1), (5001, "", None, 1), (5002, "a b " * 1_000, "s0", 1)]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = mixing.mix(docs, F.array("source")).withColumn("source", F.col("pattern")[0])
    sizes = {d: len((t or "").split()) for d, t, *_ in rows}
    found = got.collect()
    assert {r["doc_id"]: r["size"] for r in found} == sizes
    for r in found:
        assert r["taken"] == r["passes"] * r["size"] <= 3 * r["size"]
    want = mixing.targets({s: sum(sizes[d] for d, _, x, _ in rows if x == s) for s in {r[2] for r in rows}})
    for source, target in want.items():
        mine = [r for r in found if r["source"] == source]
        assert {r["targets"][0] for r in mine} == {target}
        assert abs(sum(r["taken"] for r in mine) - target) <= 0.01 * target + 1
    again = mixing.mix(docs.repartition(7), F.array("source")).select("doc_id", "taken")
    assert sorted(map(tuple, again.collect())) == sorted((r["doc_id"], r["taken"]) for r in found)


def test_overlapping_sources_and_rows(spark):
    rows = [(i, "x y z", ["a", "b"] if i % 2 else ["a"]) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, sources array<string>")
    got = mixing.mix(docs, F.col("sources"), weights=(1, 3)).collect()
    assert sum(r["taken"] for r in got) <= 3 * 600
    assert {tuple(r["pattern"]) for r in got} == {("a",), ("a", "b")}
    mixed = mixing.mixed_documents(docs, F.col("sources"), weights=(1, 3))
    assert mixed.columns == docs.columns and mixed.count() == sum(r["passes"] for r in got)


def test_odd_tables(spark):
    nothing = spark.createDataFrame([], SCHEMA)
    assert mixing.mix(nothing, F.array("source")).count() == 0
    assert mixing.mixed_documents(nothing, F.array("source")).count() == 0
    rows = [(1, None, None, 1), (None, "a b", "s", 1), (2, "a", "s", 1), (2, "a", "s", 1)]
    got = mixing.mix(spark.createDataFrame(rows, SCHEMA), F.array("source"))
    assert got.count() == 4 and got.filter("taken > 3 * size").count() == 0
