import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from opinara.llm import near_dedup
from opinara.llm.components import components

SCHEMA = "doc_id long, text string, node string, label int"


def shingles(text):
    words = re.findall(r"\w+", text.lower())
    if len(words) < 5:
        return Counter([tuple(words)] if words else [])
    return Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def brute_force(rows):
    """Classes from all pairs, by shingle tuples."""
    counts = [shingles(t or "") for _, t in rows]
    total, df = len(rows), Counter(s for c in counts for s in c)
    idf = {s: 1 + math.log10(total / max(n, total / 10)) for s, n in df.items()}
    weights = [{s: (1 + math.log(n)) * idf[s] for s, n in c.items()} for c in counts]
    parent = list(range(total))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(total):
        for j in range(i):
            a, b = weights[i], weights[j]
            low = sum(min(a[s], b[s]) for s in a.keys() & b.keys())
            whole = sum(a.values()) + sum(b.values()) - low
            if (rows[i][1] or "") == (rows[j][1] or "") or (whole and low / whole >= 0.8):
                x, y = find(i), find(j)
                if x != y:
                    parent[x] = y
    least = {}
    for i, (doc, _) in enumerate(rows):
        least[find(i)] = min(doc, least.get(find(i), doc))
    return {doc: least[find(i)] for i, (doc, _) in enumerate(rows)}


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(8)
    words = [f"w{i}" for i in range(2000)]
    texts = [" ".join(draw.choice(words) for _ in range(draw.randrange(20, 200))) for _ in range(60)]
    for base in texts[:12]:
        for edits in (0, 1, 2, 4, 9):
            copy = base.split()
            for _ in range(edits):
                copy[draw.randrange(len(copy))] = draw.choice(words)
            texts.append(" ".join(copy))
    base = [draw.choice(words) for _ in range(160)]  # a group of copies, near and farther off
    for i in range(60):
        copy = list(base)
        for _ in range(i % 12):
            copy[draw.randrange(160)] = f"new{draw.randrange(10**6)}"
        texts.append(" ".join(copy))
    texts += ["", None, "!!", "one", "One", "two words", "same", "same", texts[0].upper(), "word " * 30_000]
    draw.shuffle(texts)
    return [(i * 2 + 1, t) for i, t in enumerate(texts)]


def test_classes_equal_brute_force(spark, rows):
    docs = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], SCHEMA).repartition(5)
    got = {r["doc_id"]: r["class_id"] for r in near_dedup.classes(docs).collect()}
    assert got == brute_force(rows)
    kept = near_dedup.keep_one(docs)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == set(got.values())


def test_prefix_stage_alone_finds_all_links(spark, rows):
    """Every pair of the wanted similarity passes the bounds, whatever the components so far."""
    docs = spark.createDataFrame([(d, t or "") for d, t in rows], "id long, text string")
    total, heavy, counts = near_dedup.frequent(docs, "text", lambda: near_dedup.Shingler().shingles, 0.1)
    weighing = spark.sparkContext.broadcast((total, heavy, counts))
    totals = near_dedup.sketches(docs, "id", "text", weighing)
    prefixes = near_dedup._prefixes(docs, totals, weighing, 0.8).withColumnRenamed("id", "node")
    placed = prefixes.withColumn("label", F.col("node")).withColumn("near", F.lit(5))
    pairs = {(r["v"], r["u"]) for r in near_dedup._bounded_pairs(placed, 0.8, False).collect()}
    weights = near_dedup.Weights(total, heavy, counts)
    found = dict(zip((d for d, _ in rows), weights.each([t or "" for _, t in rows])))
    ids = [d for d, _ in rows if len(found[d][0])]
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if near_dedup.similarity(found[a], found[b]) >= 0.8:
                assert (b, a) in pairs


PLACED = "node long, token long, label long, rest double, total double, near long"


def test_bounded_pairs_equal_all_pairs(spark):
    draw = random.Random(4)
    rows = []
    for token in range(12):
        for node in draw.sample(range(400), 90):
            total = draw.choice([100.0, 100.0, draw.uniform(60, 140)])
            rows.append((node, token, node % draw.choice([3, 400]), total * draw.uniform(0.79, 1), total, 90))
    share, want = 0.8 / 1.8 - near_dedup.FLOAT_ROOM, set()
    for a in rows:
        for b in rows:
            if a[1] == b[1] and a[0] > b[0] and a[2] != b[2] and min(a[3], b[3]) >= share * (a[4] + b[4]):
                want.add((a[0], b[0]))
    got = near_dedup._bounded_pairs(spark.createDataFrame(rows, PLACED), 0.8, False).collect()
    assert len(want) > 1000 and len(got) == len(want) and {(r["u"], r["v"]) for r in got} == want


def test_copies_that_are_too_different_do_not_meet(spark):
    """A large group with 15 % own shingles each, also when some light or little edited texts share them."""
    n, draw = 3000, random.Random(9)
    rows = [(i, t, i, draw.uniform(0.8, 0.85) * total, total, n) for i in range(n) for total in
            [draw.uniform(95, 105)] for t in range(3)]
    rows += [(n + i, t, n, 0.95 * 62, 62.0, n) for i in range(50) for t in range(3)]
    rows += [(2 * n + i, t, 2 * n, 0.9 * 104, 104.0, n) for i in range(50) for t in range(3)]
    sides = near_dedup._meetings(spark.createDataFrame(rows, PLACED), 0.8 / 1.8 - near_dedup.FLOAT_ROOM)
    keys = ["token", "cell", "salt"]
    a, b = (side.groupBy(*keys).agg(F.count(F.lit(1)).alias(name)) for side, name in zip(sides, "ab"))
    met = a.join(b, keys).agg(F.sum(F.col("a") * F.col("b"))).first()[0] or 0
    assert met < 3 * n


def test_a_cell_of_many_texts_is_dealt_out(spark):
    n = 1500
    rows = [(i, 7, i, 100.0, 100.0, n) for i in range(n)]
    sides = near_dedup._meetings(spark.createDataFrame(rows, PLACED), 0.8 / 1.8 - near_dedup.FLOAT_ROOM)
    visiting = sides[0].join(sides[1].select("token", "cell", "salt").distinct(), ["token", "cell", "salt"])
    assert visiting.groupBy("token", "cell", "salt").count().agg(F.max("count")).first()[0] < 2 * near_dedup.SALT_ROWS
    assert near_dedup._bounded_pairs(spark.createDataFrame(rows, PLACED), 0.8, False).count() == n * (n - 1) // 2


def test_templated_texts_stay_apart(spark):
    draw = random.Random(12)
    base = [f"b{i}" for i in range(400)]
    texts = []
    for i in range(300):
        copy = list(base)
        for at in range(draw.randrange(30), 400, 30):  # about 15 % of the shingles
            copy[at] = f"own{i}x{at}"
        texts.append(" ".join(copy))
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["class_id"] for r in near_dedup.classes(docs).collect()}
    assert got == brute_force(rows)


def test_samples_agree_as_often_as_texts_are_similar():
    draw = random.Random(2)
    base = [f"w{draw.randrange(5000)}" for _ in range(300)]
    weights, sampler = near_dedup.Weights(100, np.empty(0, np.uint64), np.empty(0)), near_dedup.Sampler(400)
    for edits in (3, 10, 30):
        copy = list(base)
        for _ in range(edits):
            copy[draw.randrange(300)] = f"n{draw.random()}"
        pair = weights.of([" ".join(base), " ".join(copy)])
        codes = sampler.codes(*pair)
        true = near_dedup.similarity(*weights.each([" ".join(base), " ".join(copy)]))
        assert abs((codes[0] == codes[1]).mean() - true) < 0.09


def test_repeated_null_and_no_rows(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (2, None), (3, "")]
    got = near_dedup.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    found = sorted(((r["doc_id"], r["class_id"], r["kept"]) for r in got), key=str)
    assert found == [(1, 1, True), (1, 1, True), (2, 2, True), (3, 2, False), (None, None, True)]
    assert near_dedup.classes(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_components(spark):
    draw = random.Random(6)
    edges = [(draw.randrange(300), draw.randrange(300)) for _ in range(220)]
    edges += [(1000 + i, 1001 + i) for i in range(40)] + [(2000, 2000 + i) for i in range(1, 200)]
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    want = {x: find(x) for x in parent if find(x) != x}
    frame = spark.createDataFrame(edges + [(5000, 5000), (None, 1)], "u long, v long")
    assert {r["node"]: r["label"] for r in components(frame).collect()} == want
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_rare_repeated_shingles_have_their_own_weight(spark):
    """A passage of three of forty texts weighs less than the words of one text alone."""
    texts = [" ".join(f"t{i}x{k}" for k in range(30)) for i in range(40)]
    for i in range(3):
        texts[i] = "a passage that three texts share word by word " + texts[i]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    find = lambda: near_dedup.Shingler().shingles
    counted = near_dedup.frequent(docs, "text", find, near_dedup.FINE, least=2)
    assert counted[0] == 40 and sorted(counted[2].tolist()) == [3] * 5
    weights = near_dedup.Weights(*counted, near_dedup.FINE)
    found = weights.each(["a passage that three texts", "t0x0 t0x1 t0x2 t0x3 t0x4"])
    assert found[0][1][0] == pytest.approx(2 + near_dedup.FALL * math.log10(40 / 3 / 10))
    assert found[1][1][0] == pytest.approx(2 + near_dedup.FALL * math.log10(40 / 10))


def test_idf_decides_between_classes(spark):
    """Two pairs of equal overlap: shingles of many texts hold less together than rare ones."""
    common = [f"c{k}" for k in range(46)]
    rare = [f"r{k}" for k in range(46)]
    texts = [" ".join([*base, *(f"{name}{i}x{k}" for k in range(5))])
             for base, name, n in ((common, "m", 30), (rare, "n", 2)) for i in range(n)]
    texts += [" ".join(f"f{i}x{k}" for k in range(20)) for i in range(400)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["class_id"] for r in near_dedup.classes(docs, heavy=near_dedup.FINE).collect()}
    assert got[30] == got[31] == 30
    assert len({got[i] for i in range(30)}) == 30


def test_every_frequency_counts_however_many_documents(spark):
    """A passage of two of 9,000 documents, fewer than one in 4,096, has the weight of two."""
    texts = [f"t{i}a t{i}b t{i}c t{i}d t{i}e" for i in range(9000)]
    texts[5] += " a passage that two texts share"
    texts[6000] += " a passage that two texts share"
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    total, found = near_dedup.exact_sketches(docs, "doc_id", "text")
    rows = {r["id"]: r for r in found.collect()}
    assert total == len(rows) == 9000
    rare, shared = (2 + near_dedup.FALL * math.log10(9000 / n / 10) for n in (1, 2))
    for i in (5, 6000):
        assert sorted(rows[i]["counts"]) == [1] * 5 + [2] * 2
        assert rows[i]["total"] == pytest.approx(5 * rare + 2 * shared)
    assert rows[7]["counts"] == [1] and rows[7]["total"] == pytest.approx(rare)


def test_exact_classes_equal_brute_force(spark, rows, monkeypatch):
    monkeypatch.setattr(near_dedup, "DEALT_BYTES", 1 << 12)
    docs = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], SCHEMA).repartition(5)
    counts = [shingles(t or "") for _, t in rows]
    df, total = Counter(s for c in counts for s in c), len(rows)
    weights = [
        {s: (1 + math.log(n)) * float(near_dedup.idf(total / df[s])) for s, n in c.items()} for c in counts
    ]
    edges = []
    for i in range(total):
        for j in range(i):
            a, b = weights[i], weights[j]
            low = sum(min(a[s], b[s]) for s in a.keys() & b.keys())
            whole = sum(a.values()) + sum(b.values()) - low
            if (rows[i][1] or "") == (rows[j][1] or "") or (whole and low / whole >= 0.8):
                edges.append((rows[i][0], rows[j][0]))
    labels = {d: d for d, _ in rows}
    for _ in rows:
        for a, b in edges:
            labels[a] = labels[b] = min(labels[a], labels[b])
    got = near_dedup.classes(docs, heavy=near_dedup.EXACT).collect()
    assert {r["doc_id"]: r["class_id"] for r in got} == labels


def test_exact_classes_of_repeated_null_and_no_rows(spark):
    rows = [(1, "a b c d e f"), (1, "other words stand in this one"), (None, "a b c d e f"), (2, None), (3, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = near_dedup.classes(docs, heavy=near_dedup.EXACT).collect()
    found = sorted(((r["doc_id"], r["class_id"]) for r in got), key=str)
    assert found == [(1, 1), (1, 1), (2, 2), (3, 2), (None, None)]
    nothing = spark.createDataFrame([], "doc_id long, text string")
    assert near_dedup.classes(nothing, heavy=near_dedup.EXACT).count() == 0


def test_batches_are_small_inside_only(spark):
    from opinara.llm.batches import BATCHES, small_batches

    before = {name: spark.conf.get(name) for name in BATCHES}
    with small_batches(spark):
        assert {name: spark.conf.get(name) for name in BATCHES} == BATCHES
    assert {name: spark.conf.get(name) for name in BATCHES} == before
