import itertools
import os
import zlib

import numpy as np
import pytest

from opinara.llm import line_quality
from opinara.llm.line_quality import BAD, FEATURES, GOOD, WIDTH, Field, Lines

SCHEMA = "doc_id long, text string, score string, label int, held int"
CLEAN = "The river runs down to the sea and takes its time.\nNobody there has seen it dry."
JUNK = "BUY### now$$$ BUY### now$$$ BUY### now$$$\n||| ||| |||\nBUY### now$$$ BUY### now$$$ BUY### now$$$"


def weights(seed):
    draw = np.random.default_rng(seed)
    field = Field.empty()
    for table in (field.own, field.before, field.after):
        table[:FEATURES] = draw.normal(0, 0.7, (FEATURES, 2))
    field.pairs[:] = draw.normal(0, 1.5, (2, 2))
    return field


def enumerated(field, found):
    """Marginals of a chain from all labellings of its lines."""
    total, good = 0.0, np.zeros(len(found))
    said = field.own[found].sum(axis=1)
    said[1:] += field.before[found[:-1]].sum(axis=1)
    said[:-1] += field.after[found[1:]].sum(axis=1)
    for labels in itertools.product((BAD, GOOD), repeat=len(found)):
        value = sum(said[i, y] for i, y in enumerate(labels))
        value += sum(field.pairs[a, b] for a, b in zip(labels, labels[1:]))
        total += np.exp(value)
        good += np.exp(value) * np.array(labels)
    return good / total


TEXTS = [CLEAN, JUNK, "", "one", "a\nb\n\na\nA b c d e f", "Ähre 1984 ###\n \n...", CLEAN + "\n" + JUNK]


@pytest.mark.parametrize("seed", range(3))
def test_marginals_equal_enumeration(seed):
    field = weights(seed)
    found, lengths, numbers = Lines().of(TEXTS)
    starts = np.cumsum(numbers) - numbers
    first = np.zeros(len(found), dtype=bool)
    first[starts] = True
    got = field.marginals(found, first)
    want = np.concatenate([enumerated(field, found[s : s + n]) for s, n in zip(starts, numbers)])
    np.testing.assert_allclose(got, want, atol=1e-9)
    by_hand = [
        (want[s : s + n] * np.maximum(lengths[s : s + n], 1)).sum() / np.maximum(lengths[s : s + n], 1).sum()
        for s, n in zip(starts, numbers)
    ]
    np.testing.assert_allclose(field.means(found, lengths, numbers), by_hand, atol=1e-9)


def test_slopes_equal_differences():
    field = weights(4)
    finder = Lines()
    runs, labels = [finder.of([t])[0] for t in TEXTS[:5]], np.array([1, 0, 0, 1, 1])

    def loss():
        total = 0.0
        for run, label in zip(runs, labels):
            said = field.emissions(run, np.arange(len(run)) == 0)
            value = said[:, label].sum() + field.pairs[label, label] * (len(run) - 1)
            alpha = said[0]
            for step in said[1:]:
                alpha = np.logaddexp(alpha[0] + field.pairs[0], alpha[1] + field.pairs[1]) + step
            total += np.logaddexp(*alpha) - value
        return total / sum(map(len, runs))

    slopes = line_quality._slopes(field, runs, labels)
    for table, slope in zip((field.own, field.before, field.after, field.pairs), slopes):
        for at in [(0, 0), (1, 1), (len(table) - 2, 0), (len(table) // 2, 1)]:
            table[at] += 1e-5
            up = loss()
            table[at] -= 2e-5
            down = loss()
            table[at] += 1e-5
            assert abs(slope[at] - (up - down) / 2e-5) < 1e-6


def test_features_of_lines():
    found, lengths, numbers = Lines().of(["Ab c.\nAb c.\n", "", "### $$$"])
    assert numbers.tolist() == [3, 1, 1] and lengths.tolist() == [5, 5, 0, 0, 7]
    assert found.shape == (5, WIDTH) and found.max() <= FEATURES
    ends, repeated, blank = (found[:, len(line_quality.BINS) + i] != FEATURES for i in (1, 2, 3))
    assert ends.tolist() == [True, True, False, False, False]
    assert repeated.tolist() == [False, True, False, False, False]
    assert blank.tolist() == [False, False, True, True, False]


def trained(spark):
    rows = [(i, CLEAN if i % 4 else JUNK, "x", 1, 1) for i in range(400)]
    docs = spark.createDataFrame(rows, SCHEMA)
    labels = spark.createDataFrame(
        [(i, int(i % 4 > 0), 0) for i in range(400)] + [(None, 1, 0), (3, None, 0), (900, 0, 1)],
        "doc_id long, quality int, toxic int",
    )
    return docs, labels, line_quality.fit(docs, labels)


def test_neighbours_and_edge_cases(spark):
    docs, labels, field = trained(spark)
    long = "\n".join([CLEAN] * 20_000) + "\n" + "word " * 300_000
    rows = [(1, CLEAN), (2, JUNK), (3, None), (4, ""), (5, long), (1, CLEAN), (None, "\n" * 9)]
    more = spark.createDataFrame([(d, t, "x", 1, 1) for d, t in rows], SCHEMA)
    got = [tuple(r) for r in line_quality.score(more, field).collect()]
    assert len(got) == len(rows) and all(0 <= s <= 1 and p == (s >= 0.3) for _, s, p in got)
    by_id = {d: s for d, s, _ in got}
    assert by_id[1] > 0.9 > 0.1 > by_id[2] and by_id[3] == by_id[4]
    labelled = dict(tuple(r) for r in line_quality.line_labels(more.filter("doc_id = 2"), field).collect())
    assert len(labelled[2]) == 3 and max(labelled[2]) < 0.3
    # Between good lines a doubtful line is better than between bad ones.
    middle = spark.createDataFrame(
        [(1, f"{CLEAN}\nthen so\n{CLEAN}"), (2, f"{JUNK}\nthen so\n{JUNK}")], "doc_id long, text string"
    )
    found = dict(tuple(r) for r in line_quality.line_labels(middle, field).collect())
    assert found[1][2] > found[2][3]


def test_empty_tables_and_single_labels(spark):
    docs, labels, _ = trained(spark)
    nothing = docs.limit(0)
    field = line_quality.fit(nothing, labels)
    assert line_quality.score(nothing, field).count() == 0
    for chosen, want in ((labels.limit(0), 0.5), (labels.filter("quality = 1"), 1.0)):
        scores = line_quality.score(docs, line_quality.fit(docs, chosen))
        assert {r["score"] for r in scores.collect()} == {want}


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="no test tables")
def test_held_out_documents(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    scores = {r["doc_id"]: r for r in line_quality.score(docs, line_quality.fit(docs, labels)).collect()}
    pairs = [
        (scores[r["doc_id"]], r["quality"]) for r in labels.collect() if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0
    ]
    assert np.mean([s["predicted"] == q for s, q in pairs]) > 0.95
    good = [s["score"] for s, q in pairs if q == 1]
    bad = [s["score"] for s, q in pairs if q == 0]
    assert np.mean([g > b for g in good for b in bad]) > 0.99
    assert np.mean([g >= 0.3 for g in good]) > 0.99
