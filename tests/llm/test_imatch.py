import hashlib
import random

import numpy as np
import pytest

from opinara.llm import imatch
from opinara.llm.words import WordHasher

SCHEMA = "doc_id long, text string, run int, last boolean"


def edited(own, following):
    n = len(own)
    return own[: n - n // 2] + following[: n // 2]


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(4)
    words = [f"wörd{i}" for i in range(300)]
    texts = [" ".join(draw.choice(words) for _ in range(draw.randrange(1, 120))) for _ in range(150)]
    texts += [texts[3], texts[3], "", None, "!!!", "x " * 40_000]
    return [(10 * i * i - 700, t, 1, True) for i, t in enumerate(texts)]


def test_edited_texts_and_likeness(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(6)
    terms = imatch.lexicon(docs)
    got = {r["doc_id"]: r for r in imatch.edited_fingerprints(docs, terms).collect()}
    plain = {r["doc_id"]: r["fingerprint"] for r in imatch.fingerprints(docs, terms).collect()}
    printer = imatch.Fingerprinter(terms)
    assert len(got) == len(rows)
    for place, (doc, text, *_) in enumerate(rows):
        text, after = text or "", rows[(place + 1) % len(rows)][1] or ""
        change = edited(text, after)
        row = got[doc]
        assert row["n_chars"] == len(text)
        assert row["edited_sha256"] == hashlib.sha256(change.encode()).hexdigest()
        numbers = printer.numbers([text, change, after])
        assert [row["fingerprint"], row["edited_fingerprint"]] == imatch.as_text(numbers[:2])
        assert plain[doc] == row["fingerprint"]
        assert row["near_edited"] == imatch.likeness(numbers[:1], numbers[1:2])[0]
        assert row["near_next"] == imatch.likeness(numbers[:1], numbers[2:])[0]
        assert 0 <= row["near_edited"] <= 1
    same = [got[rows[i][0]]["fingerprint"] for i in (3, 150, 151)]
    assert len(set(same)) == 1


@pytest.mark.parametrize("outlier", [10**15, None])
def test_runs_are_even_whatever_the_ids(spark, outlier):
    ids = [*range(2000), *range(10**9, 10**9 + 2000), outlier] + [None] * 300 + [77] * 300
    docs = spark.createDataFrame([(d, f"text {i}") for i, d in enumerate(ids)], "doc_id long, text string")
    rows = imatch.in_order(docs.repartition(5)).collect()
    runs = {}
    for r in rows:
        runs.setdefault(r["run"], []).append(r)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    own = [sum(not r["last"] for r in run) for run in runs.values()]
    assert sum(own) == len(ids) and max(own) < 3 * len(ids) / tasks + 1
    key = lambda r: (r["id"] is not None, r["id"] or 0, r["mark"])
    ordered = [key(r) for n in sorted(runs) for r in runs[n] if not r["last"]]
    assert ordered == sorted(ordered)
    for n, run in runs.items():  # each run ends with the first document of the next one
        following = runs[(n + 1) % len(runs)][0]
        assert run[-1]["last"] and key(run[-1]) == key(following) and not any(r["last"] for r in run[:-1])


def test_runs_follow_the_bytes(spark, monkeypatch):
    monkeypatch.setattr(imatch, "RUN_BYTES", 500)
    docs = spark.createDataFrame([(i, "t" * 50) for i in range(1000)], "doc_id long, text string")
    assert imatch.in_order(docs).select("run").distinct().count() > 50


def test_subsets_overlap_and_leave_no_term_out():
    printer = imatch.Fingerprinter(np.empty(0, np.uint64))
    terms = [f"term{i}" for i in range(4000)]
    kept = (printer.numbers(terms) != 0).sum(axis=1)
    assert kept.min() == 1 and kept.max() == 2
    assert abs(kept.mean() - 1 - imatch.EXTRA) < 0.05
    numbers = printer.numbers(terms)
    assert len(np.unique(numbers[numbers != 0])) == kept.sum()  # 32 bits keep terms apart
    assert all(len(t) == 8 * imatch.LEXICONS for t in imatch.as_text(numbers[:3]))
    sizes = (numbers != 0).sum(axis=0)
    assert sizes.min() > 0.5 * sizes.mean() and sizes.max() < 1.6 * sizes.mean()


def test_lexicon_is_the_band(spark):
    texts = [("common rare" if i == 0 else f"common mid only{i}") if i < 3000 else "common" for i in range(4000)]
    texts = [t.replace("mid", "mid" if i % 10 == 0 else f"own{i}") for i, t in enumerate(texts)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    hashes = {w: int(WordHasher().words([w])[0][0]) for w in ("common", "mid", "rare")}
    found = set(imatch.lexicon(docs).tolist())
    assert hashes["mid"] in found and hashes["common"] not in found and hashes["rare"] not in found


@pytest.mark.parametrize("rows", [[], [(5, "one text")], [(5, "a b"), (5, "a c"), (None, "d e f g")]])
def test_few_rows(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = imatch.edited_fingerprints(docs, np.empty(0, np.uint64)).collect()
    assert len(got) == len(rows)
    if len(rows) == 1:
        assert got[0]["near_next"] == 1.0


def test_word_hashes_are_those_of_split_words():
    hasher = WordHasher()
    text = "Hello, wörld! foo_bar “quoted” a·b ünï 12x"
    words = ["hello", "wörld", "foo_bar", "quoted", "a", "b", "ünï", "12x"]
    found, counts = hasher.words([text, "", "Hello"])
    assert counts.tolist() == [8, 0, 1]
    assert found.tolist() == [int(hasher.words([w])[0][0]) for w in words] + [found[0]]
    long = "y" * 400_000
    assert hasher.words([f"a {long} b", long])[0][1] == hasher.words([long])[0][0]
