"""Encoding, counting and token files against the library."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from opinara.llm import bpe, token_counter, token_files
from opinara.llm.pieces import PIECES, Splitter

PATH = public_tokenizers.path("word_bpe_49k.json")
LETTERS = "abcdefghijklmnopqrstuvwxyz" * 3 + "'’éßÄİŉſΣς你好́🙂  \n\t<|>\x1c\x85\xa0½²٣0123456789!?.-_ AS"
STRINGS = ["<|endoftext|>", "<|startoftext|>", "'s're'll", "İstanbul ΣΑΣ", "don't we'd 'sam ''s"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def samples():
    draw = random.Random(3)
    made = ["", " ", "a", "a" * 5000, "".join(draw.choice("abcde") for _ in range(9000))]
    for i in range(600):
        text = "".join(draw.choice(LETTERS) for _ in range(draw.randrange(80)))
        made.append(text[:20] + STRINGS[i % 5] + text[20:] if i % 4 == 0 else text)
    return made


@pytest.fixture(scope="module")
def wanted(library, samples):
    return [library.encode(t, add_special_tokens=False).ids for t in samples]


def test_encoder_equals_the_library(samples, wanted):
    ids, sizes = bpe.Encoder(PATH).encode(samples)
    assert [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])] == wanted


def test_small_cache_changes_nothing(samples, wanted, monkeypatch):
    monkeypatch.setattr(bpe, "CACHED_WORDS", 50)
    encoder = bpe.Encoder(PATH)
    got = [encoder.encode([t])[0].tolist() for t in samples[:100]]
    assert got == wanted[:100]


def test_both_ways_of_merging_agree():
    merges = bpe.Encoder(PATH)
    merges.encode(["start"])
    draw = random.Random(5)
    for _ in range(200):
        word = "".join(draw.choice("aeinorst") for _ in range(draw.randrange(1, 40)))
        parts = list(word[:-1]) + [word[-1] + bpe.WORD_END]
        ids = [merges.merges.tokens[p] for p in parts]
        assert merges.merges._merge_short(list(ids)) == merges.merges._merge_long(list(ids))


def test_plain_pattern_equals_the_library():
    splitter = Splitter(PATH)
    draw = random.Random(7)
    letters = "ab'stmdrevl ÀÉÿßĀſ½²09.,-_“…€\n\t"
    for _ in range(3000):
        text = "".join(draw.choice(letters) for _ in range(draw.randrange(30)))
        assert splitter.is_plain(text)
        assert PIECES.findall(text.lower()) == splitter.library_pieces(text)


def test_round_trip_query(spark, library, samples, wanted):
    rows = [(i, t, "x") for i, t in enumerate(samples[:80])] + [(900, None, "x"), (None, "a b", "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = {r["doc_id"]: r for r in bpe.round_trip(docs, PATH).collect()}
    for i in range(80):
        assert got[i]["ids"] == wanted[i]
        assert got[i]["decoded"] == library.decode(wanted[i], skip_special_tokens=False)
    assert got[900]["ids"] == [] and got[900]["decoded"] == ""
    assert got[None]["decoded"] == library.decode(got[None]["ids"], skip_special_tokens=False)
    two_steps = bpe.decode(bpe.encode(docs, PATH), PATH)
    assert sorted(map(str, two_steps.collect())) == sorted(map(str, got.values()))
    assert bpe.round_trip(docs.limit(0), PATH).count() == 0


def test_counter_equals_the_library(samples, wanted):
    counter = token_counter.Counter(PATH)
    assert counter.counts(samples).tolist() == [len(w) for w in wanted]
    assert counter.counts([]).tolist() == []


@pytest.mark.parametrize("chunk", [1, 2, 7, 64])
def test_chunks_of_any_length(samples, wanted, monkeypatch, chunk):
    monkeypatch.setattr(token_counter, "CHUNK", chunk)
    texts = samples[:3] + samples[5:200]
    want = [len(w) for w in wanted[:3] + wanted[5:200]]
    assert token_counter.Counter(PATH).counts(texts).tolist() == want


@pytest.fixture(scope="module")
def long_words():
    draw = random.Random(11)
    letters = "abcdefghijklmnopqrstuvwxyz"
    return [
        "".join(draw.choice(letters) for _ in range(40_000)),
        "b" + "a" * 30_000,
        "x" + "abc" * 9_000 + "q" + "the" * 9_000,
        "lo " + "ha" * 12_001 + " lo",
        "你好世界" * 4_000,
        "é" * 20_000 + " " + "!?" * 9_000,
    ]


def test_words_of_many_chunks(library, long_words):
    want = [len(library.encode(t, add_special_tokens=False).ids) for t in long_words]
    assert token_counter.Counter(PATH).counts(long_words).tolist() == want


def test_a_word_over_several_stretches(library, long_words, monkeypatch):
    monkeypatch.setattr(token_counter, "STRETCH", 3000)
    monkeypatch.setattr(token_counter, "MAX_STATES", 500)
    want = [len(library.encode(t, add_special_tokens=False).ids) for t in long_words]
    assert token_counter.Counter(PATH).counts(long_words).tolist() == want


def test_counter_starts_again_when_full(samples, wanted, monkeypatch):
    monkeypatch.setattr(token_counter, "MAX_STATES", 100)
    counter = token_counter.Counter(PATH)
    got = [int(counter.counts([t])[0]) for t in samples[5:80]]
    assert got == [len(w) for w in wanted[5:80]]


def test_count_query(spark, samples, wanted):
    rows = [(i, t, 1) for i, t in enumerate(samples[:50])] + [(99, None, 1), (99, None, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    got = sorted(map(tuple, token_counter.count_tokens(docs, PATH).collect()))
    assert got == sorted([(i, len(w)) for i, w in enumerate(wanted[:50])] + [(99, 0), (99, 0)])
    assert token_counter.count_tokens(docs.limit(0), PATH).count() == 0


def test_token_files(spark, samples, wanted, monkeypatch):
    rows = [(i * 3, t, "x") for i, t in enumerate(samples[:90])] + [(1, None, "x"), (None, "null id", "x")]
    random.Random(1).shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string, start string").repartition(5)
    shards = token_files.placed(token_files.write(docs, PATH))
    got = sorted(map(tuple, token_files.checksums(shards).collect()), key=lambda r: r[1])
    library = Tokenizer.from_file(PATH)
    start, want = 0, []
    for doc, text, _ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = library.encode(text or "", add_special_tokens=False).ids + [1]
        want.append((doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert got == want
    empty = token_files.write(docs.limit(0), PATH)
    assert token_files.read(token_files.placed(empty)).count() == 0


def test_grammar_gives_back_any_range():
    draw = np.random.default_rng(2)
    ids = np.tile(draw.integers(0, 300, 200), 60).astype(np.uint32)
    ids[::17] = 5
    sizes = np.array([0, 1, 4000, 0, 5000, len(ids) - 9001, 0])
    left, right, expansion, symbols, ends = token_files.compress(ids, sizes, 49408)
    assert len(left) and len(symbols) < len(ids) / 2
    shard = token_files.Shard(
        49408, left, right, expansion, symbols, np.arange(7), np.ones(7, bool),
        ends.astype(np.uint32), sizes.astype(np.uint32),
    )
    shard = token_files.Shard.from_bytes(shard.to_bytes())
    starts = np.cumsum(sizes) - sizes
    for place in range(7):
        whole = ids[starts[place] : starts[place] + sizes[place]]
        assert (shard.document(place) == whole).all()
        for a, b in draw.integers(0, 5000, (20, 2)):
            assert (shard.document(place, int(a), int(b)) == whole[a:b]).all()


@pytest.mark.parametrize("n", [0, 1, 2, 31])
def test_runs_of_one_id(n):
    ids, sizes = np.full(n, 7, dtype=np.uint32), np.array([n])
    left, right, expansion, symbols, ends = token_files.compress(ids, sizes, 100)
    shard = token_files.Shard(
        100, left, right, expansion, symbols, sizes, sizes > -1, ends.astype("u4"), sizes.astype("u4")
    )
    assert (shard.document(0) == ids).all()


@pytest.mark.parametrize("vocabulary", [300, 49408, (1 << 16) - 10])
def test_rules_are_made_until_no_pair_is_frequent(vocabulary):
    draw = np.random.default_rng(3)
    passage = draw.integers(0, 300, 500)
    sizes = np.array([500] * 400 + [7] * 300)
    ids = np.concatenate([np.tile(passage, 400), draw.integers(0, 300, 2100)]).astype(np.uint32)
    left, right, expansion, symbols, ends = token_files.compress(ids, sizes, vocabulary)
    own = np.diff(np.concatenate([[0], ends]))
    assert own[:400].max() == 1 and expansion.max() == 500  # a repeated document is one symbol
    inner = np.ones(len(symbols), dtype=bool)
    inner[ends[own > 0] - 1] = False
    pair = (symbols[:-1].astype(np.int64) << 32) | symbols[1:]
    counts = np.unique(pair[inner[:-1]], return_counts=True)[1]
    assert not len(counts) or counts.max() < token_files.LEAST_COUNT
    none = np.empty(0)
    shard = token_files.Shard(vocabulary, left, right, expansion, symbols, none, none, ends, sizes)
    assert np.array_equal(shard.expand(symbols), ids)
    assert np.array_equal(shard.document(3, 17, 400), passage[17:400])
