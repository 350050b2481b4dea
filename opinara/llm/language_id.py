"""Language identification by averaged subword embeddings and a linear softmax.

The subwords of a text are its letter pairs and triples within words, word ends included, hashed
into a fixed number of buckets. A text is the average of its buckets' embeddings; one linear
layer scores the languages. Embeddings and layer are trained together by stochastic gradient
descent in numpy on the driver, on a sample of at most about `PER_LANGUAGE` rows of each language
(the documented bound; each row enters as bucket counts, however long its text). Only these counts
come to the driver. The triples that training saw are joined to a bitmap by the tasks, which also
find how novel the kept texts are. Buckets that training never saw stay zero.

A fifth of the sample is kept from training. It sets the temperature of the softmax and two
rejection thresholds. The first is the score that all but `ALPHA` of its texts reach, and `MOST` at
most, so a text in two languages by halves is kept; softmax scores of texts in no learned language
are often high, so it alone rejects little. The second is for the novelty of a text, the share of
its letter triples that training saw in no language, found by a second, finer hash: halfway between
what all but `ALPHA` of the kept texts stay below and the median of the same texts with their
letters shuffled. It has no ceiling, and never lies below the first of the two, so where triples
hardly repeat (as in ideographic scripts) learned texts stay. Triples of all languages count as
seen, so texts in two languages are no more novel than others. A close relative of a learned
language may share enough triples to pass. Without kept texts nothing is too novel. Texts without a
letter, and null texts, are `und` with score 0 and are rejected. Rows without id or language are
predicted but not learned from. Repeated rows are learned from and predicted row by row; an empty
table gives an empty result, and without labelled rows every text is `und`. Only the text is an
input of a prediction, extra columns are ignored.
"""

from __future__ import annotations

import unicodedata
import zlib
from collections.abc import Sequence
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinara.llm.batches import blocks, ragged, texts
from opinara.session import materialize

BUCKETS = 1 << 13
WIDTH = 16
PER_LANGUAGE = 1000
MAX_LANGUAGES = 1000
ALPHA, MOST = 0.002, 0.4
GRAM_BITS = 24
#: Added to a text's number of triples, so that one unknown triple is too little to reject a text;
#: texts of up to three triples may pass therefore.
GRAM_ROOM = 4
EPOCHS, BATCH, RATE = 30, 32, 0.5
#: Share of the sample that is kept from training.
KEPT = 0.2
#: Beyond this a count of one text is cut; shares do not change by it for texts below 2 GB.
MOST_COUNTED = (1 << 31) - 1
SEED = 5
BLOCK_BYTES = 1 << 20
UNKNOWN = "und"


@cache
def letter_table() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.array([unicodedata.category(chr(c))[0] == "L" for c in range(0x110000)])


def _spelled(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lower-case code points, blank where no letter, which are letters, and each one's text."""
    lowered = [t.lower() for t in texts]
    lengths = np.fromiter(map(len, lowered), dtype=np.int64, count=len(lowered)) + 1
    points = np.frombuffer(
        "".join(t + "\n" for t in lowered).encode("utf-32-le", "surrogatepass"), dtype=np.uint32
    )
    letters = letter_table()[points]
    owner = np.repeat(np.arange(len(texts), dtype=np.int64), lengths)
    return np.where(letters, points, np.uint32(32)), letters, owner


def grams(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of GRAM_BITS bits of all triples around a letter, and the number of each one's text."""
    return _grams(*_spelled(texts))


def _grams(code: np.ndarray, letters: np.ndarray, owner: np.ndarray):
    around = np.flatnonzero(letters[1:-1] & (owner[:-2] == owner[2:]))
    gram = np.zeros(len(around), dtype=np.uint64)
    for i in range(3):
        gram = (gram << np.uint64(21)) | code[around + i]
    gram *= np.uint64(0x9E3779B97F4A7C15)
    gram ^= gram >> np.uint64(29)
    gram *= np.uint64(0xBF58476D1CE4E5B9)
    return (gram >> np.uint64(64 - GRAM_BITS)).astype(np.int32), owner[around]


def shuffled(text: str) -> str:
    """The text with its letters in another order, the same for equal texts."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).copy()
    at = np.flatnonzero(letter_table()[points])
    seed = zlib.crc32(text.encode("utf-8", "surrogatepass"))
    points[at] = points[np.random.default_rng(seed).permutation(at)]
    return points.tobytes().decode("utf-32-le", "surrogatepass")


def bucket_counts(texts: Sequence[str]) -> np.ndarray:
    """A row of subword counts for each text; all zero for texts without a letter."""
    return _bucket_counts(*_spelled(texts), len(texts))


def _bucket_counts(code: np.ndarray, letters: np.ndarray, owner: np.ndarray, texts: int):
    owner = owner * BUCKETS
    total = np.zeros(texts * BUCKETS, dtype=np.int64)
    # Pairs with one letter at least, and triples around a letter; texts end in a non-letter.
    first, second = code[:-1], code[1:]
    pair = first * np.uint32(0x9E3779B1) + second * np.uint32(0x85EBCA77)
    inside = letters[:-1] | letters[1:]
    inside &= owner[:-1] == owner[1:]
    total += _counted(pair, owner[:-1], inside, len(total))
    triple = pair[:-1] + code[2:] * np.uint32(0xC2B2AE3D)
    around = letters[1:-1] & (owner[:-2] == owner[2:])
    total += _counted(triple, owner[:-2], around, len(total))
    return total.reshape(texts, BUCKETS)


def _counted(gram: np.ndarray, owner: np.ndarray, chosen: np.ndarray, size: int) -> np.ndarray:
    gram = gram[chosen]
    gram ^= gram >> np.uint32(15)
    gram *= np.uint32(0x2C1B3C6D)
    return np.bincount(owner[chosen] + (gram >> np.uint32(32 - 13)), minlength=size)


@dataclass
class Model:
    """What a prediction needs: `languages`, embeddings, linear layer and calibration."""

    languages: list[str]
    embedding: np.ndarray
    layer: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    threshold: float = 0.0
    #: A bit for each hash of a triple that training saw, and the novelty up to which texts stay.
    seen: np.ndarray | None = None
    most_novel: float = 1.0

    def logits(self, counts: np.ndarray) -> np.ndarray:
        share = counts / np.maximum(counts.sum(axis=1, keepdims=True), 1)
        return share.astype(np.float32) @ self.embedding @ self.layer + self.bias

    def probabilities(self, counts: np.ndarray) -> np.ndarray:
        return softmax(self.logits(counts) / self.temperature)

    def novelty(self, gram: np.ndarray, owner: np.ndarray, texts: int) -> np.ndarray:
        """The share of each text's triples that training never saw."""
        if self.seen is None:
            return np.zeros(texts)
        new = (self.seen[gram >> 3] >> (gram & 7).astype(np.uint8)) & 1 == 0
        total = np.bincount(owner, minlength=texts)
        return np.bincount(owner, weights=new, minlength=texts) / (total + GRAM_ROOM)

    def judge(self, texts: Sequence[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Languages and scores, and which texts are rejected."""
        spelled = _spelled(texts)
        names, scores = self._named(_bucket_counts(*spelled, len(texts)))
        novel = self.novelty(*_grams(*spelled), len(texts)) > self.most_novel
        return names, scores, (np.array(names) == UNKNOWN) | (scores < self.threshold) | novel

    def predict(self, texts: Sequence[str]) -> tuple[list[str], np.ndarray]:
        return self._named(bucket_counts(texts))

    def _named(self, counts: np.ndarray) -> tuple[list[str], np.ndarray]:
        if not self.languages:
            return [UNKNOWN] * len(counts), np.zeros(len(counts))
        scores = self.probabilities(counts)
        best = scores.argmax(axis=1)
        known = counts.any(axis=1)
        names = [self.languages[b] if k else UNKNOWN for b, k in zip(best, known)]
        return names, np.where(known, scores.max(axis=1), 0.0)


def softmax(logits: np.ndarray) -> np.ndarray:
    logits = logits - logits.max(axis=1, keepdims=True)
    power = np.exp(logits.astype(np.float64))
    return power / power.sum(axis=1, keepdims=True)


def train(
    languages: Sequence[str],
    rows: Sequence[tuple[np.ndarray, np.ndarray]],
    kept: np.ndarray,
    seed: int = SEED,
) -> Model:
    """Fit a model to bucket numbers and counts of texts and their languages; `kept` marks those
    that only calibrate it."""
    names = sorted(set(languages))
    draw = np.random.default_rng(seed)
    model = Model(
        names,
        np.zeros((BUCKETS, WIDTH), dtype=np.float32),
        np.zeros((WIDTH, len(names)), dtype=np.float32),
        np.zeros(len(names), dtype=np.float32),
    )
    if not names:
        return model
    wanted = np.array([names.index(lang) for lang in languages])

    def dense(chosen: np.ndarray) -> np.ndarray:
        counts = np.zeros((len(chosen), BUCKETS), dtype=np.float32)
        for i, row in enumerate(chosen):
            counts[i, rows[row][0]] = rows[row][1]
        return counts

    held, learned = np.flatnonzero(kept), np.flatnonzero(~kept)
    seen = np.unique(np.concatenate([rows[i][0] for i in learned]))
    scale = 1 / np.sqrt(WIDTH)
    model.embedding[seen] = draw.normal(0, scale, (len(seen), WIDTH)).astype(np.float32)
    model.layer[:] = draw.normal(0, scale, model.layer.shape).astype(np.float32)
    steps, step = EPOCHS * -(-len(learned) // BATCH), 0
    for _ in range(EPOCHS):
        draw.shuffle(learned)
        for start in range(0, len(learned), BATCH):
            chosen = learned[start : start + BATCH]
            counts = dense(chosen)
            share = counts / np.maximum(counts.sum(axis=1, keepdims=True), 1)
            hidden = share @ model.embedding
            wrong = softmax(hidden @ model.layer + model.bias).astype(np.float32)
            wrong[np.arange(len(chosen)), wanted[chosen]] -= 1
            rate = RATE * (1 - step / steps)
            back = wrong @ model.layer.T
            model.layer -= rate * hidden.T @ wrong / len(chosen)
            model.bias -= rate * wrong.mean(axis=0)
            # Shares are small numbers, so embeddings take larger steps than the layer.
            used = np.flatnonzero(counts.any(axis=0))
            model.embedding[used] -= rate * share[:, used].T @ back
            step += 1
    if len(held):
        parts = (held[i : i + BATCH] for i in range(0, len(held), BATCH))
        calibrate(model, np.concatenate([model.logits(dense(p)) for p in parts]), wanted[held])
    return model


def calibrate(model: Model, logits: np.ndarray, wanted: np.ndarray) -> None:
    """Set temperature and threshold from texts that training has not seen."""

    def loss(temperature: float) -> float:
        right = softmax(logits / temperature)[np.arange(len(wanted)), wanted]
        return float(-np.log(np.maximum(right, 1e-12)).mean())

    model.temperature = float(min(np.geomspace(0.2, 5, 41), key=loss))
    scores = np.sort(softmax(logits / model.temperature).max(axis=1))
    model.threshold = float(min(MOST, scores[int(ALPHA * len(scores))]))


def limit_novelty(model: Model, own: np.ndarray, mixed_up: np.ndarray) -> None:
    """Set the limit from how novel texts are that training has not seen, as they are and with
    their letters shuffled."""
    usual = np.sort(own)[len(own) - 1 - int(ALPHA * len(own))]
    model.most_novel = float(max(usual, (usual + np.median(mixed_up)) / 2))


def held_out(key: str = "doc_id") -> Column:
    """Documents that nothing is learned from."""
    rest = F.crc32(F.col(key).cast("string").cast("binary")) % 4
    return F.coalesce(rest == 2, F.lit(False))


def fit(docs: DataFrame, key: str = "doc_id", column: str = "text", label: str = "lang") -> Model:
    """Train on a bounded sample of the labelled rows that are not held out. Runs jobs."""
    rows = docs.select(
        F.col(key).alias("id"), F.col(label).alias("lang"), F.col(column).alias("text")
    ).filter(~held_out("id") & F.col("id").isNotNull() & F.col("lang").isNotNull())
    counts = rows.groupBy("lang").count().limit(MAX_LANGUAGES + 1).collect()
    if len(counts) > MAX_LANGUAGES:
        raise ValueError(f"over {MAX_LANGUAGES} languages")
    if not counts:
        return train([], [], np.zeros(0, dtype=bool))
    shares = docs.sparkSession.createDataFrame(
        [(r["lang"], min(1.0, PER_LANGUAGE / r["count"])) for r in counts],
        "lang string, share double",
    )
    draw = lambda seed: F.shiftrightunsigned(F.xxhash64(F.lit(seed), "id"), 11) / 2.0**53
    sample = materialize(
        rows.join(F.broadcast(shares), "lang")
        .filter(draw(SEED) < F.col("share"))
        .select("id", "lang", "text", (draw(SEED + 1) < KEPT).alias("kept")),
        "language-sample",
    )
    model, kept = _trained(sample)
    if kept:
        _note_triples(model, sample)
    return model


def _trained(sample: DataFrame) -> tuple[Model, int]:
    """A model of the sample's texts, and how many of them were kept from training."""
    kind = sample.schema["id"].dataType.simpleString()

    def features(batches):
        for block in blocks(batches, "text", BLOCK_BYTES):
            table = bucket_counts(texts(block, "text"))
            row, bucket = np.nonzero(table)
            lengths = np.bincount(row, minlength=block.num_rows)
            yield pa.RecordBatch.from_arrays(
                [
                    *(block.column(c) for c in ("id", "lang", "kept")),
                    ragged(bucket.astype(np.int16), lengths, pa.int16()),
                    ragged(np.minimum(table[row, bucket], MOST_COUNTED), lengths, pa.int32()),
                ],
                ["id", "lang", "kept", "buckets", "counts"],
            )

    schema = f"id {kind}, lang string, kept boolean, buckets array<short>, counts array<int>"
    found = sample.mapInArrow(features, schema).toArrow()
    found = found.sort_by([("lang", "ascending"), ("id", "ascending")])
    rows_of = list(zip(_arrays(found["buckets"]), _arrays(found["counts"])))
    used = [i for i, (b, _) in enumerate(rows_of) if len(b)]
    names, kept = found["lang"].to_pylist(), found["kept"].to_numpy()
    if kept[used].all():
        kept = np.zeros(len(kept), dtype=bool)
    model = train([names[i] for i in used], [rows_of[i] for i in used], kept[used])
    return model, int(kept[used].sum())


def _note_triples(model: Model, sample: DataFrame) -> None:
    """Note the triples of the learned texts, and calibrate the limit on the kept ones.

    The triples come to the driver as at most 2**(GRAM_BITS - 6) numbers of 64 bits, and of each
    kept text two numbers.
    """

    def seen_bits(batches):
        seen = np.zeros(1 << GRAM_BITS, dtype=bool)
        for block in blocks(batches, "text", BLOCK_BYTES):
            seen[grams(texts(block, "text"))[0]] = True
        numbers = np.packbits(seen, bitorder="little").view(np.int64)
        place = np.flatnonzero(numbers)
        yield pa.RecordBatch.from_arrays(
            [pa.array(place.astype(np.int32)), pa.array(numbers[place])], ["place", "bits"]
        )

    parts = sample.filter("NOT kept").select("text").mapInArrow(seen_bits, "place int, bits long")
    found = parts.groupBy("place").agg(F.bit_or("bits").alias("bits")).toArrow()
    numbers = np.zeros(1 << (GRAM_BITS - 6), dtype=np.int64)
    numbers[found["place"].to_numpy()] = found["bits"].to_numpy()
    model.seen = numbers.view(np.uint8)
    shared = sample.sparkSession.sparkContext.broadcast(model)

    def novelties(batches):
        for block in blocks(batches, "text", BLOCK_BYTES):
            own = texts(block, "text")
            both = [
                pa.array(shared.value.novelty(*grams(some), len(some)))
                for some in (own, list(map(shuffled, own)))
            ]
            lettered = bucket_counts(own).any(axis=1)
            yield pa.RecordBatch.from_arrays(both, ["own", "mixed_up"]).filter(pa.array(lettered))

    kept = sample.filter("kept").select("text")
    found = kept.mapInArrow(novelties, "own double, mixed_up double").toArrow()
    limit_novelty(model, found["own"].to_numpy(), found["mixed_up"].to_numpy())
    shared.destroy()


def _arrays(column: pa.ChunkedArray) -> list[np.ndarray]:
    column = column.combine_chunks()
    flat = column.flatten().to_numpy()
    ends = np.cumsum(pc.list_value_length(column).to_numpy())
    return np.split(flat, ends[:-1]) if len(ends) else []


def identify(docs: DataFrame, model: Model, key: str = "doc_id", column: str = "text") -> DataFrame:
    """Every row's key with `lang_pred, score` and `rejected`."""
    kind = docs.schema[key].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        model = shared.value
        for block in blocks(batches, column, BLOCK_BYTES):
            names, scores, rejected = model.judge(texts(block, column))
            yield pa.RecordBatch.from_arrays(
                [
                    block.column(key),
                    pa.array(names, pa.string()),
                    pa.array(scores),
                    pa.array(rejected, pa.bool_()),
                ],
                [key, "lang_pred", "score", "rejected"],
            )

    return docs.select(key, column).mapInArrow(
        run, f"`{key}` {kind}, lang_pred string, score double, rejected boolean"
    )


def keep_identified(docs: DataFrame, model: Model, column: str = "text") -> DataFrame:
    """The rows whose text is not rejected, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        model = shared.value
        for block in blocks(batches, column, BLOCK_BYTES):
            yield block.filter(pa.array(~model.judge(texts(block, column))[2]))

    return docs.mapInArrow(run, docs.schema)
