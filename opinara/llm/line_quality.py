"""Document quality from a linear-chain conditional random field over the lines of a text.

Every line is good or bad. What speaks for either are binned features of the line (its length,
shares of symbols, capitals, digits and punctuation, length and variety of its words, repeated
words, its end, whether it stood before), the same features of the lines before and after it, and
which of the two the neighbours are. Forward and backward sums give each line's probability of
being good, and a document's score is the mean of these, weighted by the lines' lengths in code
points (one at least), put through a rising logistic curve that is fitted to runs of lines of
documents the field has not learned from.

Only documents are labelled: a line is trained on its document's label. The field learns by
stochastic gradient descent (Adam) in numpy on the driver from runs of up to `RUN` lines, about
`PER_LABEL` runs of each label at most, of which the share `HELD` is kept for the curve. These
bounds are the documented ones; scoring reads every line
of every text. Sums over a chain are taken by doubling steps over all lines of a block at once: a
line that starts a document multiplies by equal rows, which forgets what was before it.

Null and empty texts are one empty line and get a score. Documents without label or id are scored
but not learned from; where labels of an id differ, the largest counts. Repeated rows are scored
row by row, an empty table gives an empty result, and without labels of both kinds every score is
the share of good ones, one half without any label. Extra columns are ignored, and only the text is
an input of a score.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Sequence
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinara.llm.batches import blocks, map_blocks, ragged, texts
from opinara.llm.words import ODD, WordHasher, mixed

BAD, GOOD = 0, 1
PER_LABEL = 1500
RUN = 64
#: Share of the sampled documents that fit the curve.
HELD = 0.2
EPOCHS, BATCH, RATE, DECAY = 12, 64, 0.02, 1e-4
SEED = 3
BLOCK_BYTES = 1 << 20
THRESHOLD = 0.3

LETTER, CAPITAL, DIGIT, SPACE, MARK, SYMBOL = range(6)
MARKS = ".,;:!?'\"()-’“”«»„¿¡"
ENDS = ".!?"
# Upper ends of the bins of each measure; the last bin is open.
BINS = {
    "length": (0, 8, 32, 128, 512, 2048),
    "symbols": (0, 0.01, 0.03, 0.06, 0.12, 0.25),
    "capitals": (0, 0.03, 0.08, 0.2, 0.5),
    "digits": (0, 0.05, 0.2),
    "marks": (0, 0.02, 0.05, 0.12),
    "word_length": (0, 2, 4, 6, 8, 11),
    "variety": (0, 0.6, 0.75, 0.85, 0.9, 0.94, 0.97, 0.9999),
    "echoes": (0, 0.02, 0.1, 0.3),
}
FLAGS = ("bias", "ends", "repeated", "blank")
FEATURES = sum(len(edges) + 1 for edges in BINS.values()) + len(FLAGS)


@cache
def _kinds() -> np.ndarray:
    """The kind of each code point."""

    def kind(point: int) -> int:
        name = unicodedata.category(chr(point))
        if chr(point) in MARKS:
            return MARK
        if name in ("Lu", "Lt"):
            return CAPITAL
        return {"L": LETTER, "M": LETTER, "N": DIGIT, "Z": SPACE, "C": SPACE}.get(name[0], SYMBOL)

    return np.array([kind(point) for point in range(0x110000)], dtype=np.uint8)


class Lines:
    """Finds the features of the lines of texts."""

    def __init__(self):
        self.hasher = WordHasher()

    def of(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The set features of each line (a number for each bin and flag, in rows of equal length,
        FEATURES where a flag is not set), the lines' lengths, and the number of each text's."""
        split = [t.split("\n") for t in texts]
        numbers = np.fromiter(map(len, split), dtype=np.int64, count=len(split))
        lines = [line for found in split for line in found]
        n = len(lines)
        lengths = np.fromiter(map(len, lines), dtype=np.int64, count=n)
        points = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        kinds = _kinds()[points]
        owner = np.repeat(np.arange(n, dtype=np.int64), lengths)
        counts = np.bincount(owner * 6 + kinds, minlength=n * 6).reshape(n, 6)
        written = np.maximum(lengths, 1)
        hashes, words = self.hasher.words(lines)
        line_of = np.repeat(np.arange(n), words)
        named = mixed(hashes + line_of.astype(np.uint64) * ODD)
        distinct = np.bincount(line_of[np.unique(named, return_index=True)[1]], minlength=n)
        echo = np.flatnonzero(named[1:] == named[:-1]) + 1
        echoes = np.bincount(line_of[echo], minlength=n)
        letters = counts[:, LETTER] + counts[:, CAPITAL]
        # Longer lines have a smaller share of distinct words; its logarithms are comparable.
        variety = np.log(np.maximum(distinct, 1)) / np.log(np.maximum(words, 2))
        measures = {
            "length": lengths,
            "symbols": counts[:, SYMBOL] / written,
            "capitals": counts[:, CAPITAL] / np.maximum(letters, 1),
            "digits": counts[:, DIGIT] / written,
            "marks": counts[:, MARK] / written,
            "word_length": letters / np.maximum(words, 1),
            "variety": np.where(words > 3, variety, 0),
            "echoes": echoes / np.maximum(words, 1),
        }
        columns, first = [], 0
        for name, edges in BINS.items():
            columns.append(first + np.searchsorted(edges, measures[name], "left"))
            first += len(edges) + 1
        blank = counts[:, SPACE] == lengths
        ends = np.fromiter((line.rstrip()[-1:] in ENDS for line in lines), dtype=bool, count=n)
        repeated = np.fromiter(_repeats(split), dtype=bool, count=n)
        flags = (np.ones(n, dtype=bool), ends & ~blank, repeated & ~blank, blank)
        for place, flag in enumerate(flags):
            columns.append(np.where(flag, first + place, FEATURES))
        return np.stack(columns, axis=1).astype(np.int16), lengths, numbers


def _repeats(split: Sequence[Sequence[str]]):
    """Whether each line has stood in its text before."""
    for lines in split:
        seen: set[str] = set()
        for line in lines:
            yield line in seen
            seen.add(line)


WIDTH = len(BINS) + len(FLAGS)


@dataclass
class Field:
    """Weights of the features of a line, the one before and the one after; of pairs of labels;
    and the curve from mean marginals to scores."""

    own: np.ndarray
    before: np.ndarray
    after: np.ndarray
    pairs: np.ndarray
    slope: float = 1.0
    shift: float = 0.0
    constant: float | None = None

    @classmethod
    def empty(cls) -> Field:
        tables = [np.zeros((FEATURES + 1, 2)) for _ in range(3)]
        return cls(*tables, np.zeros((2, 2)))

    def emissions(self, found: np.ndarray, first: np.ndarray) -> np.ndarray:
        """What the features say for each label of each line; `first` marks starts of chains."""
        said = self.own[found].sum(axis=1)
        inner = np.flatnonzero(~first)
        said[inner] += self.before[found[inner - 1]].sum(axis=1)
        said[inner - 1] += self.after[found[inner]].sum(axis=1)
        return said

    def marginals(self, found: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Each line's probability of being good."""
        node, _ = sums(self.emissions(found, first), self.pairs, first)
        return node[:, GOOD]

    def score(self, found: np.ndarray, lengths: np.ndarray, numbers: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(numbers), self.constant)
        return self.curve(self.means(found, lengths, numbers))

    def means(self, found: np.ndarray, lengths: np.ndarray, numbers: np.ndarray) -> np.ndarray:
        """The mean marginal of each text's lines by their lengths."""
        if not len(numbers):
            return np.empty(0)
        starts = np.cumsum(numbers) - numbers
        first = np.zeros(len(found), dtype=bool)
        first[starts] = True
        weights = np.maximum(lengths, 1)
        good = self.marginals(found, first) * weights
        return np.add.reduceat(good, starts) / np.add.reduceat(weights, starts)

    def curve(self, means: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.slope * _logit(means) + self.shift)))


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p) - np.log1p(-p)


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products of matrices of logarithms, each less its largest entry."""
    c = np.logaddexp(a[:, :, :1] + b[:, :1, :], a[:, :, 1:] + b[:, 1:, :])
    return c - c.max(axis=(1, 2), keepdims=True)


def _prefixes(steps: np.ndarray) -> np.ndarray:
    """Products of all matrices up to each, by steps of doubled length."""
    steps, reach = steps.copy(), 1
    while reach < len(steps):
        steps[reach:] = _times(steps[:-reach], steps[reach:])
        reach *= 2
    return steps


def sums(said: np.ndarray, pairs: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marginals of each line's labels, and of the labels of each line and the one before it.

    `said` are emissions, `pairs` transitions and `first` the starts of chains; pairs of a start
    are zero.
    """
    n = len(said)
    if not n:
        return np.empty((0, 2)), np.empty((0, 2, 2))
    steps = np.where(first[:, None, None], 0.0, pairs) + said[:, None, :]
    forward = _prefixes(steps)[:, 0, :]
    # Backwards a line's matrix takes the step to the next; a last line forgets what follows.
    follows = np.zeros((n, 2, 2))
    follows[:-1] = np.where(first[1:, None, None], 0.0, pairs + said[1:, None, :])
    backward = _prefixes(follows[::-1].transpose(0, 2, 1))[::-1, 0, :]
    node = forward + backward
    node = np.exp(node - np.logaddexp(node[:, :1], node[:, 1:]))
    both = np.zeros((n, 2, 2))
    both[1:] = forward[:-1, :, None] + pairs + (said[1:] + backward[1:])[:, None, :]
    both -= both.max(axis=(1, 2), keepdims=True)
    both = np.exp(both)
    both /= both.sum(axis=(1, 2), keepdims=True)
    both[first] = 0
    return node, both


def train(
    runs: Sequence[np.ndarray], labels: np.ndarray, seed: int = SEED, epochs: int = EPOCHS
) -> Field:
    """A field for runs of lines, each line with the label of its run."""
    field, draw = Field.empty(), np.random.default_rng(seed)
    tables = [field.own, field.before, field.after, field.pairs]
    fast = [np.zeros_like(t) for t in tables]
    slow = [np.zeros_like(t) for t in tables]
    step = 0
    for _ in range(epochs):
        order = draw.permutation(len(runs))
        for start in range(0, len(order), BATCH):
            chosen = order[start : start + BATCH]
            slopes = _slopes(field, [runs[i] for i in chosen], labels[chosen])
            step += 1
            for table, a, b, slope in zip(tables, fast, slow, slopes):
                slope = slope + DECAY * table
                a += 0.1 * (slope - a)
                b += 0.001 * (slope**2 - b)
                table -= RATE * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.999**step)) + 1e-8)
                if len(table) > 2:
                    table[FEATURES] = 0
    return field


def _slopes(field: Field, runs: list[np.ndarray], labels: np.ndarray) -> list[np.ndarray]:
    """Derivatives of the mean loss of a line by the weights."""
    found, sizes = np.concatenate(runs), np.array([len(r) for r in runs])
    first = np.zeros(len(found), dtype=bool)
    first[np.cumsum(sizes) - sizes] = True
    wanted = np.repeat(labels, sizes)
    node, both = sums(field.emissions(found, first), field.pairs, first)
    wrong = node / len(found)
    wrong[np.arange(len(found)), wanted] -= 1 / len(found)
    inner = np.flatnonzero(~first)
    pairs = both.sum(axis=0) / len(found)
    np.add.at(pairs, (wanted[inner], wanted[inner]), -1 / len(found))

    def table(rows: np.ndarray, at: np.ndarray) -> np.ndarray:
        flat = rows.ravel()
        return np.stack(
            [
                np.bincount(flat, np.repeat(wrong[at, label], WIDTH), minlength=FEATURES + 1)
                for label in (BAD, GOOD)
            ],
            axis=1,
        )

    every = np.arange(len(found))
    return [
        table(found, every),
        table(found[inner - 1], inner),
        table(found[inner], inner - 1),
        pairs,
    ]


def fit_curve(field: Field, means: np.ndarray, labels: np.ndarray) -> None:
    """Set the curve by Newton steps on the logistic loss, held towards slope 1 and shift 0."""
    x = np.stack([_logit(means), np.ones(len(means))], axis=1)
    weights, prior = np.array([1.0, 0.0]), np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (p - labels) + weights - prior
        curvature = (x * (p * (1 - p))[:, None]).T @ x + np.eye(2)
        move = np.linalg.solve(curvature, slope)
        weights = weights - move
        if np.abs(move).max() < 1e-9:
            break
    field.slope, field.shift = max(float(weights[0]), 1e-3), float(weights[1])


def held_out(key: str = "doc_id") -> Column:
    """Documents that nothing is learned from."""
    rest = F.crc32(F.col(key).cast("string").cast("binary")) % 5
    return F.coalesce(rest == 0, F.lit(False))


def _place(*columns: str) -> Column:
    return F.shiftrightunsigned(F.xxhash64(F.lit(SEED), *columns), 11) / 2.0**53


def fit(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    column: str = "text",
    label: str = "quality",
    per_label: int = PER_LABEL,
) -> Field:
    """Train on bounded samples of the labelled documents that are not held out. Runs three jobs.

    About `per_label` ids of each label are sampled and broadcast. Ids may repeat in the documents
    and texts may be long, so the runs found for them are counted and thinned to the bound too.
    """
    known = (
        labels.select(F.col(key).alias("id"), F.col(label).cast("int").alias("label"))
        .filter(~held_out("id") & F.col("id").isNotNull() & F.col("label").isin(BAD, GOOD))
        .groupBy("id")
        .agg(F.max("label").alias("label"))
    )
    counts = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    if len(counts) < 2:
        field = Field.empty()
        field.constant = float(next(iter(counts), 0.5))
        return field
    share = lambda table: F.when(F.col("label") == GOOD, table[GOOD]).otherwise(table[BAD])
    ids = known.filter(_place("id") < share({k: F.lit(per_label / n) for k, n in counts.items()}))
    rows = docs.select(F.col(key).alias("id"), F.col(column).alias("text")).join(
        F.broadcast(ids), "id"
    )
    lines = F.length(F.coalesce("text", F.lit(""))) - F.length(
        F.replace(F.coalesce("text", F.lit("")), F.lit("\n"), F.lit(""))
    )
    sizes = rows.groupBy("label").agg(F.sum(F.floor(lines / RUN) + 1).alias("n")).collect()
    limit = {r["label"]: min(1.0, per_label / r["n"]) for r in sizes}

    def features(batches):
        finder = Lines()
        for block in blocks(batches, "text", BLOCK_BYTES):
            yield _runs(finder, block, limit)

    kind = rows.schema["id"].dataType.simpleString()
    schema = f"id {kind}, label int, held boolean, run int, lengths array<int>, found array<short>"
    # All runs of a document are on one side; for the curve each is a document.
    place = rows.select(
        "id", "label", "text", (_place("id", "text") < HELD).alias("held"),
        _place("text", "id").alias("place"),
    )
    sample = place.mapInArrow(features, schema).toArrow()
    sample = sample.sort_by([(c, "ascending") for c in ("label", "id", "run")])
    names, held = sample["label"].to_numpy(), sample["held"].to_numpy()
    found = [f.reshape(-1, WIDTH) for f in _arrays(sample["found"])]
    lengths = _arrays(sample["lengths"])
    learned = np.flatnonzero(~held)
    if len(set(names[learned])) < 2:
        learned = np.arange(len(names))
    field = train([found[i] for i in learned], names[learned])
    rest = np.flatnonzero(held)
    if len(set(names[rest])) == 2:
        means = field.means(
            np.concatenate([found[i] for i in rest]),
            np.concatenate([lengths[i] for i in rest]),
            np.array([len(lengths[i]) for i in rest]),
        )
        fit_curve(field, means, names[rest])
    return field


def _runs(finder: Lines, block: pa.RecordBatch, limit: dict[int, float]) -> pa.RecordBatch:
    """The block's texts cut into runs of RUN lines, thinned by a hash to `limit` of each label."""
    found, lengths, numbers = finder.of(texts(block, "text"))
    out: dict[str, list] = {c: [] for c in ("id", "label", "held", "run", "lengths", "found")}
    at = 0
    rows = zip(*(block.column(c).to_pylist() for c in ("id", "label", "held", "place")), numbers)
    for doc, label, held, place, n in rows:
        for run, start in enumerate(range(at, at + n, RUN)):
            stop = min(start + RUN, at + n)
            # A place of its own for each run; multiples of the golden ratio are spread evenly.
            if (place + run * 0.6180339887498949) % 1 < limit[label]:
                values = doc, label, held, run, lengths[start:stop], found[start:stop].ravel()
                for name, value in zip(out, values):
                    out[name].append(value)
        at += n
    sizes = np.array([len(v) for v in out["lengths"]], dtype=np.int64)
    flat = lambda name, kind: np.concatenate(out[name] or [np.empty(0, kind)])
    return pa.RecordBatch.from_arrays(
        [
            pa.array(out["id"], block.column("id").type),
            pa.array(out["label"], pa.int32()),
            pa.array(out["held"], pa.bool_()),
            pa.array(out["run"], pa.int32()),
            ragged(flat("lengths", np.int64), sizes, pa.int32()),
            ragged(flat("found", np.int16), sizes * WIDTH, pa.int16()),
        ],
        list(out),
    )


def _arrays(column: pa.ChunkedArray) -> list[np.ndarray]:
    column = column.combine_chunks()
    ends = np.cumsum(pc.list_value_length(column).to_numpy())
    return np.split(column.flatten().to_numpy(), ends[:-1]) if len(ends) else []


def score(
    docs: DataFrame, field: Field, key: str = "doc_id", column: str = "text"
) -> DataFrame:
    """Every row's key with its `score` and `predicted`, 1 from THRESHOLD on."""
    shared = docs.sparkSession.sparkContext.broadcast(field)

    def build():
        finder, field = Lines(), shared.value

        def apply(block):
            scores = field.score(*finder.of(texts(block, "text")))
            return pa.RecordBatch.from_arrays(
                [block.column("id"), pa.array(scores, pa.float64())], ["id", "score"]
            )

        return apply

    rows = docs.select(F.col(key).alias("id"), F.col(column).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    scored = map_blocks(rows, "text", build, f"id {kind}, score double", limit=BLOCK_BYTES)
    return scored.select(
        F.col("id").alias(key),
        "score",
        F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"),
    )


def line_labels(
    docs: DataFrame, field: Field, key: str = "doc_id", column: str = "text"
) -> DataFrame:
    """Every row's key with `good`, its lines' probabilities of being good, in order."""
    shared = docs.sparkSession.sparkContext.broadcast(field)

    def build():
        finder, field = Lines(), shared.value

        def apply(block):
            found, _, numbers = finder.of(texts(block, "text"))
            first = np.zeros(len(found), dtype=bool)
            first[np.cumsum(numbers) - numbers] = True
            good = ragged(field.marginals(found, first), numbers, pa.float64())
            return pa.RecordBatch.from_arrays([block.column("id"), good], ["id", "good"])

        return apply

    rows = docs.select(F.col(key).alias("id"), F.col(column).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    found = map_blocks(rows, "text", build, f"id {kind}, good array<double>", limit=BLOCK_BYTES)
    return found.withColumnRenamed("id", key)
