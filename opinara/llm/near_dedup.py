"""Near-duplicate classes by consistent weighted sampling of TF-IDF shingles.

Shingles are five lower-case words in a row (all words of a shorter text). A shingle's weight in
a document is (1 + ln tf) * idf. The idf is 1 + log10(N / df) down to a tenth of the documents, so
1 to 2; below that it rises by FALL for each tenth more, because a large group of edited copies must
stay together, whose common shingles weigh less than the edits. With `heavy` of EXACT, which the query
and the pipeline take, every frequency counts: documents are dealt to blocks, `repeated` finds by a
shuffle which shingles several documents hold, and each block gets the frequencies of its own, so no
task holds a table of all of them. A document's frequencies stay beside its sketch for the steps that
weigh its text again. With a share in `heavy`, frequencies below it count as that share. So those that
matter are at most 1 / heavy times the mean number of shingles of a document, however many documents
there are, and `frequent` counts them for a broadcast.

Improved consistent weighted sampling draws SAMPLES pairs (shingle, quantile) per document; two
documents agree in a sample with the probability of their weighted Jaccard similarity. The random
variates come from fixed tables indexed by a hash of the shingle. Four samples make a band,
documents that share a band are candidates.

Candidates are verified by their exact weighted Jaccard similarity, never as all pairs of a
bucket: every member is compared with the smallest id of its bucket, and links join members to
components. Members of buckets that still hold several components are searched for further links
by exact prefix filtering. Shingles are ordered from rare to frequent among these members; two
texts of the wanted similarity share a shingle from which on both still hold that share of their
weight, and the weights from there on bound their overlap. First each text is compared with the
one that holds the largest share from the shingle on, the hub of a group of edited copies; then
whatever pairs of different components still pass the bound are compared. Of such a pair the
lighter text holds from the shingle on as much as two of its own weight need, and its weight lies
in a range that the heavier one's weight and rest set. So only these texts wait at a shingle, in
cells of weight, and the others visit the cells of their range; cells with no waiting text that may
suffice are left out, and full ones are dealt out. So no link between components of a bucket is
lost, edited copies with too many edits of their own meet nobody, and a bucket of one group costs
one comparison a member.

Equal texts are one candidate and one class. Null texts are empty; texts without words are alike
only if equal. Rows that repeat an id are one document. A row with a null id has a null class and
stays. Extra columns are ignored by `classes` and passed on by `keep_one`.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinara.llm.batches import blocks, map_blocks, ragged, small_batches, task_number, texts
from opinara.llm.bitmaps import likely
from opinara.llm.components import components
from opinara.llm.frequent import frequent, repeated
from opinara.llm.salting import SALTS, salted_join
from opinara.llm.words import ODD, WordHasher, mixed
from opinara.session import materialize, release

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 12, 4
SAMPLES = BANDS * ROWS
HEAVY = 0.1
FINE = 1 / 4096
EXACT = 0.0
FALL = 0.2
HEAVY_BLOCK_BYTES = 32 << 20
SALT_ROWS = 256
#: Cells of weight between a text and one of SIMILARITY times its weight.
CELLS = 4
PAIRS = 512
SEED = 11
TABLE_BITS = 16
FLOAT_ROOM = 1e-5
BLOCK_BYTES = 1 << 19
#: Text of a block whose documents get their frequencies together, and blocks of a task.
DEALT_BYTES = 4 << 20
DEALT = 16


class Shingler:
    """Hashes of the word shingles of texts."""

    def __init__(self, width: int = SHINGLE):
        self.width, self.hasher = width, WordHasher()

    def shingles(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all shingles, text by text, and the number of each text."""
        flat, counts = self.hasher.words(texts)
        width = self.width
        numbers = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
        starts = np.cumsum(counts) - counts
        begin = np.repeat(starts, numbers) + (
            np.arange(numbers.sum()) - np.repeat(np.cumsum(numbers) - numbers, numbers)
        )
        length = np.repeat(np.minimum(counts, width), numbers)
        found = length.astype(np.uint64)
        for i in range(width):
            inside = length > i
            part = flat[np.minimum(begin + i, len(flat) - 1)] if len(flat) else flat
            found = np.where(inside, mixed(found * ODD + part), found)
        return found, numbers


def idf(often):
    """By the number of documents for each one with the shingle."""
    steps = np.log10(np.maximum(often, 1))
    usual = -np.log10(HEAVY)
    return 1 + np.minimum(steps, usual) + FALL * np.maximum(steps - usual, 0)


class Weights:
    """Weights of the distinct shingles of texts."""

    def __init__(
        self, total: int, heavy: np.ndarray, frequencies: np.ndarray, share: float = HEAVY
    ):
        self.shingler, self.total = Shingler(), total
        self.heavy, self.frequencies = heavy, frequencies
        least = max(total * share, 1e-9)
        self.idf = idf(total / np.maximum(frequencies, least))
        # Of the other shingles, which are in fewer documents than `share` of them, or in one.
        self.rare = float(idf(1 / share if least >= 1 else max(total, 1)))

    def of(
        self, texts: Sequence[str], given: np.ndarray | None = None
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sorted distinct shingles of each text, their weights, and their number.

        `given` are the frequencies of all these shingles, where they are known.
        """
        found, numbers = self.shingler.shingles(texts)
        ends = np.cumsum(numbers)
        parts = [
            np.unique(found[e - n : e], return_counts=True) for e, n in zip(ends, numbers)
        ]
        if not parts:
            return found, np.empty(0), numbers
        shingles = np.concatenate([p[0] for p in parts])
        weights = 1 + np.log(np.concatenate([p[1] for p in parts]))
        if given is not None:
            weights *= idf(self.total / given)
        elif len(self.heavy):
            at, known = self._known(shingles)
            weights *= np.where(known, self.idf[at], self.rare)
        else:
            weights *= self.rare
        return shingles, weights, np.array([len(p[0]) for p in parts])

    def _known(self, shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(self.heavy, shingles), len(self.heavy) - 1)
        return at, self.heavy[at] == shingles

    def counts(self, shingles: np.ndarray) -> np.ndarray:
        """Their frequencies, 1 for those that are not among the known ones."""
        if not len(self.heavy):
            return np.ones(len(shingles), dtype=np.int64)
        at, known = self._known(shingles)
        return np.where(known, self.frequencies[at], 1)

    def each(
        self, texts: Sequence[str], given: np.ndarray | None = None
    ) -> list[tuple[np.ndarray, np.ndarray]]:
        shingles, weights, numbers = self.of(texts, given)
        ends = np.cumsum(numbers)[:-1]
        return list(zip(np.split(shingles, ends), np.split(weights, ends)))


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two sets of distinct sorted shingles with weights."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    low = np.minimum(a[1][i], b[1][j]).sum()
    return float(low / max(a[1].sum() + b[1].sum() - low, 1e-12))


class Sampler:
    """Improved consistent weighted samples of documents, as codes."""

    def __init__(self, samples: int = SAMPLES, seed: int = SEED, usual: float = 1 - np.log10(HEAVY)):
        draw = np.random.default_rng(seed)
        size = (samples, 1 << TABLE_BITS)
        self.r = draw.gamma(2, 1, size).astype(np.float32)
        self.log_c = np.log(draw.gamma(2, 1, size)).astype(np.float32)
        self.beta = draw.random(size).astype(np.float32)
        self.odd = draw.integers(0, 1 << 62, samples, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        # Most shingles are rare and occur once in a text: theirs are drawn beforehand.
        self.usual = np.log(np.array([usual])).astype(np.float32)
        every = np.arange(1 << TABLE_BITS)
        self.usual_a = [self.drawn(k, every, self.usual)[0] for k in range(samples)]

    def drawn(self, k: int, at: np.ndarray, log_w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """ln a and t of the method, for table entries and logarithms of weights."""
        r, beta = self.r[k][at], self.beta[k][at]
        t = np.floor(log_w / r + beta)
        return self.log_c[k][at] - r * (t - beta) - r, t

    def codes(self, shingles: np.ndarray, weights: np.ndarray, numbers: np.ndarray) -> np.ndarray:
        """A row of codes for each document with shingles."""
        numbers = numbers[numbers > 0]
        starts = np.cumsum(numbers) - numbers
        owner = np.repeat(np.arange(len(numbers)), numbers)
        codes = np.full((len(numbers), len(self.odd)), np.iinfo(np.uint64).max, dtype=np.uint64)
        log_w = np.log(weights).astype(np.float32)
        other = np.flatnonzero(log_w != self.usual)
        for k, odd in enumerate(self.odd):
            at = ((shingles * odd) >> np.uint64(64 - TABLE_BITS)).astype(np.int64)
            log_a = self.usual_a[k][at]
            log_a[other] = self.drawn(k, at[other], log_w[other])[0]
            least = np.flatnonzero(log_a == np.minimum.reduceat(log_a, starts)[owner])
            level = self.drawn(k, at[least], log_w[least])[1].astype(np.int64).view(np.uint64)
            np.minimum.at(codes[:, k], owner[least], mixed(shingles[least] + mixed(level + ODD)))
        return codes


def band_keys(codes: np.ndarray) -> np.ndarray:
    keys = np.zeros((len(codes), BANDS), dtype=np.uint64)
    for row in range(ROWS):
        keys = mixed(keys * ODD + codes[:, row::ROWS])
    return keys


def _sums(weights: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    sums, ends = np.concatenate([[0.0], np.cumsum(weights)]), np.cumsum(numbers)
    return sums[ends] - sums[ends - numbers]


SKETCH = "mark string, bands array<long>, total double"


def _sketch(
    block: pa.RecordBatch, column: str, weights: Weights, sampler: Sampler, counted: bool
) -> pa.RecordBatch:
    found = texts(block, column)
    marks = [hashlib.sha256(t.encode("utf-8", "replace")).hexdigest()[:32] for t in found]
    shingles, weight, numbers = weights.of(found)
    keys = band_keys(sampler.codes(shingles, weight, numbers)).view(np.int64)
    bands = ragged(keys.ravel(), np.where(numbers > 0, BANDS, 0), pa.int64())
    columns = [block.column("id"), pa.array(marks), bands, pa.array(_sums(weight, numbers))]
    names = ["id", "mark", "bands", "total"]
    if counted:
        columns.append(ragged(weights.counts(shingles), numbers, pa.int64()))
        names.append("counts")
    return pa.RecordBatch.from_arrays(columns, names)


def sketches(docs: DataFrame, key: str, column: str, weighing) -> DataFrame:
    """`id, mark` of every row, `bands`, the keys of its bands, empty without words, and `total`,
    the sum of its weights."""

    def build():
        weights = Weights(*weighing.value)
        sampler = Sampler(usual=weights.rare)
        return lambda block: _sketch(block, column, weights, sampler, counted=False)

    rows = docs.select(F.col(key).alias("id"), F.col(column).alias(column))
    kind = rows.schema["id"].dataType.simpleString()
    return map_blocks(rows, column, build, f"id {kind}, {SKETCH}", limit=BLOCK_BYTES)


def exact_sketches(docs: DataFrame, key: str, column: str) -> tuple[int, DataFrame]:
    """The number of rows, and the same of every row by the frequencies of all shingles, with
    `counts`, those of its sorted distinct shingles. Runs jobs."""
    spark = docs.sparkSession
    total, size = docs.agg(F.count(F.lit(1)), F.sum(F.octet_length(column))).first()
    number = max(-(-(size or 0) // DEALT_BYTES), DEALT * task_number(spark, 0, 1))
    dealt = F.pmod(F.xxhash64(key, column), F.lit(number)).cast("int").alias("block")
    rows = docs.select(dealt, F.col(key).alias("id"), F.col(column).alias("text"))
    known = materialize(repeated(rows, "text", lambda: Shingler().shingles), "repeated-shingles")
    release(spark)
    made = []

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        items = right.column("item").to_numpy().view(np.uint64)
        items, first = np.unique(items, return_index=True)
        weights = Weights(total, items, right.column("n").to_numpy()[first], EXACT)
        if not made:
            made.append(Sampler(usual=weights.rare))
        parts = blocks(left.to_batches(), "text", BLOCK_BYTES)
        found = [_sketch(p, "text", weights, made[0], counted=True) for p in parts]
        return pa.Table.from_batches(found)

    kind = rows.schema["id"].dataType.simpleString()
    sketched = rows.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(
        run, f"id {kind}, {SKETCH}, counts array<long>"
    )
    return total, sketched


def _salted(frame: DataFrame, salts: Column) -> DataFrame:
    return frame.withColumn("salt", F.explode(F.sequence(F.lit(0), salts - 1)))


def _salt(value: str, salts: Column) -> Column:
    return F.pmod(F.xxhash64(value), salts).cast("int").alias("salt")


def _counts(contents: DataFrame) -> list[str]:
    return [c for c in contents.columns if c == "counts"]


def _body(rows: pa.StructArray | pa.RecordBatch) -> tuple[list[str], np.ndarray | None]:
    """Texts and the frequencies of their shingles, None where they are not beside them."""
    if isinstance(rows, pa.StructArray):
        rows = pa.RecordBatch.from_struct_array(rows)
    given = rows.column("counts").flatten().to_numpy() if "counts" in rows.schema.names else None
    return texts(rows, "text"), given


def verified(pairs: DataFrame, contents: DataFrame, weighing, least: float) -> DataFrame:
    """The pairs `u, v` whose texts have a similarity of `least` or more.

    `near` of a pair is how many others its `v` may have; by it `v`'s text is salted. Only texts
    of the pairs are shuffled.
    """
    pairs = materialize(pairs, "pairs")
    salts = F.ceil(F.col("near") / SALT_ROWS).cast("int")
    fan = pairs.groupBy(F.col("v").alias("id")).agg(F.max("near").alias("near"))
    fan = materialize(fan, "pair-ends")
    ends = likely(contents, "id", fan.select("id"))
    body = F.struct("text", *_counts(contents))
    right = _salted(ends.join(fan, "id"), salts).select(
        F.col("id").alias("v"), "salt", body.alias("right")
    )
    others = likely(contents, "id", pairs.select("u"))
    left = pairs.join(
        others.select(F.col("id").alias("u"), body.alias("left")), "u"
    ).select("u", "v", "left", _salt("u", salts))
    joined = left.join(right, ["v", "salt"]).select("u", "v", "left", "right")

    def run(batches):
        weights = Weights(*weighing.value)
        for batch in batches:
            for start in range(0, batch.num_rows, PAIRS):
                part = batch.slice(start, PAIRS)
                ends = part.column("v").to_pylist()
                place = {v: i for i, v in enumerate(ends)}
                others = part.column("right").take(pa.array(list(place.values()), pa.int64()))
                right = dict(zip(place, weights.each(*_body(others))))
                left = weights.each(*_body(part.column("left")))
                good = [similarity(a, right[v]) >= least - 1e-9 for a, v in zip(left, ends)]
                yield part.select(["u", "v"]).filter(pa.array(good, pa.bool_()))

    kind = pairs.schema["u"].dataType.simpleString()
    return joined.mapInArrow(run, f"u {kind}, v {kind}")


def _labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    return rows.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))


def _several(rows: DataFrame, by: list[str]) -> DataFrame:
    """The rows of the groups that hold several labels, with `near`, the size of the group."""
    mixed_groups = (
        rows.groupBy(*by)
        .agg(
            F.min("label").alias("low"), F.max("label").alias("high"), F.count(F.lit(1)).alias("n")
        )
        .filter("low <> high")
        .select(*by, F.col("n").alias("near"))
    )
    return salted_join(rows, mixed_groups, by, "node", "inner")


def _prefixes(contents: DataFrame, totals: DataFrame, weighing, least: float) -> DataFrame:
    """`id, token, rest, total`: shingles from which on a text holds `least` of its weight.

    Only shingles of several texts matter. They stand in the order of their frequency; the
    shingles of one text alone come before all of them and count in its `total` weight only.
    Weights travel as floats, for which the bounds leave room.
    """
    kind = contents.schema["id"].dataType.simpleString()

    def postings(batches):
        weights = Weights(*weighing.value)
        for block in blocks(batches, "text", BLOCK_BYTES):
            shingles, weight, numbers = weights.of(*_body(block))
            owner = np.repeat(np.arange(len(numbers)), numbers)
            yield pa.RecordBatch.from_arrays(
                [
                    block.column("id").take(pa.array(owner)),
                    pa.array(shingles.view(np.int64)),
                    pa.array(weight.astype(np.float32)),
                ],
                ["id", "token", "weight"],
            )

    rows = contents.select("id", "text", *_counts(contents)).mapInArrow(
        postings, f"id {kind}, token long, weight float"
    )
    often = rows.groupBy("token").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    ordered = (
        rows.join(materialize(often, "token-counts"), "token")
        .groupBy("id")
        .agg(F.sort_array(F.collect_list(F.struct("df", "token", "weight"))).alias("tokens"))
        .join(totals.groupBy("id").agg(F.max("total").alias("total")), "id")
    )

    def cut(batches):
        for batch in batches:
            tokens, total = batch.column("tokens"), batch.column("total").to_numpy()
            entries, numbers = tokens.flatten(), pc.list_value_length(tokens).to_numpy()
            ends = np.cumsum(numbers)
            owner = np.repeat(np.arange(len(numbers)), numbers)
            weight = entries.field("weight").to_numpy().astype(np.float64)
            sums = np.concatenate([[0.0], np.cumsum(weight)])
            rest = sums[ends][owner] - sums[:-1]
            kept = np.flatnonzero(rest >= (least - FLOAT_ROOM) * total[owner])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id").take(pa.array(owner[kept])),
                    entries.field("token").take(pa.array(kept)),
                    pa.array(rest[kept]),
                    pa.array(total[owner[kept]]),
                ],
                ["id", "token", "rest", "total"],
            )

    return ordered.mapInArrow(cut, f"id {kind}, token long, rest double, total double")


def _bounded_pairs(placed: DataFrame, least: float, hubs_only: bool) -> DataFrame:
    """Pairs `u, v` of different labels whose overlap from a shared token on may suffice."""
    share = least / (1 + least) - FLOAT_ROOM
    enough = F.least("rest", "v_rest") >= share * (F.col("total") + F.col("v_total"))
    wanted = (F.col("label") != F.col("other")) & enough
    if hubs_only:
        fields = ("v", "other", "v_rest", "v_total")
        best = F.max(F.struct((F.col("v_rest") / F.col("v_total")).alias("share"), *fields))
        hubs = _others(placed).groupBy("token").agg(best.alias("b")).select(
            "token", *(F.col(f"b.{f}").alias(f) for f in fields)
        )
        found = salted_join(placed, hubs, ["token"], "node", "inner").filter(wanted)
        ends = F.col("node").alias("u"), F.col("v")
    else:
        visiting, waiting = _meetings(placed, share)
        found = visiting.join(_others(waiting, "cell", "salt"), ["token", "cell", "salt"]).filter(
            (F.struct("v_total", "v") < F.struct("total", "node")) & wanted
        )
        ends = F.greatest("node", "v").alias("u"), F.least("node", "v").alias("v")
    return found.groupBy(*ends).agg(F.max("near").alias("near"))


def _others(placed: DataFrame, *more: str) -> DataFrame:
    return placed.select(
        "token",
        *more,
        F.col("node").alias("v"),
        F.col("label").alias("other"),
        F.col("rest").alias("v_rest"),
        F.col("total").alias("v_total"),
    )


def _meetings(placed: DataFrame, share: float) -> tuple[DataFrame, DataFrame]:
    """Rows that meet on `token, cell, salt`: heavier texts that visit, and lighter that wait.

    Both rests of a pair are `share` of both totals or more. So the lighter text's rest is twice
    the share of its own total, and its total is at least share / (1 - share) of the other's, which
    the other's rest bounds from above. Left out are rows that no other label of a cell can suit.
    """
    room = 1 - FLOAT_ROOM
    cell = lambda weight: F.floor(F.log(weight) * (CELLS / -np.log(SIMILARITY)))
    # The most that the other text of a pair may weigh.
    reach = F.col("rest") / share - F.col("total")
    low = F.col("total") * (share / (1 - share) * room)
    high = F.least(F.col("total"), reach / room)
    waiting = placed.filter(reach >= F.col("total") * room).withColumn("cell", cell(F.col("total")))
    visiting = placed.filter(high >= low).withColumn(
        "cell", F.explode(F.sequence(cell(low), cell(high)))
    )

    def suiting(rows: DataFrame, others: DataFrame) -> DataFrame:
        cells = others.groupBy("token", "cell").agg(
            F.min("label").alias("low"),
            F.max("label").alias("high"),
            F.min("total").alias("lightest"),
            F.max(reach).alias("farthest"),
            F.count(F.lit(1)).alias("others"),
        )
        suits = (F.col("low") != F.col("label")) | (F.col("high") != F.col("label"))
        suits &= (F.col("lightest") * room <= reach) & (F.col("total") * room <= F.col("farthest"))
        return (
            salted_join(rows, cells, ["token", "cell"], "node", "inner")
            .filter(suits)
            .drop("low", "high", "lightest", "farthest")
        )

    visiting = materialize(suiting(visiting, waiting).drop("others"), "visiting")
    # By the number of visitors, which the waiting rows of each salt meet.
    salts = F.ceil(F.col("others") / SALT_ROWS).cast("int")
    waiting = suiting(waiting, visiting)
    counts = waiting.select("token", "cell", salts.alias("salts")).distinct()
    visiting = salted_join(visiting, counts, ["token", "cell"], "node", "inner").withColumn(
        "salt", _salt("node", F.col("salts"))
    )
    return visiting.drop("salts"), _salted(waiting, salts).drop("others")


def classes(
    docs: DataFrame,
    key: str = "doc_id",
    column: str = "text",
    least: float = SIMILARITY,
    heavy: float = HEAVY,
) -> DataFrame:
    """Every row's id with `class_id`, the smallest id of its class, and `kept`. Runs jobs.

    `heavy` is the share of the documents below which shingles weigh alike; with EXACT none do.
    """
    with small_batches(docs.sparkSession):
        return _classes(docs, key, column, least, heavy)


def _classes(docs: DataFrame, key: str, column: str, least: float, heavy: float) -> DataFrame:
    spark = docs.sparkSession
    if heavy == EXACT:
        total, sketched = exact_sketches(docs, key, column)
        counted = (total, np.empty(0, np.uint64), np.empty(0, np.int64))
        weighing = spark.sparkContext.broadcast((*counted, heavy))
    else:
        counted = frequent(docs, column, lambda: Shingler().shingles, heavy, HEAVY_BLOCK_BYTES, 2)
        weighing = spark.sparkContext.broadcast((*counted, heavy))
        sketched = sketches(docs, key, column, weighing)
    sketched = materialize(sketched, "sketches")
    release(spark)
    # Equal texts are one node, their smallest id; a hot text meets salted rows only.
    same = sketched.groupBy("mark").agg(F.min("id").alias("node"), F.count("id").alias("n"))
    same = materialize(same.filter("node IS NOT NULL"), "same-texts")
    nodes = (
        sketched.join(same.select(F.col("node").alias("id")).distinct(), "id", "left_semi")
        .select(F.col("id").alias("node"), "total", F.posexplode("bands").alias("band", "key"))
        .dropDuplicates(["node", "band", "key"])
    )
    sizes = (
        nodes.groupBy("band", "key")
        .agg(F.count(F.lit(1)).alias("near"), F.min(F.struct("node", "total")).alias("least"))
        .select(
            "band",
            "key",
            "near",
            F.col("least.node").alias("first"),
            F.col("least.total").alias("first_total"),
        )
    )
    shared = _salted(sizes.filter("near > 1"), F.lit(SALTS))
    members = materialize(
        nodes.select("*", _salt("node", F.lit(SALTS))).join(shared, ["band", "key", "salt"]),
        "buckets",
    )
    involved = materialize(members.select(F.col("node").alias("id")).distinct(), "involved")
    everything = docs.select(F.col(key).alias("id"), F.coalesce(column, F.lit("")).alias("text"))
    contents = likely(everything, "id", involved).join(involved, "id").dropDuplicates(["id"])
    if counts := _counts(sketched):
        # Rows that repeat an id may differ in text: the frequencies are those of the same text.
        mark = F.substring(F.sha2(F.col("text").cast("binary"), 256), 1, 32)
        beside = likely(sketched.select("id", "mark", *counts), "id", involved)
        contents = contents.withColumn("mark", mark).join(
            beside.dropDuplicates(["id", "mark"]), ["id", "mark"]
        )
    contents = materialize(contents, "candidates")
    # Weights bound the similarity: it is at most the lighter text's over the heavier one's.
    lighter, heavier = F.least("total", "first_total"), F.greatest("total", "first_total")
    pairs = (
        members.filter((F.col("node") != F.col("first")) & (lighter >= heavier * (least - FLOAT_ROOM)))
        .groupBy(F.col("node").alias("u"), F.col("first").alias("v"))
        .agg(F.max("near").alias("near"))
    )
    links = materialize(verified(pairs, contents, weighing, least), "links")
    labels = components(links)
    opened = _several(
        _labelled(members.select("node", "band", "key"), labels), ["band", "key"]
    ).select("node").distinct()
    opened = materialize(opened.withColumnRenamed("node", "id"), "open")
    if not opened.isEmpty():
        prefixes = materialize(
            _prefixes(
                contents.join(opened, "id"), sketched.join(opened, "id"), weighing, least
            ).withColumnRenamed("id", "node"),
            "prefixes",
        )
        for hubs_only in (True, False):
            placed = materialize(_several(_labelled(prefixes, labels), ["token"]), "open-prefixes")
            if placed.isEmpty():
                break
            more = _bounded_pairs(placed, least, hubs_only)
            links = links.union(materialize(verified(more, contents, weighing, least), "links"))
            labels = components(links)
    copies = _salted(same.filter("n > 1"), F.lit(SALTS)).select("mark", "salt", "node")
    rows = (
        sketched.select("id", "mark", _salt("id", F.lit(SALTS)))
        .join(copies, ["mark", "salt"], "left")
        .select("id", F.coalesce("node", "id").alias("node"))
    )
    class_id = F.when(F.col("id").isNotNull(), F.coalesce("label", "node"))
    return (
        salted_join(rows, labels, ["node"], "id")
        .select(F.col("id").alias(key), class_id.alias("class_id"))
        .withColumn("kept", F.coalesce(F.col(key) == F.col("class_id"), F.lit(True)))
    )


def keep_one(
    docs: DataFrame, key: str = "doc_id", column: str = "text", heavy: float = HEAVY
) -> DataFrame:
    """The rows of `docs` that stay, one id of each class, with all their columns. Runs jobs."""
    gone = classes(docs, key, column, heavy=heavy).filter("NOT kept")
    gone = gone.select(F.col(key).alias("__id"))
    whole = F.struct(*(docs[f"`{c}`"] for c in docs.columns)).alias("__row")
    return (
        docs.select(whole)
        .join(gone.distinct(), F.col(f"__row.`{key}`") == F.col("__id"), "left_anti")
        .select("__row.*")
    )
