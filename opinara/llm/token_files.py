"""Token id files compressed by Re-Pair grammars, with random access to documents.

Documents are encoded by the `tokenizers` library (each distinct word of a task once), closed by
an end id, and written in ascending order of their ids. A task packs its documents into shards of
about SHARD_TOKENS ids. In a shard, frequent pairs of neighbouring symbols are replaced by new
symbols, round by round: every round counts all pairs, gives the most frequent ones a rule each,
and replaces their occurrences from the left, until no pair occurs LEAST_COUNT times. Pairs never reach over the end of a document, so a
document is a range of symbols. A shard stores its rules with the lengths of their expansions;
any range of a document's ids is found by these lengths and expanded alone.

A shard is one row of the written table, its bytes are the file. Its row states the ids before it
in the part that its task wrote; positions in the whole corpus add the sizes of the parts before,
whose number is that of the tasks and is checked.

Null texts are empty: the end id alone. Rows that repeat an id follow each other by a hash of
their text, null ids come first. Extra columns are ignored. An empty table makes no shards and an
empty result. A text of any length stays in one shard.
"""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinara.llm.batches import blocks, ragged, texts
from opinara.llm.bpe import Encoder
from opinara.llm.pieces import byte_characters
from opinara.session import materialize

END_ID = 1
SHARD_TOKENS = 1 << 20
RULES_PER_ROUND = 2048
LEAST_COUNT = 16
MAX_PARTS = 100_000
BLOCK_BYTES = 1 << 20
READ_DOCUMENTS = 256
MAGIC = b"RPGR"
SECTIONS = ("left", "right", "expansion", "symbols", "ids", "known", "ends", "sizes")


class LibraryEncoder(Encoder):
    """Texts to ids, words encoded by the model of the `tokenizers` library."""

    def __init__(self, path: str):
        super().__init__(path)
        self.model = self.splitter.tokenizer.model
        self.stand_in = byte_characters()
        self.splitter.settings = {}

    def encode_words(self, words: Sequence[str]) -> list[list[int]]:
        tokenize, table = self.model.tokenize, self.stand_in
        spelled = (
            w
            if w.isascii() and w.isprintable()
            else w.encode().decode("latin-1").translate(table)
            for w in words
        )
        return [[token.id for token in tokenize(w)] for w in spelled]


@lru_cache(maxsize=1)
def encoder_of(path: str) -> LibraryEncoder:
    """One encoder for all tasks of a Python worker, so that common words stay known."""
    return LibraryEncoder(path)


@dataclass
class Shard:
    """Documents `ids` (where `known`), their symbols up to `ends`, their numbers of tokens."""

    first_rule: int
    left: np.ndarray
    right: np.ndarray
    expansion: np.ndarray
    symbols: np.ndarray
    ids: np.ndarray
    known: np.ndarray
    ends: np.ndarray
    sizes: np.ndarray

    def to_bytes(self) -> bytes:
        arrays = [np.ascontiguousarray(getattr(self, name)) for name in SECTIONS]
        head = {
            "first_rule": self.first_rule,
            "sections": [(n, a.dtype.str, len(a)) for n, a in zip(SECTIONS, arrays)],
        }
        text = json.dumps(head).encode()
        return b"".join([MAGIC, struct.pack("<I", len(text)), text, *(a.tobytes() for a in arrays)])

    @classmethod
    def from_bytes(cls, data: bytes | pa.Buffer) -> Shard:
        data = memoryview(data)
        if bytes(data[:4]) != MAGIC:
            raise ValueError("not a shard")
        (size,) = struct.unpack_from("<I", data, 4)
        head = json.loads(bytes(data[8 : 8 + size]))
        at, arrays = 8 + size, {}
        for name, kind, count in head["sections"]:
            arrays[name] = np.frombuffer(data, dtype=kind, count=count, offset=at)
            at += arrays[name].nbytes
        return cls(head["first_rule"], **arrays)

    @cached_property
    def dictionary(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The expansions of all symbols one after another, where each begins, and its length.

        Each turn replaces every rule among the expansions by its two sides.
        """
        ids = self.first_rule + np.arange(len(self.left))
        while (rule := ids >= self.first_rule).any():
            width = 1 + rule
            at = np.cumsum(width) - width
            wider = np.empty(int(width.sum()), dtype=np.int64)
            number = ids[rule] - self.first_rule
            wider[at[~rule]] = ids[~rule]
            wider[at[rule]] = self.left[number]
            wider[at[rule] + 1] = self.right[number]
            ids = wider
        lengths = np.concatenate([np.ones(self.first_rule, dtype=np.int64), self.expansion])
        flat = np.concatenate([np.arange(self.first_rule), ids]).astype(np.uint32)
        return flat, np.cumsum(lengths) - lengths, lengths

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        """The ids of symbols."""
        flat, begins, lengths = self.dictionary
        width = lengths[symbols]
        ends = np.cumsum(width)
        total = int(ends[-1]) if len(ends) else 0
        return flat[np.arange(total) + np.repeat(begins[symbols] - (ends - width), width)]

    def document(self, place: int, start: int = 0, stop: int | None = None) -> np.ndarray:
        """The ids `start` to `stop` of the document at a place, from the symbols they lie in."""
        symbols = self.symbols[self.ends[place - 1] if place else 0 : self.ends[place]]
        stop = int(self.sizes[place]) if stop is None else min(stop, int(self.sizes[place]))
        if start >= stop:
            return np.empty(0, dtype=np.uint32)
        rule = symbols >= self.first_rule
        width = np.ones(len(symbols), dtype=np.int64)
        width[rule] = self.expansion[symbols[rule].astype(np.int64) - self.first_rule]
        reached = np.cumsum(width)
        a = int(np.searchsorted(reached, start, "right"))
        b = int(np.searchsorted(reached, stop, "left")) + 1
        begin = int(reached[a] - width[a])
        return self.expand(symbols[a:b])[start - begin : stop - begin]


def compress(ids: np.ndarray, sizes: np.ndarray, vocabulary: int) -> tuple[np.ndarray, ...]:
    """Rules (left, right, expansion length), symbols, and where each document's symbols end."""
    narrow = vocabulary + RULES_PER_ROUND <= 1 << 16
    bits, kind = (16, np.uint32) if narrow else (32, np.uint64)
    symbols = ids.astype(kind)
    closing = np.zeros(len(ids), dtype=bool)
    closing[np.cumsum(sizes[sizes > 0]) - 1] = True
    rules: list[tuple[np.ndarray, np.ndarray]] = []
    made = vocabulary
    while True:
        if narrow and made + RULES_PER_ROUND > 1 << 16:
            narrow, bits, kind = False, 32, np.uint64
            symbols = symbols.astype(kind)
        pair = (symbols[:-1] << kind(bits)) | symbols[1:]
        inner = ~closing[:-1]
        ordered = np.sort(pair[inner])
        if not len(ordered):
            break
        first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
        counts = np.diff(np.concatenate([first, [len(ordered)]]))
        often = np.flatnonzero(counts >= LEAST_COUNT)
        if not len(often):
            break
        often = often[np.argsort(-counts[often], kind="stable")[:RULES_PER_ROUND]]
        chosen = np.sort(ordered[first[often]])
        low = kind((1 << bits) - 1)
        first_side, second_side = (x.astype(np.int64) for x in (chosen >> kind(bits), chosen & low))
        starts, follows = np.zeros(made, dtype=bool), np.zeros(made, dtype=bool)
        starts[first_side] = True
        follows[second_side] = True
        # A rule's number by its two sides; both are among the few that any rule has.
        row, column = np.cumsum(starts) - 1, np.cumsum(follows) - 1
        number = np.full((int(starts.sum()), int(follows.sum())), -1, dtype=np.int32)
        number[row[first_side], column[second_side]] = np.arange(len(chosen))
        at = np.flatnonzero(inner & starts[symbols[:-1]] & follows[symbols[1:]])
        rule = number[row[symbols[at]], column[symbols[at + 1]]]
        hit = rule >= 0
        at, rule = at[hit], rule[hit]
        # Of neighbouring occurrences every other one is replaced, from the left.
        run = np.concatenate([[True], at[1:] != at[:-1] + 1])
        order = np.arange(len(at))
        even = (order - np.maximum.accumulate(np.where(run, order, 0))) % 2 == 0
        at, rule = at[even], rule[even]
        symbols[at] = (made + rule).astype(kind)
        closing[at] = closing[at + 1]
        keep = np.ones(len(symbols), dtype=bool)
        keep[at + 1] = False
        symbols, closing = symbols[keep], closing[keep]
        rules.append((first_side, second_side))
        made += len(chosen)
    none = np.empty(0, dtype=np.int64)
    left, right = (np.concatenate([none, *(r[side] for r in rules)]) for side in (0, 1))
    length = np.ones(made, dtype=np.uint32)
    for i, (a, b) in enumerate(zip(left.tolist(), right.tolist())):
        length[vocabulary + i] = length[a] + length[b]
    ends = np.zeros(len(sizes), dtype=np.int64)
    ends[sizes > 0] = np.flatnonzero(closing) + 1
    store = np.uint16 if made <= 1 << 16 else np.uint32
    return (
        left.astype(store),
        right.astype(store),
        length[vocabulary:],
        symbols.astype(store),
        np.maximum.accumulate(ends),
    )


def write(docs: DataFrame, path: str, key: str = "doc_id", column: str = "text") -> DataFrame:
    """Write the documents to shards in the shared folder. Runs jobs.

    Rows are `part, shard, before, tokens, content`.
    """
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(column).alias("text"))
    order = [F.col("id"), F.xxhash64("text")]
    ordered = rows.repartitionByRange(tasks, *order).sortWithinPartitions(*order)

    def shards(batches):
        encoder, part, number = encoder_of(path), TaskContext.get().partitionId(), 0
        size = encoder.splitter.tokenizer.get_vocab_size(with_added_tokens=True)
        held: list[tuple[pa.Array, np.ndarray, np.ndarray]] = []
        tokens = before = 0
        for block in blocks(batches, "text", BLOCK_BYTES):
            ids, lengths = encoder.encode(texts(block, "text"))
            closed = np.full(len(ids) + len(lengths), END_ID, dtype=np.uint32)
            ends = np.cumsum(lengths + 1) - 1
            inner = np.ones(len(closed), dtype=bool)
            inner[ends] = False
            closed[inner] = ids
            held.append((block.column("id"), closed, lengths + 1))
            tokens += len(closed)
            if tokens >= SHARD_TOKENS:
                yield _shard_row(part, number, before, held, size)
                held, tokens, number, before = [], 0, number + 1, before + tokens
        if held:
            yield _shard_row(part, number, before, held, size)

    schema = "part int, shard int, before long, tokens long, content binary"
    return materialize(ordered.mapInArrow(shards, schema), "token-shards")


def _shard_row(part: int, number: int, before: int, held: list, vocabulary: int) -> pa.RecordBatch:
    names = pa.chunked_array([h[0] for h in held]).combine_chunks()
    ids, sizes = (np.concatenate([h[i] for h in held]) for i in (1, 2))
    left, right, expansion, symbols, ends = compress(ids, sizes, vocabulary)
    shard = Shard(
        vocabulary,
        left,
        right,
        expansion,
        symbols,
        names.fill_null(0).to_numpy(zero_copy_only=False),
        names.is_valid().to_numpy(zero_copy_only=False),
        ends.astype(np.uint32),
        sizes.astype(np.uint32),
    )
    return pa.RecordBatch.from_arrays(
        [
            pa.array([part], pa.int32()),
            pa.array([number], pa.int32()),
            pa.array([before], pa.int64()),
            pa.array([len(ids)], pa.int64()),
            pa.array([shard.to_bytes()], pa.binary()),
        ],
        ["part", "shard", "before", "tokens", "content"],
    )


def placed(shards: DataFrame) -> DataFrame:
    """Shards with `start`, the number of ids of all shards before them."""
    sums = shards.groupBy("part").agg(F.sum("tokens").alias("n")).limit(MAX_PARTS + 1).collect()
    if len(sums) > MAX_PARTS:
        raise ValueError(f"over {MAX_PARTS} parts")
    starts, total = [], 0
    for row in sorted(sums, key=lambda r: r["part"]):
        starts.append((row["part"], total))
        total += row["n"]
    parts = shards.sparkSession.createDataFrame(starts, "part int, part_start long")
    return (
        shards.join(F.broadcast(parts), "part")
        .withColumn("start", F.col("part_start") + F.col("before"))
        .drop("part_start", "before")
    )


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """`id, start, n_tokens, ids` of the documents of shards, some at a time."""
    for batch in batches:
        for content, start in zip(batch.column("content"), batch.column("start").to_pylist()):
            shard = Shard.from_bytes(content.as_buffer())
            sizes = shard.sizes.astype(np.int64)
            starts = start + np.cumsum(sizes) - sizes
            for a in range(0, len(sizes), READ_DOCUMENTS):
                b = min(a + READ_DOCUMENTS, len(sizes))
                ids = shard.expand(shard.symbols[shard.ends[a - 1] if a else 0 : shard.ends[b - 1]])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(shard.ids[a:b], mask=~shard.known[a:b]),
                        pa.array(starts[a:b]),
                        pa.array(sizes[a:b]),
                        ragged(ids.view(np.int32), sizes[a:b], pa.int32()),
                    ],
                    ["id", "start", "n_tokens", "ids"],
                )


def read(shards: DataFrame, key: str = "doc_id") -> DataFrame:
    """Per document of the files `start, n_tokens, ids`; shards as `placed` gives them."""
    schema = "id long, start long, n_tokens long, ids array<int>"
    found = shards.select("content", "start").mapInArrow(_documents, schema)
    return found.withColumnRenamed("id", key)


def checksums(shards: DataFrame, key: str = "doc_id") -> DataFrame:
    """The same with `ids_crc32`, the CRC of the ids as little-endian 32-bit numbers, for ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _documents(batches):
            flat = batch.column("ids").flatten().to_numpy(zero_copy_only=False).astype("<u4")
            ends = np.cumsum(batch.column("n_tokens").to_numpy())
            sums = [zlib.crc32(flat[a:b]) for a, b in zip([0, *ends[:-1]], ends)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(sums, pa.int64())],
                ["id", "start", "n_tokens", "ids_crc32"],
            )

    schema = "id long, start long, n_tokens long, ids_crc32 long"
    found = shards.select("content", "start").mapInArrow(run, schema)
    return found.withColumnRenamed("id", key)
