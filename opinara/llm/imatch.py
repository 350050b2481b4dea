"""I-Match fingerprints over several randomised lexicons.

The lexicon holds the terms whose inverse document frequency over all documents lies in a band:
terms in at least LEAST_SHARE and at most MOST_SHARE of them. Its size is at most the mean number
of distinct terms of a document over LEAST_SHARE, however many documents there are. Each of
LEXICONS random subsets of it gives one number of 32 bits: a hash of the document's distinct terms
that the subset keeps, the same in any order. A term draws its subsets by hashes of its own: one
always, so that no term is without, and another with probability EXTRA. So subsets overlap, and each
keeps about (1 + EXTRA) / LEXICONS of the lexicon. The fingerprint is the list of these numbers in
hex, 0 for a subset that keeps none. Documents without a term in the band are fingerprinted by all
their terms; those without words have zeros only.

The likeness of two fingerprints is the share of equal numbers among the subsets that keep a term
of either document, and 1 if no subset does. Small subsets make it fall with the share of
different terms instead of to zero at the first.

Equal texts have equal fingerprints. Null texts are empty. Extra columns are ignored. An empty
table has an empty result. Rows that repeat an id are fingerprinted row by row; in the order of
documents they follow each other by a hash of their texts, and null ids come first.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinara.llm.batches import blocks, map_blocks, task_number, texts
from opinara.llm.frequent import frequent
from opinara.llm.words import ODD, WordHasher, mixed

LEAST_SHARE, MOST_SHARE = 0.002, 0.2
LEXICONS = 128
DIGITS = 8
EXTRA = 0.125
BLOCK_BYTES = 1 << 20
#: Bytes of text that one task sorts and compares.
RUN_BYTES = 256 << 20
EDITED = (
    ("id", "long"),
    ("n_chars", "long"),
    ("edited_sha256", "string"),
    ("fingerprint", "string"),
    ("edited_fingerprint", "string"),
    ("near_edited", "double"),
    ("near_next", "double"),
)


def lexicon(docs: DataFrame, column: str = "text") -> np.ndarray:
    """Sorted hashes of the terms whose document frequency is in the band. Runs jobs."""
    total, terms, counts = frequent(docs, column, lambda: WordHasher().words, LEAST_SHARE, 8 << 20)
    return terms[counts <= MOST_SHARE * total]


class Fingerprinter:
    """Fingerprints as rows of LEXICONS numbers."""

    def __init__(self, terms: np.ndarray):
        self.hasher, self.terms = WordHasher(), terms

    def numbers(self, texts: Sequence[str]) -> np.ndarray:
        found, counts = self.hasher.words(texts)
        owner = np.repeat(np.arange(len(counts)), counts)
        if len(self.terms):
            at = np.minimum(np.searchsorted(self.terms, found), len(self.terms) - 1)
            kept = self.terms[at] == found
        else:
            kept = np.zeros(len(found), dtype=bool)
        none = np.bincount(owner[kept], minlength=len(counts)) == 0
        kept |= none[owner]
        found, owner = found[kept], owner[kept]
        order = np.lexsort((found, owner))
        found, owner = found[order], owner[order]
        fresh = np.ones(len(found), dtype=bool)
        fresh[1:] = (found[1:] != found[:-1]) | (owner[1:] != owner[:-1])
        found, owner = found[fresh], owner[fresh]
        sums = np.zeros(len(counts) * LEXICONS, dtype=np.uint64)
        first = mixed(found + ODD)
        second = mixed(first + ODD)
        also = (second >> np.uint64(40)) < np.uint64(int(EXTRA * (1 << 24)))
        for code, whose in ((first, owner), (second[also], owner[also])):
            subset = (code % np.uint64(LEXICONS)).astype(np.int64)
            np.add.at(sums, whose * LEXICONS + subset, mixed(code))
        number = mixed(sums) >> np.uint64(64 - 4 * DIGITS)
        number = np.where(sums == 0, 0, np.maximum(number, 1))
        return number.reshape(len(counts), LEXICONS)


def as_text(numbers: np.ndarray) -> list[str]:
    return [row.tobytes().hex() for row in numbers.astype(">u4")]


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Likeness of the fingerprints in the rows of two tables."""
    either = (a != 0) | (b != 0)
    equal = ((a == b) & either).sum(axis=1)
    return np.where(either.any(axis=1), equal / np.maximum(either.sum(axis=1), 1), 1.0)


def fingerprints(
    docs: DataFrame, terms: np.ndarray, key: str = "doc_id", column: str = "text"
) -> DataFrame:
    """Every row's key and `fingerprint`."""
    kind = docs.schema[key].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(terms)

    def build():
        printer = Fingerprinter(shared.value)

        def apply(block):
            found = as_text(printer.numbers(texts(block, column)))
            return pa.RecordBatch.from_arrays(
                [block.column(key), pa.array(found, pa.string())], [key, "fingerprint"]
            )

        return apply

    schema = f"`{key}` {kind}, fingerprint string"
    return map_blocks(docs.select(key, column), column, build, schema, BLOCK_BYTES)


def in_order(docs: DataFrame, key: str = "doc_id", column: str = "text") -> DataFrame:
    """Rows `run, last, id, mark, text` so sorted that every document is followed by the next one.

    Documents are ordered by id and `mark`, a hash of the text. A range partitioning of these keys
    alone, which samples them, cuts the order into runs of about equal numbers of rows, one a task;
    a run ends with a copy (`last`) of the document that follows it, after the last run the first
    document. Only the first key of each run comes to the driver. The texts are shuffled once, in
    runs of about RUN_BYTES or as many as the session has shuffle partitions.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col(key).cast("long").alias("id"), F.coalesce(column, F.lit("")).alias("text")
    ).withColumn("mark", F.xxhash64("text"))
    size = docs.agg(F.sum(F.octet_length(column))).first()[0] or 0
    tasks = task_number(spark, size, RUN_BYTES)
    keys = rows.select(F.col("id").isNotNull().alias("known"), "id", "mark")
    found = (
        keys.repartitionByRange(tasks, "known", "id", "mark")
        .withColumn("part", F.spark_partition_id())
        .groupBy("part")
        .agg(F.min(F.struct("known", "id", "mark")).alias("first"))
        .collect()
    )
    heads = sorted((r["first"]["known"], r["first"]["id"] or 0, r["first"]["mark"]) for r in found)
    shared = spark.sparkContext.broadcast(heads)

    def dealt(batches):
        heads = shared.value
        unknown = sum(not known for known, _, _ in heads)
        ids_of = np.array([i for _, i, _ in heads[unknown:]], dtype=np.int64)
        for block in blocks(batches, "text", BLOCK_BYTES):
            known = block.column("id").is_valid().to_numpy(zero_copy_only=False)
            ids = block.column("id").fill_null(0).to_numpy(zero_copy_only=False)
            marks = block.column("mark").to_numpy(zero_copy_only=False)
            runs = unknown + np.searchsorted(ids_of, ids, "right") - 1
            # Marks matter only where a run begins at the same id.
            same = ~known | (np.searchsorted(ids_of, ids, "left") <= runs - unknown)
            copied = []
            for i in np.flatnonzero(same).tolist():
                place = (bool(known[i]), int(ids[i]), int(marks[i]))
                runs[i] = bisect_right(heads, place) - 1
                if heads[runs[i]] == place:
                    copied.append(i)
            copied = np.array(copied, dtype=np.int64)
            chosen = pa.array(np.concatenate([np.arange(len(ids)), copied]))
            run = np.concatenate([runs, (runs[copied] - 1) % len(heads)])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(run.astype(np.int32)),
                    pa.array(np.arange(len(run)) >= len(ids)),
                    *(block.column(c).take(chosen) for c in ("id", "mark", "text")),
                ],
                ["run", "last", "id", "mark", "text"],
            )

    schema = "run int, last boolean, id long, mark long, text string"
    return (
        rows.mapInArrow(dealt, schema)
        .repartitionById(tasks, "run")
        .sortWithinPartitions("run", "last", "id", "mark", "text")
    )


def edited_fingerprints(
    docs: DataFrame, terms: np.ndarray, key: str = "doc_id", column: str = "text"
) -> DataFrame:
    """Fingerprints of every text and of its edited text, and two likenesses.

    The edited text ends in the first half of the next document: the last floor(n / 2) of n code
    points give way to as many of that document's first, or all it has.
    """
    shared = docs.sparkSession.sparkContext.broadcast(terms)

    def run(batches):
        printer = Fingerprinter(shared.value)
        for rows in _runs(batches):
            yield _compared(printer, rows)

    schema = ", ".join(f"{name} {kind}" for name, kind in EDITED)
    found = in_order(docs, key, column).mapInArrow(run, schema)
    return found.withColumnRenamed("id", key)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """Rows of one run in blocks; each block but the run's last ends with the next one's first."""
    rows: list[tuple] = []
    size = 0
    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("run", "last", "id", "text"))
        for row in zip(*columns):
            if rows and row[0] != rows[0][0]:
                yield rows
                rows, size = [], 0
            if row[1] and rows and rows[-1][1]:
                continue  # a row that repeats the id of a run's first document
            rows.append(row)
            size += len(row[3])
            if size > BLOCK_BYTES and not row[1] and len(rows) > 1:
                yield rows
                rows, size = [row], len(row[3])
    if rows:
        yield rows


def _compared(printer: Fingerprinter, rows: list[tuple]) -> pa.RecordBatch:
    own = [text for _, _, _, text in rows]
    edited = [a[: len(a) - len(a) // 2] + b[: len(a) // 2] for a, b in zip(own, own[1:])]
    numbers = printer.numbers(own)
    changed = printer.numbers(edited) if edited else numbers[:0]
    n = len(edited)
    digests = [hashlib.sha256(e.encode("utf-8", "surrogatepass")).hexdigest() for e in edited]
    return pa.RecordBatch.from_arrays(
        [
            pa.array([r[2] for r in rows[:n]], pa.int64()),
            pa.array([len(t) for t in own[:n]], pa.int64()),
            pa.array(digests, pa.string()),
            pa.array(as_text(numbers[:n]), pa.string()),
            pa.array(as_text(changed), pa.string()),
            pa.array(likeness(numbers[:n], changed)),
            pa.array(likeness(numbers[:n], numbers[1:])),
        ],
        [name for name, _ in EDITED],
    )
