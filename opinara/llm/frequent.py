"""Exact document frequencies of the frequent items of a corpus, in two bounded passes.

An item of at least a `share` of all documents has half of its documents, or more, in blocks
where it reaches half the share: elsewhere it has less than half the share of them all. So blocks
report only such items, and an item whose reports reach the wanted number less half the share is a
candidate; there are at most 2 / share times the mean number of items of a document. The second
pass counts the candidates exactly. The smaller the share, the larger the blocks must be for few
reports: a block of fewer than 2 / share documents reports all its items. A block is hashed in
small parts, of which only the distinct items of each document stay.

`repeated` counts the items of every frequency, by a shuffle of one row for each item of a document.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from opinara.llm.batches import blocks, map_blocks, texts

BLOCK_BYTES = 4 << 20
HASHED_BYTES = 1 << 19
#: Of texts: hashes of all their items, and the number of each text.
Items = Callable[[Sequence[str]], tuple[np.ndarray, np.ndarray]]


def document_counts(items: Items, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct items of texts and the number of the texts that hold each."""
    return np.unique(document_items(items, texts)[0], return_counts=True)


def document_items(items: Items, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct items of each text and the places of their texts, in the order of the items."""
    found, numbers = items(texts)
    owner = np.repeat(np.arange(len(numbers)), numbers)
    order = np.argsort(found, kind="stable")
    found, owner = found[order], owner[order]
    fresh = np.ones(len(found), dtype=bool)
    fresh[1:] = (found[1:] != found[:-1]) | (owner[1:] != owner[:-1])
    return found[fresh], owner[fresh]


def block_counts(items: Items, block: pa.RecordBatch, column: str) -> tuple[np.ndarray, np.ndarray]:
    """The same of a block of rows, hashed in parts."""
    parts = (document_counts(items, texts(p, column)) for p in blocks([block], column, HASHED_BYTES))
    found = np.concatenate([np.repeat(*p) for p in parts])
    found.sort()
    starts = np.flatnonzero(np.append(True, found[1:] != found[:-1])[: len(found)])
    return found[starts], np.diff(np.append(starts, len(found)))


def frequent(
    docs: DataFrame,
    column: str,
    items: Callable[[], Items],
    share: float,
    block_bytes: int = BLOCK_BYTES,
    least: int = 1,
) -> tuple[int, np.ndarray, np.ndarray]:
    """Number of rows, sorted items of at least `share` of them, and `least` rows, and their
    frequencies.

    `items` makes the function that finds a text's items. Null texts count as empty ones.
    """
    total = docs.count()

    def reports():
        find = items()

        def apply(block):
            found, counts = block_counts(find, block, column)
            often = counts >= share / 2 * block.num_rows
            return _rows(found[often], counts[often])

        return apply

    wanted_rows = max(share * total, least)
    candidates, _ = _summed(docs, column, reports, wanted_rows - share / 2 * total, block_bytes)
    if not len(candidates):
        return total, candidates, np.empty(0, dtype=np.int64)
    wanted = docs.sparkSession.sparkContext.broadcast(candidates)

    def exact():
        find = items()

        def apply(block):
            found, counts = block_counts(find, block, column)
            known = np.isin(found, wanted.value, assume_unique=True)
            return _rows(found[known], counts[known])

        return apply

    return total, *_summed(docs, column, exact, wanted_rows, block_bytes)


def repeated(docs: DataFrame, column: str, items: Callable[[], Items]) -> DataFrame:
    """`block, item, n`: the items that several rows of `docs` hold, with the number of these rows,
    for every block that holds the item, once or more often.

    `docs` has the number of each row's `block`. What a task holds is a share of the items; the rows
    of an item that is everywhere are spilled, not held.
    """

    def build():
        find = items()

        def apply(part):
            found, owner = document_items(find, texts(part, column))
            # Text by text, so that runs of equal blocks are compressed.
            order = np.argsort(owner, kind="stable")
            found, owner = found[order], owner[order]
            block = part.column("block").take(pa.array(owner))
            return pa.RecordBatch.from_arrays([block, pa.array(found.view(np.int64))], ["block", "item"])

        return apply

    held = map_blocks(
        docs.select("block", column), column, build, "block int, item long", limit=HASHED_BYTES
    )
    number = F.count(F.lit(1)).over(Window.partitionBy("item"))
    return held.withColumn("n", number).filter("n > 1")


def _rows(found: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(found.view(np.int64)), pa.array(counts.astype(np.int64))], ["item", "n"]
    )


def _summed(
    docs: DataFrame, column: str, build, least: float, block_bytes: int
) -> tuple[np.ndarray, np.ndarray]:
    table = (
        map_blocks(docs.select(column), column, build, "item long, n long", limit=block_bytes)
        .groupBy("item")
        .agg(F.sum("n").alias("n"))
        .filter(F.col("n") >= least)
        .toArrow()
    )
    found = table["item"].to_numpy().view(np.uint64)
    order = np.argsort(found)
    return found[order], table["n"].to_numpy()[order]
