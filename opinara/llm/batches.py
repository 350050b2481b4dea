"""Helpers of the Arrow operators: blocks of bounded size, and texts out of them."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

BLOCK_BYTES = 8 << 20
#: Of what Spark hands to Python at once.
BATCHES = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(BLOCK_BYTES),
}


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Jobs that run inside get batches of a few megabytes, where an executor's heap, its Arrow
    buffers and its Python workers would hold several batches of 10,000 long rows."""
    before = {name: spark.conf.get(name, None) for name in BATCHES}
    for name, value in BATCHES.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def blocks(
    batches: Iterable[pa.RecordBatch], column: str, limit: int = BLOCK_BYTES
) -> Iterator[pa.RecordBatch]:
    """The batches in slices whose `column` holds about `limit` bytes, one row at least.

    What a task holds at once follows the longest text, not the number of rows of a batch.
    """
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0)
        ends = np.cumsum(np.asarray(sizes, dtype=np.int64) + 16)
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def texts(batch: pa.RecordBatch, column: str) -> list[str]:
    """The texts of a batch; null is the empty text."""
    return pc.fill_null(batch.column(column), "").to_pylist()


def map_blocks(
    df: DataFrame, column: str, build: Callable[[], Callable], schema: str, limit: int = BLOCK_BYTES
) -> DataFrame:
    """Apply to each block of `df` the function that `build` makes once per task."""

    def run(batches):
        apply = build()
        for block in blocks(batches, column, limit):
            yield apply(block)

    return df.mapInArrow(run, schema)


def task_number(spark: SparkSession, amount: int, share: int) -> int:
    """Tasks that get about `share` of `amount` each, and at least the session's own number."""
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(least, -(-amount // share))


def ragged(values: np.ndarray, lengths: np.ndarray, value_type: pa.DataType) -> pa.Array:
    """A list column of consecutive runs of `values`."""
    offsets = np.zeros(len(lengths) + 1, dtype=np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, type=value_type))
