"""Mapping the words of token arrays, in slices of bounded size."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

# Executors get this module's functions with the task, so the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SLICE_WORDS = 1 << 17


def slices(lists: pa.Array) -> Iterator[pa.Array]:
    """The rows of a batch in slices of about SLICE_WORDS words, one row at least."""
    offsets = lists.offsets.to_numpy()
    start = 0
    while start < len(lists):
        last = int(np.searchsorted(offsets, offsets[start] + SLICE_WORDS, "right")) - 1
        stop = max(start + 1, min(last, len(lists)))
        yield lists.slice(start, stop - start)
        start = stop


def map_words(batches: Iterable[pa.Array], change: Callable[[str], str]) -> Iterator[pa.Array]:
    """Change each distinct word of a slice once; repeats and order are Arrow index work.

    What a task makes beside the batch it was given follows a slice, not the rows of the batch.
    """
    changed = lru_cache(maxsize=1 << 16)(change)
    for batch in batches:
        for lists in slices(batch):
            words = lists.flatten().dictionary_encode()
            made = pa.array([changed(w) for w in words.dictionary.to_pylist()], pa.string())
            offsets = pc.subtract(lists.offsets, lists.offsets[0])
            yield pa.ListArray.from_arrays(offsets, made.take(words.indices))
