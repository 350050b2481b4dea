"""Deterministic sampling by key hash: the same row falls the same way on every run and layout."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The seed of the study, and the number of distinct 8-hex-digit prefixes.
SEED = 123
HASH_RANGE = 2**32


def hash_key(key: Column, seed: int | str = SEED) -> Column:
    return F.md5(F.concat_ws(":", key.cast("string"), F.lit(str(seed))))


def hash_fraction(key: Column, seed: int | str = SEED) -> Column:
    """Uniform number in [0, 1)."""
    prefix = F.substring(hash_key(key, seed), 1, 8)
    return F.conv(prefix, 16, 10).cast("long") / F.lit(float(HASH_RANGE))
