"""Joins of many small rows with a table of unique keys, with no hot key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SALTS = 16


def salted_join(
    rows: DataFrame, table: DataFrame, keys: Sequence[str], by: str, how: str = "left"
) -> DataFrame:
    """`rows` joined with `table` on `keys`, rows of one key spread by a hash of `by`.

    The rows of `table` are repeated for each salt, so it should hold few or small ones.
    """
    salt = F.pmod(F.xxhash64(by), F.lit(SALTS)).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    return (
        rows.withColumn("__salt", salt)
        .join(table.withColumn("__salt", every), [*keys, "__salt"], how)
        .drop("__salt")
    )
