"""Looking up a per-key table from rows whose keys are heavily skewed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROWS_PER_TASK = 1_000_000
MAX_HOT_KEYS = 1_000_000


def keyed_lookup(
    rows: DataFrame,
    table: DataFrame,
    key: str | list[str],
    how: str = "inner",
    key_counts: DataFrame | None = None,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """`rows` joined to the one-row-per-key `table`, safe for keys of any frequency.

    `how` is "inner", "left", "left_semi" or "left_anti"; the last two take the keys of `table` as
    a list, in which a key may be repeated.

    A key is hot when it has more than `rows_per_task` rows, a number that a shuffle partition
    holds easily. The rows of a hot key are spread by a hash of the whole row over as many salts
    as keep each at that number, and its table row is repeated for each salt; all other keys have
    one salt. It is one equi join over one scan of `rows`, which Spark broadcasts where the table
    is small. The hot keys are broadcast: at most MAX_HOT_KEYS, because beyond 10**12 rows a
    millionth of all rows takes the place of `rows_per_task`. `key_counts(key, n_rows)` may be
    passed when the caller has it anyway. Null keys match nothing: such rows stay in "left" and
    "left_anti" joins, and a null in a list excludes nothing.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join type {how!r}")
    keys = [key] if isinstance(key, str) else key
    if key_counts is None:
        key_counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
    share = key_counts.agg(F.sum("n_rows")).scalar() / MAX_HOT_KEYS
    most = F.greatest(F.lit(float(rows_per_task)), F.coalesce(share, F.lit(0.0)))
    hot = key_counts.filter(F.col("n_rows") > most).select(
        *keys, F.ceil(F.col("n_rows") / most).cast("int").alias("_salts")
    )
    salts = F.coalesce("_salts", F.lit(1))
    spread = rows.join(F.broadcast(hot), keys, "left").select(
        *rows.columns, F.pmod(F.xxhash64(*rows.columns), salts).cast("int").alias("_salt")
    )
    repeated = table.join(F.broadcast(hot), keys, "left").select(
        *table.columns, F.explode(F.sequence(F.lit(0), salts - 1)).alias("_salt")
    )
    return spread.join(repeated, [*keys, "_salt"], how).drop("_salt")
