"""Exact k smallest rows of many groups at once, without sorting the groups.

Keys are strings of hexadecimal digits, as hashes are. Counting the keys of every group by their
first digits shows under which digits the last wanted row lies; then only these rows are counted by
some more digits, and so on, until few rows are left under the digits of a group. Each round is one
aggregate with map-side combining, at most `16 ** DIGITS` counts a group, and no row is moved. What
a group keeps are the rows below its digits and, of those that begin with them, the smallest ones,
which a window over these few rows finds. Where one key alone has more rows than that (copies of
one review), they are ranked by a range sort instead, which any number of rows survives.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opinara.operators.joins import keyed_lookup
from opinara.operators.selection import rank_in_groups
from opinara.session import materialize

DIGITS = 3
#: Rows under the digits of a group that one task ranks.
FEW = 100_000
#: Groups whose digits are broadcast, at about a hundred bytes each.
MAX_BROADCAST = 200_000


def _by_group(rows: DataFrame, table: DataFrame, group: str) -> DataFrame:
    """`rows` with the written `table` of their groups; rows of other groups go."""
    if table.count() <= MAX_BROADCAST:
        return rows.join(F.broadcast(table), group)
    return keyed_lookup(rows, table, group)


def _begins(key: str) -> Column:
    return F.substring(F.col(key), F.lit(1), F.length("_digits"))


def cut_offs(
    rows: DataFrame, group: str, key: str, wanted: DataFrame, width: int, few: int = FEW
) -> DataFrame:
    """For every `group` of `wanted(group, _wanted)`: `_digits`, `_wanted` and `_n`.

    All rows whose keys are below `_digits` are wanted, and `_wanted` of the `_n` rows whose keys
    begin with them. Groups that want all their rows, or none, have no digits. Keys have `width`
    digits. Runs a job a round.
    """
    sizes = rows.groupBy(group).agg(F.count(F.lit(1)).alias("_n"))
    state = materialize(
        wanted.join(sizes, group).select(
            group,
            F.lit("").alias("_digits"),
            F.least(F.col("_wanted"), F.col("_n")).cast("long").alias("_wanted"),
            "_n",
        ),
        "cut-offs",
    )
    done = (F.col("_wanted") == F.col("_n")) | (F.col("_wanted") <= 0) | (F.col("_n") <= few)
    done |= F.length("_digits") >= width
    while True:
        undecided = state.filter(~done)
        if undecided.isEmpty():
            return state
        undecided = materialize(undecided, "undecided")
        inside = _by_group(rows.select(group, key), undecided, group).filter(
            _begins(key) == F.col("_digits")
        )
        more = F.substring(F.col(key), F.lit(1), F.length("_digits") + DIGITS)
        counts = inside.groupBy(group, "_wanted", more.alias("_more")).agg(
            F.count(F.lit(1)).alias("_n")
        )
        upto = F.sum("_n").over(Window.partitionBy(group).orderBy("_more"))
        chosen = (
            counts.withColumn("_below", upto - F.col("_n"))
            .filter((F.col("_below") < F.col("_wanted")) & (F.col("_wanted") <= F.col("_below") + F.col("_n")))
            .select(
                group,
                F.col("_more").alias("_digits"),
                (F.col("_wanted") - F.col("_below")).alias("_wanted"),
                "_n",
            )
        )
        state = materialize(state.filter(done).unionByName(chosen), "cut-offs")


def smallest_per_group(
    rows: DataFrame,
    group: str,
    key: Column,
    wanted: DataFrame,
    ties: list[Column],
    width: int = 32,
    few: int = FEW,
) -> DataFrame:
    """Of each group the rows with the smallest keys, exactly as many as `wanted(group, _wanted)`
    says, or all if there are fewer; equal keys in the order of `ties`. Runs jobs.

    `key` has `width` hexadecimal digits and `ties` must tell rows apart, but for rows equal in
    all columns. Rows whose group is null or not wanted go.
    """
    keyed = rows.withColumn("_key", key)
    cuts = cut_offs(keyed, group, "_key", wanted, width, few)
    at = _by_group(keyed, cuts, group)
    whole = F.col("_wanted") == F.col("_n")
    below = at.filter((_begins("_key") < F.col("_digits")) | (whole & (_begins("_key") == F.col("_digits"))))
    border = at.filter(~whole & (F.col("_wanted") > 0) & (_begins("_key") == F.col("_digits")))
    crowded = cuts.filter(~whole & (F.col("_wanted") > 0)).agg(F.max("_n")).first()[0] or 0
    ranked = rank_in_groups(
        border, [group], [F.col("_key").asc(), *ties], bounded_groups=crowded <= few
    )
    kept = ranked.filter(F.col("rank") <= F.col("_wanted"))
    return below.select(*rows.columns).unionByName(kept.select(*rows.columns))
