"""Connected components of an edge table, by alternating large and small stars.

Each step turns edges towards the smallest neighbour of a node, until every node points at the
smallest of its component. Neighbour minima are aggregates with map-side combining, and go back
to the edges through salted keys, so the centre of a huge star is no hot key. Every step is
written to the shared folder, which cuts the lineage; nothing but an edge count and a checksum
comes to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinara.session import materialize

SALTS = 16


def _lowest(edges: DataFrame) -> DataFrame:
    """Every edge `u, v` with `m`, the smallest of u and its neighbours in the table."""
    lowest = edges.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
    salted = lowest.withColumn("s", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return edges.withColumn("s", F.pmod(F.xxhash64("v"), F.lit(SALTS)).cast("int")).join(
        salted, ["u", "s"]
    )


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _lowest(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    turned = _lowest(down).select(
        F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("e")
    )
    return turned.select(F.col("e.v").alias("u"), F.col("e.m").alias("v"))


def _checked(edges: DataFrame) -> tuple[DataFrame, tuple]:
    written = materialize(edges.filter("u <> v").distinct(), "stars")
    mark = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    return written, tuple(written.agg(F.count(F.lit(1)), mark).first())


def components(edges: DataFrame) -> DataFrame:
    """`node, label` of every node of an edge `u, v` whose label, the smallest node of its
    component, is not itself. Null ends and loops are ignored. Runs jobs."""
    edges, mark = _checked(edges.select("u", "v"))
    while mark[0]:
        edges, new = _checked(_small_star(_large_star(edges)))
        if new == mark:
            break
        mark = new
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label"))
