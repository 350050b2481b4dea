"""Mix overlapping sources to target weights by a min-cost flow.

Documents are aggregated by membership pattern, the set of sources that hold them. Each pattern
is a supply of its words, each source a demand of its target; a pattern's words may be taken up
to `max_passes` times, and a later pass costs more than an earlier one, so a document is repeated
only when no unrepeated words can reach the source. The flow is solved on the driver over
patterns and sources, whose number is checked against `MAX_PATTERNS`; documents stay in Spark.

A pattern that owes whole passes gives every document so often; the words beyond are taken from
documents in the order of a seeded hash of their ids. Hash buckets of about `BUCKET_DOCS`
documents are summed, whole buckets are taken up to the one that would exceed the quota, and only
that bucket is looked at document by document: in hash order, each that still fits, and one more
if that comes nearer. Documents are taken whole, and reruns agree on any layout.

Null texts have size 0, null sources are a source of their own that sorts last. Rows that repeat
an id are documents of their own with the same place in the order. Empty tables give empty
results. Extra columns are ignored by `mix` and passed on by `mixed_documents`.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from opinara.session import materialize

MAX_PATTERNS = 100_000
MAX_PASSES = 3
BUCKET_DOCS = 512
FAN = 1024
WEIGHTS = (1, 2, 3)
SEED = 7
WORD = r"[^\x20\x09-\x0D]+"


def size(text: Column) -> Column:
    """Number of words between ASCII white space."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(
    sizes: dict[str | None, int],
    weights: Sequence[float] = WEIGHTS,
    max_passes: int = MAX_PASSES,
) -> dict[str | None, float]:
    """Shares of all words by repeating weights, at most `max_passes` times a source's own."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {name: weights[i % len(weights)] for i, name in enumerate(names)}
    result: dict[str | None, float] = {}
    left, rest = set(names), float(sum(sizes.values()))
    while left:
        unit = rest / sum(weight[s] for s in left)
        above = {s for s in left if unit * weight[s] > max_passes * sizes[s]}
        if not above:
            result.update({s: unit * weight[s] for s in left})
            break
        result.update({s: float(max_passes * sizes[s]) for s in above})
        rest -= sum(max_passes * sizes[s] for s in above)
        left -= above
    return result


class Flow:
    """Min-cost maximum flow: all shortest paths of one cost are filled before the next cost."""

    def __init__(self, nodes: int):
        self.out: list[list[int]] = [[] for _ in range(nodes)]
        self.to: list[int] = []
        self.room: list[int] = []
        self.cost: list[int] = []

    def arc(self, a: int, b: int, room: int, cost: int = 0) -> int:
        for start, end, r, c in ((a, b, room, cost), (b, a, 0, -cost)):
            self.out[start].append(len(self.to))
            self.to.append(end)
            self.room.append(r)
            self.cost.append(c)
        return len(self.to) - 2

    def distances(self, source: int) -> list[float]:
        far = [float("inf")] * len(self.out)
        far[source] = 0
        queue, waiting = deque([source]), [False] * len(self.out)
        while queue:
            a = queue.popleft()
            waiting[a] = False
            for e in self.out[a]:
                b = self.to[e]
                if self.room[e] and far[a] + self.cost[e] < far[b]:
                    far[b] = far[a] + self.cost[e]
                    if not waiting[b]:
                        waiting[b] = True
                        queue.append(b)
        return far

    def run(self, source: int, sink: int) -> None:
        while True:
            far = self.distances(source)
            if far[sink] == float("inf"):
                return
            while self._fill(source, sink, far):
                pass

    def _fill(self, source: int, sink: int, far: list[float]) -> int:
        """Push flow along arcs of shortest paths, each node once per path search."""
        level = {source: 0}
        queue = deque([source])
        fits = lambda e, a: self.room[e] and far[a] + self.cost[e] == far[self.to[e]]
        while queue:
            a = queue.popleft()
            for e in self.out[a]:
                if self.to[e] not in level and fits(e, a):
                    level[self.to[e]] = level[a] + 1
                    queue.append(self.to[e])
        if sink not in level:
            return 0
        place, pushed = [0] * len(self.out), 0
        path: list[int] = []
        a = source
        while True:
            if a == sink:
                amount = min(self.room[e] for e in path)
                for e in path:
                    self.room[e] -= amount
                    self.room[e ^ 1] += amount
                pushed += amount
                path, a = [], source
                continue
            arcs = self.out[a]
            while place[a] < len(arcs):
                e = arcs[place[a]]
                b = self.to[e]
                if fits(e, a) and level.get(b, -1) == level[a] + 1:
                    break
                place[a] += 1
            if place[a] < len(arcs):
                path.append(arcs[place[a]])
                a = self.to[path[-1]]
            elif path:
                a = self.to[path.pop() ^ 1]
                place[a] += 1
            else:
                return pushed


def route(
    supplies: Sequence[tuple[tuple[str | None, ...], int]],
    quotas: dict[str | None, float],
    max_passes: int = MAX_PASSES,
) -> list[dict[str | None, int]]:
    """Words each pattern gives to each of its sources; pass k of a pattern costs k - 1 a word."""
    names = list(quotas)
    node = {name: 2 + len(supplies) + i for i, name in enumerate(names)}
    flow = Flow(2 + len(supplies) + len(names))
    for name in names:
        flow.arc(node[name], 1, int(quotas[name] + 0.5))
    arcs: list[dict[str | None, int]] = []
    for i, (pattern, words) in enumerate(supplies):
        for k in range(max_passes):
            flow.arc(0, 2 + i, words, k)
        arcs.append({s: flow.arc(2 + i, node[s], max_passes * words) for s in set(pattern)})
    flow.run(0, 1)
    return [{s: flow.room[e ^ 1] for s, e in of.items()} for of in arcs]


def _boundary(frame: pd.DataFrame) -> pd.DataFrame:
    """Which documents of one boundary bucket to take: in hash order, each that still fits."""
    frame = frame.sort_values(["place", "id_text", "size"], kind="stable")
    left = int(frame["left"].iloc[0])
    chosen = []
    for words in frame["size"]:
        chosen.append(0 < words <= left)
        left -= words * chosen[-1]
    frame["chosen"] = chosen
    others = frame.loc[~frame["chosen"] & (frame["size"] > 0), "size"]
    if len(others) and others.min() - left < left:
        frame.loc[others.idxmin(), "chosen"] = True
    return frame


def _borders(sums: DataFrame, buckets: int) -> DataFrame:
    """`pattern_key, border, left`: the bucket in which a pattern's `rest` words are reached.

    `sums(pattern_key, bucket, rest, words)` holds `buckets` buckets a pattern at most. Runs of
    FAN ** n buckets are summed, then only the run of the border by runs of FAN ** (n - 1) and so
    on, so that a window sees at most FAN rows of a pattern however many buckets it has.
    """
    step = 1
    while step * FAN < buckets:
        step *= FAN
    upto = Window.partitionBy("pattern_key").orderBy("run")
    inside = sums.withColumn("left", F.col("rest"))
    while True:
        run = F.floor(F.col("bucket") / step)
        found = (
            inside.groupBy("pattern_key", "left", run.alias("run"))
            .agg(F.sum("words").alias("words"))
            .withColumn("reached", F.sum("words").over(upto))
            .filter("reached > left")
            .withColumn("left", F.col("left") + F.col("words") - F.col("reached"))
            .groupBy("pattern_key")
            .agg(F.min(F.struct("run", "left")).alias("b"))
            .select("pattern_key", F.col("b.run").alias("border"), F.col("b.left").alias("left"))
        )
        if step == 1:
            return found
        # One row a pattern at most, whose number is checked.
        inside = sums.join(F.broadcast(found), "pattern_key").filter(run == F.col("border"))
        inside = inside.drop("border")
        step //= FAN


def mix(
    docs: DataFrame,
    sources: Column,
    key: str = "doc_id",
    column: str = "text",
    weights: Sequence[float] = WEIGHTS,
    max_passes: int = MAX_PASSES,
    seed: int = SEED,
) -> DataFrame:
    """Per document `pattern, size, passes, taken`, and arrays along its pattern.

    `sources` is an array column of the sources that hold a document. The arrays hold the sources'
    own words, their targets, and the words the whole pattern gives to each. Runs jobs: sizes are
    written once to the shared folder, sums of patterns come to the driver.
    """
    spark = docs.sparkSession
    sized = materialize(
        docs.select(
            F.col(key).alias("id"),
            size(F.col(column)).alias("size"),
            F.array_sort(F.array_distinct(sources)).alias("pattern"),
            F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col(key)), 33).alias("place"),
        ).withColumn("pattern_key", F.to_json("pattern")),
        "sizes",
    )
    sums = (
        sized.groupBy("pattern_key")
        .agg(
            F.first("pattern").alias("pattern"),
            F.sum("size").alias("words"),
            F.count(F.lit(1)).alias("docs"),
        )
        .limit(MAX_PATTERNS + 1)
        .collect()
    )
    if len(sums) > MAX_PATTERNS:
        raise ValueError(f"over {MAX_PATTERNS} membership patterns")
    sums.sort(key=lambda row: row["pattern_key"] or "")
    own: dict[str | None, int] = {}
    for row in sums:
        for name in row["pattern"]:
            own[name] = own.get(name, 0) + row["words"]
    wanted = targets(own, weights, max_passes) if own else {}
    flows = route([(tuple(r["pattern"]), r["words"]) for r in sums], wanted, max_passes)
    plan = []
    for row, given in zip(sums, flows):
        whole, rest = divmod(sum(given.values()), row["words"]) if row["words"] else (0, 0)
        buckets = max(1, -(-row["docs"] // BUCKET_DOCS))
        names = row["pattern"]
        plan.append(
            (
                row["pattern_key"],
                whole,
                rest,
                buckets,
                [own[s] for s in names],
                [float(wanted[s]) for s in names],
                [given[s] for s in names],
            )
        )
    plan_frame = spark.createDataFrame(
        plan,
        "pattern_key string, whole long, rest long, buckets long, "
        "source_sizes array<long>, targets array<double>, given array<long>",
    )
    placed = sized.join(F.broadcast(plan_frame), "pattern_key").withColumn(
        "bucket", F.shiftright(F.col("place") * F.col("buckets"), 31)
    )
    by_bucket = placed.groupBy("pattern_key", "bucket", "rest").agg(F.sum("size").alias("words"))
    border = _borders(materialize(by_bucket, "buckets"), max((row[3] for row in plan), default=1))
    # One row per pattern at most, whose number is checked above.
    placed = placed.join(F.broadcast(border), "pattern_key", "left")
    clear = placed.filter("border IS NULL OR bucket <> border").withColumn(
        "chosen", F.col("border").isNotNull() & (F.col("bucket") < F.col("border"))
    )
    at_border = placed.filter("bucket = border").withColumn("id_text", F.col("id").cast("string"))
    taken_schema = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}" for f in at_border.schema
    )
    decided = at_border.groupBy("pattern_key").applyInPandas(
        _boundary, taken_schema + ", chosen boolean"
    )
    passes = (F.col("whole") + F.col("chosen").cast("long")).alias("passes")
    return (
        clear.select(*clear.columns)
        .unionByName(decided.select(*clear.columns))
        .select(
            F.col("id").alias(key),
            "pattern",
            "size",
            passes,
            (passes * F.col("size")).alias("taken"),
            "source_sizes",
            "targets",
            F.col("given").alias("pattern_words"),
        )
    )


def mixed_documents(docs: DataFrame, sources: Column, key: str = "doc_id", **options) -> DataFrame:
    """The rows of `docs` that the mix takes, each as often as it takes them.

    Rows that repeat an id are all taken as often as the one taken most.
    """
    taken = mix(docs, sources, key, **options).filter("passes > 0")
    taken = taken.groupBy(F.col(key).alias("__id")).agg(F.max("passes").alias("__passes"))
    whole = F.struct(*(docs[f"`{c}`"] for c in docs.columns)).alias("__row")
    return (
        docs.select(whole)
        .join(taken, F.col(f"__row.`{key}`").eqNullSafe(F.col("__id")))
        .select("__row", F.explode(F.sequence(F.lit(1), F.col("__passes"))))
        .select("__row.*")
    )
