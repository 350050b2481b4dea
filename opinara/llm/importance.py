"""Importance resampling of documents towards a target, with every distinct line counted once.

Features are all runs of 1 to `LONGEST` consecutive words, words joined by one space; a feature
belongs to the bucket `crc32 mod BUCKETS` of its UTF-8 bytes. A bucket's gain is the logarithm, in
thousandths, of its smoothed share in the target texts over that in the documents. A document's
weight is the floored mean gain of its features; weights plus seeded Gumbel noise rank the
documents, and the first `percent` of those with `least_words` words are drawn, which is sampling
without replacement in proportion to exp(weight / 1000).

Newlines separate words, so they cut a text into lines whose words are the text's. Equal lines of
the whole corpus are brought together first (by their text, with map-side combining, so a line of
a third of all documents is one row a task), their words are found and hashed once, and bucket
counts are these times the number of occurrences. A document's sum of gains is then that of its
lines, looked up by a digest through a join that spreads the rows of hot lines, plus that of the
runs that cross a line end. The latter exist for runs of two words and more only, and are read off
the document, from which alone they can be known. Only the BUCKETS gains and totals come to the
driver. All of it is Spark's own expressions.

Only A-Z are lower-cased. Null texts are empty: no features, weight 0. Documents are rows: rows
that repeat an id are weighed and ranked each on its own, rows equal in all that is returned are
interchangeable. A null id takes part in the seed as an empty one and comes first among ties. Null
target texts count as empty; an empty table gives an empty result, and without target texts the
gains are those of smoothing alone. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinara.operators.joins import keyed_lookup
from opinara.session import PARTITION_SHIFT, materialize

# The words, in lower-cased text.
WORD = r"([^\x00-\x2F\x3A-\x60\x7B-\x7F]+)"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LONGEST = 1
BUCKETS = 10_000
PERCENT = 10
LEAST_WORDS = 20
SEED = 2024
HASHES = 2.0**32


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(WORD), F.lit(1))


def bucket(feature: Column, buckets: int) -> Column:
    return F.pmod(F.crc32(feature.cast("binary")), F.lit(buckets)).cast("int")


def _runs(found: Column, size: int) -> Column:
    """All runs of `size` consecutive elements of an array, as structs of fields `0, 1, ...`.

    Zipped from shifted arrays, because a lambda over places would build `found` for each of them.
    """
    number = F.greatest(F.size(found) - (size - 1), F.lit(0))
    return F.arrays_zip(*(F.slice(found, F.lit(i + 1), number) for i in range(size)))


def _buckets_within(found: Column, longest: int, buckets: int) -> Column:
    """Buckets of all runs of an array of words."""
    parts = [F.transform(found, lambda word: bucket(word, buckets))]
    for size in range(2, longest + 1):
        joined = lambda run, n=size: F.concat_ws(" ", *(run[str(i)] for i in range(n)))
        parts.append(F.transform(_runs(found, size), lambda run: bucket(joined(run), buckets)))
    return F.concat(*parts)


def _buckets_across(lines: Column, longest: int, buckets: int) -> Column:
    """Buckets of the runs that do not lie in one line of an array of lines.

    Of a line longer than that, only the words that such a run can reach from its ends are looked
    at: a run leaves a line over one of them.
    """
    numbered = F.flatten(
        F.transform(
            F.transform(lines, words),
            lambda found, line: F.transform(
                found,
                lambda word, place: F.named_struct(
                    F.lit("word"),
                    word,
                    F.lit("line"),
                    line,
                    F.lit("depth"),
                    F.least(place, F.size(found) - 1 - place),
                ),
            ),
        )
    )
    near = F.filter(numbered, lambda w: w["depth"] < longest - 1)

    def crossing(size: int) -> Column:
        # The words left out lie deeper than any run reaches, so a run over such a gap stays in
        # one line, and so does every other run that does not cross a line end.
        kept = F.filter(
            _runs(near, size), lambda run: run["0"]["line"] != run[str(size - 1)]["line"]
        )
        joined = lambda run: F.concat_ws(" ", *(run[str(i)]["word"] for i in range(size)))
        return F.transform(kept, lambda run: bucket(joined(run), buckets))

    return F.concat(*(crossing(size) for size in range(2, longest + 1)))


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _digest(line: Column) -> Column:
    return F.unhex(F.substring(F.sha2(line.cast("binary"), 256), 1, 32))


def distinct_lines(texts: DataFrame, column: str, longest: int, buckets: int) -> DataFrame:
    """`line_key, occurrences, buckets` of every different line. Runs a job."""
    rows = texts.select(F.explode_outer(_lines(F.col(column))).alias("line"))
    counted = rows.groupBy("line").agg(F.count(F.lit(1)).alias("occurrences"))
    # A word is hashed when its line is, so the words themselves are not kept.
    return materialize(
        counted.select(
            _digest(F.col("line")).alias("line_key"),
            "occurrences",
            _buckets_within(words(F.col("line")), longest, buckets).alias("buckets"),
        ),
        "lines",
    )


def bucket_counts(
    texts: DataFrame, lines: DataFrame, column: str, longest: int, buckets: int
) -> np.ndarray:
    """How many features fall into each bucket; `buckets` numbers come to the driver."""
    parts = lines.select(F.explode("buckets").alias("bucket"), "occurrences")
    if longest > 1:
        across = _buckets_across(_lines(F.col(column)), longest, buckets)
        crossing = texts.select(F.explode(across).alias("bucket"), F.lit(1).alias("occurrences"))
        parts = parts.unionByName(crossing)
    summed = parts.groupBy("bucket").agg(F.sum("occurrences").alias("n")).toArrow()
    counts = np.zeros(buckets, dtype=np.int64)
    counts[summed["bucket"].to_numpy()] = summed["n"].to_numpy()
    return counts


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the logarithm of each bucket's smoothed share in the target over the corpus."""
    size = len(corpus)
    above = (target + 1.0) * float(corpus.sum() + size)
    below = (corpus + 1.0) * float(target.sum() + size)
    return np.floor(1000 * np.log(above / below)).astype(np.int64)


def _gained(found: Column, gain: Column) -> Column:
    return F.aggregate(
        found, F.lit(0).cast("long"), lambda total, b: total + F.element_at(gain, b + 1)
    )


def weighed(
    docs: DataFrame,
    target: DataFrame,
    key: str = "doc_id",
    column: str = "text",
    longest: int = LONGEST,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Every row's key with `n_words, n_features, weight`. Runs jobs.

    The lookup by line shuffles a digest and a row number a line, not texts.
    """
    lines = distinct_lines(docs, column, longest, buckets)
    targets = distinct_lines(target, "text", longest, buckets)
    found = gains(
        bucket_counts(docs, lines, column, longest, buckets),
        bucket_counts(target, targets, "text", longest, buckets),
    )
    # One literal that Spark folds; an array of literals would be a node for each bucket.
    gain = F.split(F.lit(",".join(map(str, found))), ",").cast("array<long>")
    sums = lines.select(
        "line_key",
        "occurrences",
        F.size("buckets").cast("long").alias("n"),
        _gained(F.col("buckets"), gain).alias("gained"),
    )
    sums = materialize(sums, "line-gains")
    lines_of = _lines(F.col("text"))
    none = F.array().cast("array<int>")
    across = _buckets_across(lines_of, longest, buckets) if longest > 1 else none
    placed = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(key).alias("id"),
        F.col(column).alias("text"),
    ).select(
        "row",
        "id",
        F.size(across).cast("long").alias("more"),
        _gained(across, gain).alias("more_gained"),
        F.posexplode_outer(lines_of).alias("place", "line"),
    ).select(
        "row",
        "id",
        _digest(F.col("line")).alias("line_key"),
        # What crosses line ends counts once, at the first line.
        *(
            F.when(F.col("place") == 0, F.col(c)).otherwise(0).cast("long").alias(c)
            for c in ("more", "more_gained")
        ),
    )
    looked_up = keyed_lookup(
        placed,
        sums.select("line_key", "n", "gained"),
        "line_key",
        key_counts=sums.select("line_key", F.col("occurrences").alias("n_rows")),
    )
    summed = looked_up.groupBy("row").agg(
        F.first("id").alias("id"),
        F.sum("n").alias("inside"),
        F.sum("more").alias("more"),
        F.sum(F.col("gained") + F.col("more_gained")).alias("gained"),
    )
    n_features = F.col("inside") + F.col("more")
    floored = F.expr("(gained - pmod(gained, n_features)) div nullif(n_features, 0)")
    # A run of k words fewer by k - 1 than words: the runs of all sizes give the words.
    n_words = (
        n_features
        if longest == 1
        else F.when(n_features == 0, F.lit(0)).otherwise(_words_of(n_features, longest))
    )
    counted = summed.select("id", "gained", n_features.alias("n_features"), n_words.alias("n_words"))
    return counted.select(
        F.col("id").alias(key),
        F.col("n_words").cast("long").alias("n_words"),
        "n_features",
        F.when(F.col("n_features") > 0, floored).otherwise(0).cast("long").alias("weight"),
    )


def _words_of(n_features: Column, longest: int) -> Column:
    """The number of words whose runs of 1 to `longest` are `n_features`.

    n words have n + (n - 1) + ... runs, as far as sizes and words go.
    """
    few = F.expr("1")
    for n in range(2, longest):
        few = F.when(n_features >= n * (n + 1) // 2, F.lit(n)).otherwise(few)
    many = (n_features + longest * (longest - 1) // 2) / longest
    return F.when(n_features >= longest * (longest + 1) // 2, many).otherwise(few)


def noise(key: Column, seed: int) -> Column:
    """Gumbel noise in thousandths, drawn by a hash of the seed and the key."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    drawn = F.conv(F.substring(F.sha2(name.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((drawn + 0.5) / HASHES)))


def resample(
    docs: DataFrame,
    target: DataFrame,
    key: str = "doc_id",
    column: str = "text",
    longest: int = LONGEST,
    buckets: int = BUCKETS,
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    seed: int = SEED,
) -> DataFrame:
    """Every row's key with `n_features, weight, score` and `rank`, from 1 for the drawn rows and
    null for all others. Runs jobs.

    One range sort of the four numbers of each row that may be drawn ranks them; rows that tie in
    score and id are told apart by their features, then by their place in the input, so a
    much repeated id does not land in one task.
    """
    scored = weighed(docs, target, key, column, longest, buckets)
    scored = scored.withColumn("score", F.col("weight") + noise(F.col(key), seed))
    scored = materialize(scored, "scored")
    fits = F.col("n_words") >= least_words
    order = [F.col("score").desc(), F.col(key).asc(), F.col("n_features").asc(), F.col("input")]
    ranked = materialize(
        scored.filter(fits)
        .withColumn("input", F.monotonically_increasing_id())
        .orderBy(*order)
        .withColumn("place", F.monotonically_increasing_id()),
        "ranked",
    )
    part = F.shiftright("place", PARTITION_SHIFT)
    starts, before = [], 0
    for row in ranked.groupBy(part.alias("part")).count().orderBy("part").collect():
        starts.append((row["part"], before))  # one row for each partition
        before += row["count"]
    drawn = before * percent // 100
    table = docs.sparkSession.createDataFrame(starts, "part long, before long")
    rank = F.col("before") + F.col("place") - F.shiftleft("part", PARTITION_SHIFT) + 1
    columns = [key, "n_features", "weight", "score"]
    numbered = (
        ranked.withColumn("part", part)
        .join(F.broadcast(table), "part")
        .select(*columns, F.when(rank <= drawn, rank).alias("rank"))
    )
    others = scored.filter(~fits).select(*columns, F.lit(None).cast("long").alias("rank"))
    return numbered.unionByName(others)
