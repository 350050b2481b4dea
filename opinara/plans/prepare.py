"""Raw reviews -> cleaned, balanced, split and indexed datasets, for each text variant.

Raw reviews are `review_id, overall, reviewText`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinara.functions.sampling import hash_fraction, hash_key
from opinara.operators import sampling
from opinara.operators.reviews import (
    VARIANTS,
    class_filter,
    clean_text,
    is_negative,
    is_positive,
    multiword,
    multiword_filter,
)
from opinara.session import materialize
from opinara.sources.writers import csv_line, write_datasets

ALL_VARIANTS = tuple(VARIANTS)


def cleaned_classes(reviews: DataFrame, variants: tuple[str, ...] = ALL_VARIANTS) -> DataFrame:
    """Cleaned reviews of the two classes. The rating filter comes first, so that texts of
    undecided and unrated reviews are neither joined nor cleaned.

    The result is written once: counting the classes, balancing and every later pass over the
    sample would each clean the texts again.
    """
    return materialize(clean_text(class_filter(reviews), variants=variants), "cleaned")


def balanced_variant(
    cleaned: DataFrame, variant: str, fraction: float | None = None
) -> DataFrame:
    """`review_id, overall, text` of one variant: more than one word, classes balanced. A
    filter over the cleaned texts, which are counted first if `fraction` is not given."""
    text = VARIANTS[variant]
    kept = multiword_filter(cleaned.select("review_id", "overall", text), text)
    return sampling.balanced_sample(kept, fraction=fraction).withColumnRenamed(text, "text")


def balanced_variants(
    cleaned: DataFrame, variants: tuple[str, ...] = ALL_VARIANTS
) -> DataFrame:
    """`variant, review_id, overall, text`: the balanced samples of all variants from one pass over
    the cleaned texts, after one that counts the classes.

    All variants draw with the same hash of a row, so it is taken once.
    """
    fractions = _balancing(cleaned, variants)
    drawn = hash_fraction(F.col("review_id"), f"{sampling.SEED}:balance").alias("drawn")
    columns = [VARIANTS[v] for v in variants]
    texts = F.array(
        *(
            F.struct(
                F.lit(v).alias("variant"),
                F.col(VARIANTS[v]).alias("text"),
                F.lit(fractions[v]).alias("fraction"),
            )
            for v in variants
        )
    )
    rows = cleaned.select("review_id", "overall", drawn, *columns).select(
        "review_id", "overall", "drawn", F.inline_outer(texts)
    )
    kept = is_negative() | (is_positive() & (F.col("drawn") < F.col("fraction")))
    return rows.filter(multiword(F.col("text")) & kept).select(
        "variant", "review_id", "overall", "text"
    )


def prepare_datasets(
    reviews: DataFrame, folder: str, mode: str = "error", variants: tuple[str, ...] = ALL_VARIANTS
) -> dict[str, str]:
    """Write train, test and final CSV datasets of each variant and return their paths.

    Every row is tagged with its datasets, and one job writes all of them: rows are sorted by
    dataset and place, so each task writes few datasets and files are full. A train or test row's
    place is that in the input, which also is its index, a final row's is pseudo-random. The nine
    folders are published when all of it is written.
    """
    rows = balanced_variants(cleaned_classes(reviews, variants), variants)
    index = F.monotonically_increasing_id() + 1
    split = F.when(sampling.in_train(), "train").otherwise("test")
    place = hash_key(F.col("review_id"), f"{sampling.SEED}:order")
    rows = rows.select("variant", "overall", "text", index.alias("index"), split.alias("part"), place.alias("place"))

    def tagged(part, line, order):
        return F.struct(
            F.concat_ws("_", part, "variant").alias("dataset"),
            csv_line(line).alias("value"),
            order.alias("place"),
            F.col("index").alias("index"),
        )

    both = F.array(
        tagged(F.col("part"), ["index", "overall", "text"], F.lit("")),
        tagged(F.lit("final"), ["overall", "text"], F.col("place")),
    )
    lines = rows.select(F.inline_outer(both)).orderBy("dataset", "place", "index")
    names = [f"{part}_{variant}" for variant in variants for part in ("train", "test", "final")]
    return write_datasets(lines.select("dataset", "value"), folder, names, mode)


def _balancing(cleaned: DataFrame, variants: tuple[str, ...]) -> dict[str, float]:
    """The share of positives that each variant's balanced sample keeps, from one pass."""
    counts = cleaned.agg(
        *(
            F.count_if(multiword(F.col(VARIANTS[v])) & kind).alias(f"{v}_{name}")
            for v in variants
            for name, kind in (("negative", is_negative()), ("positive", is_positive()))
        )
    ).first()
    return {
        v: min(1.0, counts[f"{v}_negative"] / max(1, counts[f"{v}_positive"])) for v in variants
    }


def with_row_id(reviews: DataFrame) -> DataFrame:
    """Number reviews that come without an id, so that each row is sampled on its own, copies
    of a review included. `prepare_datasets` writes the ids before anything depends on them;
    another layout of the same input files gives other ids and so another sample.
    """
    return reviews.withColumn("review_id", F.monotonically_increasing_id())
