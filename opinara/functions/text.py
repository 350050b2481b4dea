"""Text functions built from Spark expressions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from opinara.functions.wordlists import STOP_WORDS

# What the cleaning step treats as neither letter nor white space, in lower-cased
# text. (Naming A-Z too would change nothing and make Java's matcher several times slower.)
NON_LETTER = r"[^a-z\s]"


def lowercase_text(text: Column) -> Column:
    return F.lower(F.coalesce(text, F.lit("")))


def tokenize_strip(text: Column) -> Column:
    """Lower-case words: everything but letters and white space is deleted (`don't` -> `dont`)."""
    letters = F.regexp_replace(lowercase_text(text), f"{NON_LETTER}+", "")
    return F.regexp_extract_all(letters, F.lit("([a-z]+)"), F.lit(1))


def tokenize_literal(text: Column) -> Column:
    """The inverse tokenizer: each character that is neither letter nor white space."""
    return F.regexp_extract_all(lowercase_text(text), F.lit(f"({NON_LETTER})"), F.lit(1))


def tokenize(text: Column, mode: str = "strip") -> Column:
    if mode == "strip":
        return tokenize_strip(text)
    if mode == "literal":
        return tokenize_literal(text)
    raise ValueError(f"unknown tokenizer mode {mode!r}")


def remove_stopwords(words: Column, stop_words: list[str] = STOP_WORDS) -> Column:
    """Drop stop words and keep duplicates and order."""
    return F.filter(words, lambda word: ~F.lower(word).isin(*stop_words))


def join_tokens(words: Column) -> Column:
    return F.concat_ws(" ", words)


def split_words(text: Column) -> Column:
    """Pieces between single spaces; trailing empty pieces are dropped, other empty ones kept.

    The empty text has one empty piece, a text of spaces only has none.
    """
    return F.when(text == "", F.array(F.lit(""))).otherwise(
        F.when(F.rtrim(text) == "", F.array().cast("array<string>")).otherwise(
            F.split(F.rtrim(text), " ")
        )
    )


def token_count(text: Column) -> Column:
    return F.size(F.split(text, " "))


def word_bag(words: Column, keep_empty: bool = False) -> Column:
    """Distinct words of an array with their counts, `array<struct<word, n>>`, without the empty
    word unless `keep_empty`.

    Sorting brings equal words together, so run starts give both the words and, by
    subtraction, their counts: n log n per row and no shuffle. The one-element outer arrays
    bind the intermediate results, which a lambda would otherwise evaluate per element.
    """

    def runs(ordered: Column) -> Column:
        starts = F.filter(
            F.transform(ordered, lambda _, i: i),
            lambda i: (i == 0) | (F.get(ordered, i) != F.get(ordered, i - 1)),
        )
        return F.transform(
            F.array(starts),
            lambda bound: F.transform(
                bound,
                lambda start, k: F.struct(
                    F.get(ordered, start).alias("word"),
                    (F.coalesce(F.get(bound, k + 1), F.size(ordered)) - start)
                    .cast("long")
                    .alias("n"),
                ),
            ),
        )[0]

    counted = words if keep_empty else F.array_remove(words, "")
    return F.transform(F.array(F.sort_array(counted)), runs)[0]
