"""Porter stemmer (M. F. Porter, "An algorithm for suffix stripping", 1980) as an Arrow UDF.

Follows the author's later restatement of the algorithm in Snowball, which undoubles only
b d f g m n p r t. Short words are not exempt.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opinara.functions.word_lists import map_words

# Executors get this module's functions with the task, so the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Word shapes. A consonant y is written Y, so `[aeiouy]` is exactly the vowels.
HAS_VOWEL = "[aeiouy]"
MEASURE_ABOVE_0 = "^[^aeiouy]*[aeiouy]+[^aeiouy]"
MEASURE_ABOVE_1 = "^[^aeiouy]*[aeiouy]+[^aeiouy]+[aeiouy]+[^aeiouy]"
SHORT_END = "[^aeiouy][aeiouy][^aeiouywxY]$"
SHORT_WORD = "^[^aeiouy]+[aeiouy][^aeiouywxY]$"
UNDOUBLED = "(bb|dd|ff|gg|mm|nn|pp|rr|tt)$"
RESTORES_E = "(at|bl|iz)$"

# Suffixes and replacements of steps 1a to 4, the longest match counts.
STEP_1A = {"sses": "ss", "ies": "i", "ss": "ss", "s": ""}
STEP_2 = {
    "ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance", "izer": "ize",
    "abli": "able", "alli": "al", "entli": "ent", "eli": "e", "ousli": "ous",
    "ization": "ize", "ation": "ate", "ator": "ate", "alism": "al", "iveness": "ive",
    "fulness": "ful", "ousness": "ous", "aliti": "al", "iviti": "ive", "biliti": "ble",
}
STEP_3 = {
    "icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic", "ful": "", "ness": "",
}
STEP_4 = (
    "al ance ence er ic able ible ant ement ment ent ion ou ism ate iti ous ive ize"
).split()


def longest_suffix(word: str, suffixes) -> str | None:
    if not word.endswith(tuple(suffixes)):
        return None
    return max((s for s in suffixes if word.endswith(s)), key=len, default=None)


def _strip_past(word: str) -> str:
    """Step 1b."""
    ending = longest_suffix(word, ("eed", "ed", "ing"))
    if ending is None:
        return word
    stem = word[: -len(ending)]
    if ending == "eed":
        return stem + "ee" if re.search(MEASURE_ABOVE_0, stem) else word
    if not re.search(HAS_VOWEL, stem):
        return word
    if re.search(UNDOUBLED, stem):
        return stem[:-1]
    return stem + "e" if re.search(RESTORES_E, stem) or re.search(SHORT_WORD, stem) else stem


def _replace_suffix(word: str, table: dict[str, str], condition: str) -> str:
    ending = longest_suffix(word, table)
    if ending is None:
        return word
    stem = word[: len(word) - len(ending)]
    return stem + table[ending] if re.search(condition, stem) else word


def _drop_suffix(word: str) -> str:
    """Step 4."""
    ending = longest_suffix(word, STEP_4)
    if ending is None:
        return word
    stem = word[: -len(ending)]
    kept = not re.search(MEASURE_ABOVE_1, stem) or (ending == "ion" and stem[-1] not in "st")
    return word if kept else stem


def _tidy(word: str) -> str:
    """Step 5."""
    stem = word[:-1]
    if word.endswith("e") and (
        re.search(MEASURE_ABOVE_1, stem)
        or (re.search(MEASURE_ABOVE_0, stem) and not re.search(SHORT_END, stem))
    ):
        word = stem
    return word[:-1] if word.endswith("ll") and re.search(MEASURE_ABOVE_1, word[:-1]) else word


def porter_stem(word: str) -> str:
    marked = re.sub("([aeiouy])y", r"\1Y", re.sub("^y", "Y", word))
    marked = _strip_past(_replace_suffix(marked, STEP_1A, ""))
    if marked[-1:] in ("y", "Y") and re.search(HAS_VOWEL, marked[:-1]):
        marked = marked[:-1] + "i"
    marked = _replace_suffix(marked, STEP_2, MEASURE_ABOVE_0)
    marked = _replace_suffix(marked, STEP_3, MEASURE_ABOVE_0)
    return _tidy(_drop_suffix(marked)).replace("Y", "y")


@F.arrow_udf(T.ArrayType(T.StringType()))
def _stem_lists(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    yield from map_words(batches, porter_stem)


def stem_words(words: Column) -> Column:
    """Porter stems of a token array, in order. The array must not be null."""
    return _stem_lists(words)
