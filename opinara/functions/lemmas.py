"""Lemmas of English words: irregular forms, then rules for regular inflections.

Each distinct word of a batch is looked up once. The rules need no part of speech: a form that
ends like an inflection is taken as one.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opinara.functions.text import lowercase_text
from opinara.functions.word_lists import map_words
from opinara.functions.wordlists import IRREGULAR_LEMMAS

# Word, clitic, number and punctuation pieces of lower-cased English text.
LEMMA_TOKEN = r"(n't|'(?:s|m|re|ve|ll|d)\b|\p{L}+|\p{N}+|[^\s\p{L}\p{N}])"
# Verbs that contract in front of n't.
CONTRACTED = ((r"\bca(?=n't\b)", "can "), (r"\bwo(?=n't\b)", "will "), (r"\bsha(?=n't\b)", "shall "))

# Rules as (pattern of the word, its part to replace, replacement); the first match decides.
PLURAL_RULES = (
    (r"(ss|us|is|ics)$", r"$", ""),
    (r"^[a-z]ies$", r"s$", ""),
    (r"^(aunt|best|bird|brown|calor|coll|cook|cut|food|freeb|gen|goal|group|hipp|hood|junk)ies$", r"s$", ""),
    (r"^(mov|newb|pix|prair|rook|self|smooth|sort|sweet|talk|tech|town|vegg|walk|zomb)ies$", r"s$", ""),
    (r"ies$", r"ies$", "y"),
    (r"^(buffal|carg|domin|ech|embarg|her|mang|mosquit|potat|tomat|tornad|torped|vet|volcan|zer)oes$", r"es$", ""),
    (r"^(alias|atlas|bias|bonus|bus|campus|canvas|census|chorus|circus|focus|gas)es$", r"es$", ""),
    (r"^(genius|iris|lens|minus|plus|sinus|status|surplus|virus)es$", r"es$", ""),
    (r"^quizzes$", r"zes$", ""),
    (r"^((back|ear|head|heart|stomach|tooth)?ache|avalanche|cache|mustache|niche|quiche)s$", r"s$", ""),
    (r"(ch|sh|ss|x|zz)es$", r"es$", ""),
    (r"[a-z]{3,}men$", r"en$", "an"),
    (r"[a-z]{2,}s$", r"s$", ""),
)
ENDING = r"(ed|ing)$"
PAST_RULES = (
    (r"^(agr|decr|disagr|fr|guarant|refer)eed$", r"d$", ""),
    (r"eed$", r"$", ""),
    (r"^([dltv]|bel|unt)ied$", r"d$", ""),
    (r"[a-z]ied$", r"ied$", "y"),
    (r"^([dltv]|bel|underl|unt)ying$", r"ying$", "ie"),
    (r"^(cano|dy|ey|sho|sing|ting)eing$", r"ing$", ""),
    (r"^(frolic|mimic|panic|picnic|traffic)k(ed|ing)$", r"k(ed|ing)$", ""),
    (r"^quizz(ed|ing)$", r"z(ed|ing)$", ""),
    (r"^(add|butt|ebb|egg|err|putt|purr)(ed|ing)$", ENDING, ""),
    (r"[aeiouy].*(bb|dd|gg|mm|nn|pp|rr|tt)(ed|ing)$", r".(ed|ing)$", ""),
    (r"^(appall|befall|enroll|foretell|fulfill|install|misspell|recall|refill|unroll)(ed|ing)$", ENDING, ""),
    (r"[aeiouy][^aeiouy]+[aeiouy]+ll(ed|ing)$", r"l(ed|ing)$", ""),
    (r"^(arrang|aveng|bing|challeng|chang|cring|exchang|fring|hing|infring|loung|lung|plung)(ed|ing)$", ENDING, "e"),
    (r"^(rang|rearrang|reveng|spong)(ed|ing)$", ENDING, "e"),
    (r"^(ach|bath|breath|cloth|hast|past|sooth|tast|wast)(ed|ing)$", ENDING, "e"),
    (r"^(compet|complet|creat|delet|denot|devot|promot|quot|recreat)(ed|ing)$", ENDING, "e"),
    (r"^(excit|ignit|incit|invit|recit|unit)(ed|ing)$", ENDING, "e"),
    (r"^(condon|conven|interven|postpon)(ed|ing)$", ENDING, "e"),
    (r"^(ador|deplor|explor|ignor|implor|restor|underscor)(ed|ing)$", ENDING, "e"),
    (r"^(adher|interfer|persever)(ed|ing)$", ENDING, "e"),
    (r"^(becom|consol|escap|exhal|inhal|overcom|renam|reshap|welcom)(ed|ing)$", ENDING, "e"),
    (r"^(bias|canvas|collar|debut|devil|focus|margin|murmur|pencil|ruin|sugar)(ed|ing)$", ENDING, ""),
    (r"[^aeo]at(ed|ing)$", ENDING, "e"),
    (r"([bcdfgkpstz]l|yz|[aeiouy]z|c|u|v|[dlr]g|[aeiou]g)(ed|ing)$", ENDING, "e"),
    (r"[aeiouy][a-z]*[^s]s(ed|ing)$|^[a-z]?[aeiou]s(ed|ing)$", ENDING, "e"),
    (r"[^aeo][aiou]d(ed|ing)$|[^aeo]ed(ed|ing)$", ENDING, "e"),
    (r"[^aeo][iu]r(ed|ing)$|[^aeo]ar(ed|ing)$", ENDING, "e"),
    (r"[^aeou]in(ed|ing)$|[^aeo]un(ed|ing)$|[^aeo]um(ed|ing)$", ENDING, "e"),
    (r"[^aeo]ut(ed|ing)$|[^aeo]ib(ed|ing)$|[^aeou]il(ed|ing)$|[^aeo]ul(ed|ing)$", ENDING, "e"),
    (r"[^aeiouy][aiou]k(ed|ing)$", ENDING, "e"),
    (r"^[^aeiouy]*[aeiouy][^aeiouywx](ed|ing)$", ENDING, "e"),
    (r"[aeiouy].*(ed|ing)$", ENDING, ""),
)


def _first_rule(word: str, rules: tuple[tuple[str, str, str], ...]) -> str:
    for pattern, part, replacement in rules:
        if re.search(pattern, word):
            return re.sub(part, replacement, word, count=1)
    return word


def lemma(word: str) -> str:
    """Lemma of one lower-case token: irregular forms first, then a rule, else itself."""
    if word in IRREGULAR_LEMMAS:
        return IRREGULAR_LEMMAS[word]
    if word.endswith(("s", "men")):
        return _first_rule(word, PLURAL_RULES)
    if re.search(r"[aeiouy].*(ed|ing)$", word):
        return _first_rule(word, PAST_RULES)
    return word


@F.arrow_udf(T.ArrayType(T.StringType()))
def _lemma_lists(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    yield from map_words(batches, lemma)


def lemma_tokens(text: Column) -> Column:
    """Tokens of the raw lower-cased text, punctuation included; clitics stand alone."""
    apart = F.regexp_replace(lowercase_text(text), "’", "'")
    for pattern, verb in CONTRACTED:
        apart = F.regexp_replace(apart, pattern, verb)
    apart = F.regexp_replace(apart, r"n't\b", " n't")
    return F.regexp_extract_all(apart, F.lit(LEMMA_TOKEN), F.lit(1))


def lemmatize(text: Column) -> Column:
    """Lemmas of all tokens of a text, in order."""
    return _lemma_lists(lemma_tokens(text))
