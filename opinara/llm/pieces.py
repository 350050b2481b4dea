"""Split texts into the word pieces that a byte-level BPE vocabulary merges within.

A `tokenizers` file says how to normalise and split. Texts made only of the characters in
`PLAIN` are split by one compiled pattern; any other text goes through the library's own
normaliser and splitter, so character tables never disagree. Special strings of the file are
cut out first, as the library does, and come back as pieces of their own.
"""

from __future__ import annotations

import json
import re

from tokenizers import Tokenizer

# The settings of the file for which the compiled pattern is right.
PLAIN_NORMALIZER = ["NFC", "Replace", "Lowercase"]
PLAIN_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# Characters whose lower case, normal form and class are the same in every Unicode version.
PLAIN = re.compile("[\t-\r -~¡-įı-ſ‐-‧‰-⁞₠-₿]*")
LETTERS = "a-zªµºß-öø-ÿĀ-ſ"
NUMBERS = "0-9²³¹¼-¾"
PIECES = re.compile(
    f"'(?:[stmd]|re|ve|ll)|[{LETTERS}]+|[{NUMBERS}]|[^\\s{LETTERS}{NUMBERS}]+"
)


def byte_characters() -> dict[int, str]:
    """The printable stand-in of every byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class Splitter:
    """Pieces of a text under a `tokenizers` file; specials are pieces too."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as file:
            self.settings = json.load(file)
        added = self.tokenizer.get_added_tokens_decoder()
        self.specials = {token.content: i for i, token in added.items()}
        self.cut = re.compile(
            "(" + "|".join(re.escape(s) for s in sorted(self.specials, key=len, reverse=True)) + ")"
        )
        normalizer = self.settings["normalizer"] or {}
        splitter = self.settings["pre_tokenizer"] or {}
        self.plain = (
            [n["type"] for n in normalizer.get("normalizers", [])] == PLAIN_NORMALIZER
            and splitter.get("pretokenizers", [{}])[0].get("pattern", {}).get("Regex")
            == PLAIN_SPLIT
        )
        self.byte_of = {c: b for b, c in byte_characters().items()}

    def is_plain(self, text: str) -> bool:
        return self.plain and PLAIN.fullmatch(text) is not None

    def segments(self, text: str) -> list[str]:
        """The text cut at special strings, which stand at the odd places."""
        if not self.specials or not any(s in text for s in self.specials):
            return [text]
        return self.cut.split(text)

    def library_pieces(self, text: str) -> list[str]:
        """Pieces by the library's normaliser and splitter, as ordinary text."""
        if self.tokenizer.normalizer is not None:
            text = self.tokenizer.normalizer.normalize_str(text)
        parts = self.tokenizer.pre_tokenizer.pre_tokenize_str(text)
        return [bytes(self.byte_of[c] for c in part).decode() for part, _ in parts]

    def pieces(self, text: str) -> list[str]:
        if "<" not in text and self.is_plain(text):
            return PIECES.findall(text.lower())
        found: list[str] = []
        for place, segment in enumerate(self.segments(text)):
            if place % 2:
                found.append(segment)
            elif self.is_plain(segment):
                found += PIECES.findall(segment.lower())
            elif segment:
                found += self.library_pieces(segment)
        return found
