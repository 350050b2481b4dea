"""Byte-pair encoding by guess and proof, and decoding.

A word's greedy longest-match split is proposed as its encoding. The proposal is right exactly
when every adjacent pair of its tokens is compatible, that is, when the merges that build the two
tokens leave the boundary between them alone. `Merges.compatible` proves that for all pairs of
all new words of a block at once: it unwinds the later of the two tokens merge by merge and looks
whether the merge across the boundary would have come first. Only words with a failing pair are
merged exactly. A word is encoded once per task; texts are sequences of words.

Nulls are empty texts; empty texts have no tokens. A text of any length takes one row of a block.
Repeated rows and ids are encoded row by row. Output rows hold the key columns given and nothing
else of the input, so extra columns never clash.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Sequence
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from opinara.llm.batches import blocks, ragged, texts
from opinara.llm.pieces import Splitter, byte_characters

NEVER = np.iinfo(np.int64).max
WORD_END = "\ue000"
HEAD = 3
SHORT_WORD = 48
CACHED_WORDS = 400_000
BLOCK_BYTES = 2 << 20
DECODED_ROWS = 512
Batches = Iterator[pa.RecordBatch]


class Merges:
    """The merge rules of a `tokenizers` BPE file as arrays over token ids."""

    def __init__(self, model: dict):
        vocabulary = model["vocab"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        if model["type"] != "BPE" or model.get("dropout") or model.get("continuing_subword_prefix"):
            raise ValueError("only plain byte-level BPE vocabularies are supported")
        self.suffix = model.get("end_of_word_suffix") or ""
        self.vocabulary = vocabulary
        self.size = max(vocabulary.values()) + 1
        self.left, self.right = np.full(self.size, -1), np.full(self.size, -1)
        self.rank = np.full(self.size, -1, dtype=np.int64)
        pairs = np.empty((len(merges), 3), dtype=np.int64)
        for order, (a, b) in enumerate(merges):
            head = a.removesuffix(self.suffix) if self.suffix else a
            made = vocabulary[head + b]
            pairs[order] = vocabulary[a], vocabulary[b], made
            if self.rank[made] < 0:
                self.left[made], self.right[made] = pairs[order, :2]
                self.rank[made] = order
        keys = pairs[:, 0] * self.size + pairs[:, 1]
        first = np.argsort(keys, kind="stable")
        self.keys, self.order, self.made = keys[first], first.astype(np.int64), pairs[first, 2]
        # The proof needs one way to build each token, and parts that are older than the whole.
        unique = len(np.unique(pairs[:, 2])) == len(pairs)
        parts = np.maximum(self.rank[pairs[:, 0]], self.rank[pairs[:, 1]])
        if not unique or (parts >= np.arange(len(pairs))).any():
            raise ValueError("a token of this vocabulary can be built in several ways")
        self.tokens = {
            (t[: -len(self.suffix)] + WORD_END if self.suffix and t.endswith(self.suffix) else t): i
            for t, i in vocabulary.items()
        }
        made = np.flatnonzero(self.rank >= 0)
        whole = self.compatible(self.left[made], self.right[made], self.rank[made])
        unreached = {int(i) for i in made[~whole]}
        self.greedy = {t: i for t, i in self.tokens.items() if i not in unreached}
        # How long tokens with the same beginning are at most.
        self.reach: dict[str, int] = {}
        for token in self.greedy:
            head = token[:HEAD]
            self.reach[head] = max(self.reach.get(head, 0), len(token))
        self.table = byte_characters()
        self._rules, self.by_rank = None, []

    def merge_rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """When a pair merges; `NEVER` for pairs without a rule."""
        key = a * self.size + b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.order[at], NEVER)

    def compatible(
        self, a: np.ndarray, b: np.ndarray, before: np.ndarray | None = None
    ) -> np.ndarray:
        """Whether the tokens `a` and `b` can stand side by side (up to the merge `before`)."""
        good = np.ones(len(a), dtype=bool)
        at = np.arange(len(a))
        a, b = np.asarray(a, dtype=np.int64), np.asarray(b, dtype=np.int64)
        limit = np.full(len(a), NEVER) if before is None else np.asarray(before)
        while at.size:
            crossed = self.merge_rank(a, b) < limit
            good[at[crossed]] = False
            a_rank, b_rank = self.rank[a], self.rank[b]
            on = ~crossed & ((a_rank >= 0) | (b_rank >= 0))
            at, a, b, a_rank, b_rank = at[on], a[on], b[on], a_rank[on], b_rank[on]
            # Of equal merges the left one comes first, so the right one is undone first.
            undo_a = a_rank > b_rank
            limit = np.where(undo_a, a_rank, b_rank + 1)
            a, b = np.where(undo_a, self.right[a], a), np.where(undo_a, b, self.left[b])
        return good

    def spelled(self, word: str) -> str:
        """A word in stand-in characters, closed by the word end where the file has one."""
        if not word.isascii():
            word = word.encode().decode("latin-1")
        return word.translate(self.table) + (WORD_END if self.suffix else "")

    def propose(self, word: str) -> list[int]:
        """Greedy longest match; the word end belongs to the last character."""
        spelled, found, at = self.spelled(word), [], 0
        get, reach, size = self.greedy.get, self.reach.get, len(spelled)
        open_end = size - 1 if self.suffix else -1  # would leave the word end alone
        while at < size:
            most = reach(spelled[at : at + HEAD], HEAD - 1)
            for end in range(min(size, at + most), at, -1):
                token = get(spelled[at:end])
                if token is not None and end != open_end:
                    break
            else:
                raise ValueError(f"no token for {spelled[at]!r}")
            found.append(token)
            at = end
        return found

    def merge(self, word: str) -> list[int]:
        """The encoding of a word by its merges, lowest rank first, then leftmost."""
        spelled = self.spelled(word)
        parts = list(spelled[:-1] if self.suffix else spelled)
        if self.suffix:
            parts[-1] += WORD_END
        ids = [self.tokens[p] for p in parts]
        return self._merge_short(ids) if len(ids) <= SHORT_WORD else self._merge_long(ids)

    def _merge_short(self, ids: list[int]) -> list[int]:
        get, size = self.rules().get, self.size
        never = len(self.by_rank)
        ranks = [get(a * size + b, never) for a, b in zip(ids, ids[1:])]
        while ranks:
            rank = min(ranks)
            if rank == never:
                break
            i = ranks.index(rank)
            ids[i : i + 2] = [self.by_rank[rank]]
            del ranks[i]
            if i:
                ranks[i - 1] = get(ids[i - 1] * size + ids[i], never)
            if i < len(ranks):
                ranks[i] = get(ids[i] * size + ids[i + 1], never)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        after = [*range(1, len(ids)), -1]
        before = list(range(-1, len(ids) - 1))
        rules, size = self.rules(), self.size
        heap = [
            (rank, i)
            for i, (a, b) in enumerate(zip(ids, ids[1:]))
            if (rank := rules.get(a * size + b)) is not None
        ]
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            j = after[i] if ids[i] >= 0 else -1
            if j < 0 or rules.get(ids[i] * size + ids[j]) != rank:
                continue
            ids[i], ids[j], after[i] = self.by_rank[rank], -1, after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for x in (before[i], i):
                y = after[x] if x >= 0 else -1
                if y >= 0 and (rank := rules.get(ids[x] * size + ids[y])) is not None:
                    heapq.heappush(heap, (rank, x))
        return [i for i in ids if i >= 0]

    def rules(self) -> dict[int, int]:
        """Ranks of the pairs that merge; made for the first failing word."""
        if self._rules is None:
            self._rules = dict(zip(self.keys.tolist(), self.order.tolist()))
            self.by_rank = self.made[np.argsort(self.order)].tolist()
        return self._rules

    def encode_words(self, words: Sequence[str]) -> list[list[int]]:
        """Encodings of distinct words: proposals, of which the failing ones are merged."""
        proposals = [self.propose(w) for w in words]
        lengths = np.fromiter(map(len, proposals), dtype=np.int64, count=len(proposals))
        flat = np.fromiter(chain.from_iterable(proposals), dtype=np.int64, count=lengths.sum())
        word = np.repeat(np.arange(len(words)), lengths)
        inner = np.flatnonzero(word[1:] == word[:-1])
        pairs, back = np.unique(flat[inner] * self.size + flat[inner + 1], return_inverse=True)
        fits = self.compatible(*np.divmod(pairs, self.size))[back]
        for failing in np.unique(word[inner[~fits]]).tolist():
            proposals[failing] = self.merge(words[failing])
        return proposals


class Encoder:
    """Texts to token ids. Encodings of words are kept between blocks, up to a fixed number."""

    def __init__(self, path: str):
        self.splitter = Splitter(path)
        self.merges: Merges | None = None
        self.forget()

    def forget(self) -> None:
        self.index: dict[str, int] = {}
        self.flat, self.starts = np.empty(0, dtype=np.int32), np.zeros(1, dtype=np.int64)

    def encode_words(self, words: Sequence[str]) -> list[list[int]]:
        if self.merges is None:
            self.merges = Merges(self.splitter.settings["model"])
        return self.merges.encode_words(words)

    def learn(self, words: Sequence[str]) -> None:
        """Add the encodings of new, distinct words."""
        specials = self.splitter.specials
        plain = [w for w in words if w not in specials]
        known = [w for w in words if w in specials]
        encoded = [*self.encode_words(plain), *([specials[w]] for w in known)]
        self.index.update(zip([*plain, *known], range(len(self.index), len(self.index) + len(words))))
        lengths = np.fromiter(map(len, encoded), dtype=np.int64, count=len(encoded))
        added = np.fromiter(chain.from_iterable(encoded), dtype=np.int32, count=lengths.sum())
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(lengths)])
        self.flat = np.concatenate([self.flat, added])

    def encode(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after another, and the number of each text."""
        if len(self.index) > CACHED_WORDS:
            self.forget()
        split = [self.splitter.pieces(t) for t in texts]
        per_text = np.fromiter(map(len, split), dtype=np.int64, count=len(split))
        words = list(chain.from_iterable(split))
        known = map(self.index.get, words, repeat(-1))
        at = np.fromiter(known, dtype=np.int64, count=len(words))
        missing = np.flatnonzero(at < 0)
        if len(missing):
            unknown = [words[i] for i in missing.tolist()]
            self.learn(list(dict.fromkeys(unknown)))
            at[missing] = list(map(self.index.__getitem__, unknown))
        begin, lengths = self.starts[at], self.starts[at + 1] - self.starts[at]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.flat[np.arange(total) + np.repeat(begin - (ends - lengths), lengths)]
        bounds = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(per_text)])]
        return ids, np.diff(bounds)


class Decoder:
    """Token ids to text: token strings joined by a space, as files without a decoder do."""

    def __init__(self, splitter: Splitter):
        size = splitter.tokenizer.get_vocab_size(with_added_tokens=True)
        self.names = np.empty(size, dtype=object)
        for token, i in splitter.tokenizer.get_vocab(with_added_tokens=True).items():
            self.names[i] = token

    def decode(self, ids: pa.ListArray) -> pa.Array:
        flat = self.names[ids.flatten().to_numpy(zero_copy_only=False)].tolist()
        ends = np.cumsum(pc.fill_null(pc.list_value_length(ids), 0).to_numpy()).tolist()
        return pa.array(
            [" ".join(flat[a:b]) for a, b in zip([0, *ends[:-1]], ends)], pa.string()
        )


def encoded_batches(path: str, key: str, column: str, batches: Batches) -> Batches:
    encoder = Encoder(path)
    for block in blocks(batches, column, BLOCK_BYTES):
        ids, lengths = encoder.encode(texts(block, column))
        yield pa.RecordBatch.from_arrays(
            [block.column(key), ragged(ids, lengths, pa.int32())], [key, "ids"]
        )


def decoded_batches(path: str, key: str, batches: Batches) -> Batches:
    decoder = Decoder(Splitter(path))
    for batch in batches:
        for start in range(0, batch.num_rows, DECODED_ROWS):
            part = batch.slice(start, DECODED_ROWS)
            ids = part.column("ids")
            yield pa.RecordBatch.from_arrays(
                [part.column(key), ids, decoder.decode(ids)], [key, "ids", "decoded"]
            )


def encode(docs: DataFrame, path: str, key: str = "doc_id", column: str = "text") -> DataFrame:
    """Every row's key and `ids array<int>`, the encoding of its whole text."""
    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, column).mapInArrow(
        lambda batches: encoded_batches(path, key, column, batches),
        f"`{key}` {kind}, ids array<int>",
    )


def decode(encoded: DataFrame, path: str, key: str = "doc_id") -> DataFrame:
    """Every row's key, its `ids` and their `decoded` text; null ids decode to the empty text."""
    kind = encoded.schema[key].dataType.simpleString()
    return encoded.select(key, "ids").mapInArrow(
        lambda batches: decoded_batches(path, key, batches),
        f"`{key}` {kind}, ids array<int>, decoded string",
    )


def round_trip(docs: DataFrame, path: str, key: str = "doc_id", column: str = "text") -> DataFrame:
    """`decode` of `encode` in one pass of the same tasks."""
    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, column).mapInArrow(
        lambda batches: decoded_batches(path, key, encoded_batches(path, key, column, batches)),
        f"`{key}` {kind}, ids array<int>, decoded string",
    )
