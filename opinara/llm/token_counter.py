"""Token counts by a finite-state transducer that is compiled from the merge rules.

The last token of the encoding of a word's beginning follows from the last tokens of the shorter
beginnings: it is the one suffix token that is compatible with the last token before it. Only the
beginnings that a longer token could still start from matter, and these are the suffixes of the
word so far that begin some token, known from the Aho-Corasick automaton of the vocabulary. So a
state is an automaton node with, for each node on its failure chain, the last token there and its
relative count; an edge reads a byte, or the end of a word, and is annotated with the change of
the token count. The word end leads back to the start. States and edges are compiled when first
met and kept, up to a fixed number.

A block of texts becomes one stream of bytes and word ends, cut into chunks that run side by
side, a step for all chunks at a time. A chunk that starts inside a word does not know its state.
Its map from states to states is constant from its first word end on, so only the bytes up to
there wait for the state of the chunk before. A chunk inside a longer word has a map with an entry
for each state that it may start in: those reached by starting a longest token earlier, and those
in which the map of the chunk before ends. The maps of all chunks are filled side by side and
composed by a prefix scan that doubles its reach. States that start apart soon agree, so two or
three rounds fill them, and a round adds at least one chunk where they never agree. Counts of
texts are sums of the annotations.

Null texts are empty and have 0 tokens. Special strings in a text are one token each, as is the
library's default. A text of any length takes one row of a block. Repeated rows are counted row
by row; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from opinara.llm.batches import map_blocks, texts
from opinara.llm.bpe import WORD_END, Merges
from opinara.llm.pieces import Splitter, byte_characters

END = 256
START, UNKNOWN = 0, 1
CHUNK = 512
MAX_STATES = 250_000
STRETCH = 1 << 20
LANE = 1 << 32
BLOCK_BYTES = 4 << 20
SPACE, LETTER, NUMBER, SIGN = range(4)


class Automaton:
    """Aho-Corasick automaton of the tokens' bytes; END stands for the end of a word."""

    def __init__(self, merges: Merges):
        byte_of = {c: b for b, c in byte_characters().items()} | {WORD_END: END}
        self.next: list[dict[int, int]] = [{}]
        self.token, self.depth = [-1], [0]
        for spelled, token in merges.greedy.items():
            node = 0
            for symbol in (byte_of[c] for c in spelled):
                if symbol not in self.next[node]:
                    self.next[node][symbol] = len(self.next)
                    self.next.append({})
                    self.token.append(-1)
                    self.depth.append(self.depth[node] + 1)
                node = self.next[node][symbol]
            self.token[node] = token
        self.fail = [0] * len(self.next)
        queue = deque(self.next[0].values())
        while queue:
            node = queue.popleft()
            for symbol, child in self.next[node].items():
                self.fail[child] = self.step(self.fail[node], symbol)
                queue.append(child)

    def step(self, node: int, symbol: int) -> int:
        while symbol not in self.next[node]:
            if not node:
                return 0
            node = self.fail[node]
        return self.next[node][symbol]

    def chain(self, node: int) -> list[int]:
        """The node and its failures down to the root."""
        found = [node]
        while node:
            node = self.fail[node]
            found.append(node)
        return found


class Transducer:
    """States and edges met so far, as flat tables over (state, column of a symbol)."""

    def __init__(self, merges: Merges):
        self.merges, self.automaton = merges, Automaton(merges)
        self.longest = max(self.automaton.depth)
        self.pairs: dict[int, bool] = {}
        self.forget()

    def forget(self) -> None:
        """Start again with the start state and the state of chunks that lack one."""
        self.column = np.full(END + 1, -1, dtype=np.int64)
        self.symbols: list[int] = []
        self.width, self.room = 64, 1024
        self.target = np.full(self.width * self.room, -1, dtype=np.int32)
        self.change = np.zeros(self.width * self.room, dtype=np.int8)
        start = (0, ((-1, 0),))
        self.states, self.number = [start, None], {start: START}

    def columns(self, stream: np.ndarray) -> np.ndarray:
        """The table columns of a stream's symbols; new symbols get new ones."""
        present = np.flatnonzero(np.bincount(stream, minlength=END + 1))
        for symbol in present[self.column[present] < 0].tolist():
            if len(self.symbols) == self.width:
                self._widen()
            self.column[symbol] = len(self.symbols)
            self.symbols.append(symbol)
        return self.column.astype(np.int16)[stream]

    def _widen(self) -> None:
        for name, empty in (("target", -1), ("change", 0)):
            old = getattr(self, name).reshape(self.room, self.width)
            new = np.full((self.room, self.width * 2), empty, dtype=old.dtype)
            new[:, : self.width] = old
            setattr(self, name, new.ravel())
        self.width *= 2

    def _deepen(self) -> None:
        size = self.room * self.width
        self.target = np.concatenate([self.target, np.full(size, -1, dtype=np.int32)])
        self.change = np.concatenate([self.change, np.zeros(size, dtype=np.int8)])
        self.room *= 2

    def compatible(self, a: int, b: int) -> bool:
        key = a * self.merges.size + b
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) > 1_000_000:
                self.pairs.clear()
            known = bool(self.merges.compatible(np.array([a]), np.array([b]))[0])
            self.pairs[key] = known
        return known

    def compile(self, edges: np.ndarray) -> None:
        """Fill the edges at the given places of the tables."""
        tests = {}
        for edge in edges.tolist():
            state, column = divmod(edge, self.width)
            tests[edge] = self._candidates(state, self.symbols[column])
        asked = {
            (before, token)
            for found in tests.values()
            for token, before, _ in found
            if before >= 0 and before * self.merges.size + token not in self.pairs
        }
        if asked:
            a, b = (np.array(x, dtype=np.int64) for x in zip(*asked))
            if len(self.pairs) > 1_000_000:
                self.pairs.clear()
            fits = self.merges.compatible(a, b).tolist()
            self.pairs.update(zip((a * self.merges.size + b).tolist(), fits))
        for edge, found in tests.items():
            self._fill(edge, found)

    def _candidates(self, state: int, symbol: int) -> list[tuple[int, int, int]]:
        """Tokens that may end in a symbol, with the last token and the count before them."""
        if state == UNKNOWN or (state == START and symbol == END):
            return []
        node, history = self.states[state]
        found = []
        for at, (before, count) in zip(self.automaton.chain(node), history):
            child = self.automaton.next[at].get(symbol)
            if child is not None and self.automaton.token[child] >= 0:
                found.append((self.automaton.token[child], before, count))
        return found

    def _fill(self, edge: int, found: list[tuple[int, int, int]]) -> None:
        state, column = divmod(edge, self.width)
        symbol = self.symbols[column]
        if not found:
            target = START if symbol == END else UNKNOWN if state == UNKNOWN else state
            self.target[edge], self.change[edge] = target, 0
            return
        for token, before, count in found:
            if before < 0 or self.compatible(before, token):
                break
        else:
            raise ValueError("no token of the vocabulary fits")
        change = count + 1
        if symbol == END:
            self.target[edge], self.change[edge] = START, change
            return
        node, history = self.states[state]
        depth = self.automaton.depth
        past = {depth[n]: entry for n, entry in zip(self.automaton.chain(node), history)}
        reached = self.automaton.step(node, symbol)
        # Without the last symbol, the nodes of the new chain are nodes of the old one.
        older = [past[depth[n] - 1] for n in self.automaton.chain(reached)[:-1]]
        key = (reached, (*((t, c - change) for t, c in older), (token, 0)))
        target = self.number.get(key)
        if target is None:
            target = len(self.states)
            if target == self.room:
                self._deepen()
            self.states.append(key)
            self.number[key] = target
        self.target[edge], self.change[edge] = target, change

    def step(self, states: np.ndarray, columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Targets and changes for states and the symbols they read."""
        edge = states * self.width + columns
        target = self.target[edge]
        if target.size and target.min() < 0:
            self.compile(np.unique(edge[target < 0]))
            target = self.target[edge]
        return target.astype(np.int64), self.change[edge]

    def run(self, stream: np.ndarray) -> np.ndarray:
        """The change of the count at each symbol of a stream that ends with END."""
        changes = np.empty(len(stream), dtype=np.int8)
        state, size = START, max(STRETCH // CHUNK, 1) * CHUNK
        for at in range(0, len(stream), size):
            if len(self.states) > MAX_STATES:
                state = self._kept(state)
            changes[at : at + size], state = self._stretch(stream[at : at + size], state)
        return changes

    def _kept(self, state: int) -> int:
        """The number of a state after all others are forgotten."""
        key = self.states[state]
        self.forget()
        if key not in self.number:
            self.number[key] = len(self.states)
            self.states.append(key)
        return self.number[key]

    def _stretch(self, stream: np.ndarray, first: int) -> tuple[np.ndarray, int]:
        """The changes of a part of a stream that is entered in state `first`, and its last state.

        Only the last part of a stream, which ends with END, may be no multiple of CHUNK.
        """
        columns = self.columns(np.append(stream, END))
        lanes = -(-len(stream) // CHUNK)
        padded = np.full(lanes * CHUNK, columns[-1], dtype=np.int16)
        padded[: len(stream)] = columns[:-1]
        rows = np.ascontiguousarray(padded.reshape(lanes, CHUNK).T)
        changes = np.empty((CHUNK, lanes), dtype=np.int8)
        states = np.full(lanes, UNKNOWN, dtype=np.int64)
        states[0] = first
        for i in range(CHUNK):
            states, changes[i] = self.step(states, rows[i])
        ends = rows == columns[-1]
        heads = np.where(ends.any(axis=0), ends.argmax(axis=0) + 1, CHUNK)
        inside = np.flatnonzero(states == UNKNOWN)
        if inside.size:
            states[inside] = self._ends_inside(inside, states, padded, rows)
        order = 1 + np.argsort(-heads[1:], kind="stable")
        now = states[order - 1]
        for i in range(int(heads[1:].max(initial=0))):
            live = int(np.searchsorted(-heads[order], -i, "left"))
            now[:live], changes[i, order[:live]] = self.step(now[:live], rows[i, order[:live]])
        return changes.T.ravel()[: len(stream)], int(states[-1])

    def _ends_inside(
        self, inside: np.ndarray, states: np.ndarray, padded: np.ndarray, rows: np.ndarray
    ) -> np.ndarray:
        """The states after the chunks `inside` words, from those after all others.

        A map's entries are keys, lane and state before the chunk, with the key they lead to.
        """
        known = states[inside - 1] != UNKNOWN
        true = inside[known] * LANE + states[inside[known] - 1]
        new = np.union1d(true, self._earlier(inside[~known], padded, [0]))
        keys, after = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
        for turn in range(len(inside) + 2):
            lane, now = np.divmod(new, LANE)
            for i in range(CHUNK):
                now, _ = self.step(now, rows[i, lane])
            keys, after = np.append(keys, new), np.append(after, (lane + 1) * LANE + now)
            order = np.argsort(keys)
            keys, after = keys[order], after[order]
            reached = self._scan(keys, after, true)
            found = np.flatnonzero(reached)
            if len(found) == len(inside):
                return after[found] % LANE  # in the order of keys, so of lanes
            open_ = np.setdiff1d(inside, keys[found] // LANE, assume_unique=True)
            new = after
            if turn == 1:
                new = np.append(after, self._earlier(open_, padded, range(1, self.longest + 1)))
            new = np.setdiff1d(new[np.isin(new // LANE, open_)], keys)
        raise AssertionError("each turn reaches a chunk more")

    def _earlier(self, lanes: np.ndarray, padded: np.ndarray, offsets: Sequence[int]) -> np.ndarray:
        """Keys of states at the chunks' starts, entered a longest token and an offset before."""
        if not len(lanes):
            return np.empty(0, dtype=np.int64)
        lane = np.repeat(lanes, len(offsets))
        at = lane * CHUNK - self.longest - np.tile(np.array(offsets), len(lanes))
        now = np.full(len(lane), START, dtype=np.int64)
        for back in range(self.longest + max(offsets), 0, -1):
            place = lane * CHUNK - back
            live = np.flatnonzero((place >= at) & (place >= 0))
            now[live], _ = self.step(now[live], padded[place[live]])
        return np.unique(lane * LANE + now)

    @staticmethod
    def _scan(keys: np.ndarray, after: np.ndarray, true: np.ndarray) -> np.ndarray:
        """Which entries are reached from the `true` ones, by maps composed with themselves."""
        place = np.minimum(np.searchsorted(keys, after), len(keys) - 1)
        stop = len(keys)
        leads = np.append(np.where(keys[place] == after, place, stop), stop)
        reached = np.zeros(stop + 1, dtype=bool)
        reached[np.searchsorted(keys, true)] = True
        while (leads < stop).any():
            reached[leads[reached]] = True
            leads = leads[leads]
        return reached[:stop]


CLASS = np.full(256, SIGN, dtype=np.int8)
CLASS[[*range(9, 14), 32]] = SPACE
CLASS[[*range(97, 123), 0xC3, 0xC4, 0xC5]] = LETTER
CLASS[48:58] = NUMBER
#: Second bytes after C2 and C3 whose class differs from that of the first.
AFTER_C2 = CLASS.copy()
AFTER_C2[:] = SIGN
AFTER_C2[[0xAA, 0xB5, 0xBA]] = LETTER
AFTER_C2[[0xB2, 0xB3, 0xB9, 0xBC, 0xBD, 0xBE]] = NUMBER
AFTER_C3 = np.full(256, LETTER, dtype=np.int8)
AFTER_C3[[0x97, 0xB7]] = SIGN


def plain_stream(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and word ends of lower-cased plain texts, and where each text's stream ends."""
    parts = [t.encode() for t in texts]
    data = np.frombuffer(b"\n".join(parts) + b"\n\0\0\0", dtype=np.uint8)
    size = len(data) - 3
    kind = CLASS[data]
    for lead, table in ((0xC2, AFTER_C2), (0xC3, AFTER_C3)):
        at = np.flatnonzero(data == lead)
        kind[at] = table[data[at + 1]]
    inner = np.flatnonzero((data & 0xC0) == 0x80)
    for _ in range(2):  # characters of plain texts have three bytes at most
        kind[inner] = kind[inner - 1]
    begins = kind != SPACE
    begins[inner] = False
    begins[1:] &= (kind[1:] != kind[:-1]) | (kind[1:] == NUMBER)
    quotes = np.flatnonzero((data == 0x27) & begins)
    one, two = data[quotes + 1], data[quotes + 2]
    short = np.isin(one, list(b"stmd"))
    long = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e"))
    long |= (one == ord("l")) & (two == ord("l"))
    begins[quotes[short | long] + 1] = False
    for after in (quotes[short] + 2, quotes[long] + 3):
        begins[after[(kind[after] == LETTER)]] = True
    kept = kind[:size] != SPACE
    ends = kept & (begins[1 : size + 1] | (kind[1 : size + 1] == SPACE))
    places = np.cumsum(kept) + np.cumsum(ends)
    total = int(places[-1])
    stream = np.full(total, END, dtype=np.int64)
    stream[(places - ends)[kept] - 1] = data[:size][kept]
    lengths = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts))
    return stream, places[np.cumsum(lengths + 1) - 1]


class Counter:
    """Token counts of texts under a `tokenizers` BPE file with word ends."""

    def __init__(self, path: str):
        self.splitter = Splitter(path)
        merges = Merges(self.splitter.settings["model"])
        if not merges.suffix:
            raise ValueError("the transducer needs a vocabulary with word ends")
        self.transducer = Transducer(merges)

    def counts(self, texts: Sequence[str]) -> np.ndarray:
        total = np.zeros(len(texts), dtype=np.int64)
        plain: list[str] = []
        plain_owner: list[int] = []
        other: list[bytes] = []
        other_owner: list[int] = []
        for owner, text in enumerate(texts):
            for place, segment in enumerate(self.splitter.segments(text)):
                if place % 2:
                    total[owner] += 1
                elif self.splitter.is_plain(segment):
                    plain.append(segment.lower())
                    plain_owner.append(owner)
                else:
                    pieces = self.splitter.library_pieces(segment)
                    other += [p.encode() for p in pieces]
                    other_owner += [owner] * len(pieces)
        if plain:
            self._add(total, plain_owner, *plain_stream(plain))
        if other:
            lengths = np.fromiter(map(len, other), dtype=np.int64, count=len(other)) + 1
            stream = np.frombuffer(b"\0".join(other) + b"\0", dtype=np.uint8).astype(np.int64)
            ends = np.cumsum(lengths)
            stream[ends - 1] = END
            self._add(total, other_owner, stream, ends)
        return total

    def _add(
        self, total: np.ndarray, owner: list[int], stream: np.ndarray, ends: np.ndarray
    ) -> None:
        if not len(stream):
            return
        sums = np.concatenate([[0], np.cumsum(self.transducer.run(stream), dtype=np.int64)])
        np.add.at(total, owner, np.diff(sums[np.concatenate([[0], ends])]))


def count_tokens(
    docs: DataFrame, path: str, keys: Sequence[str] = ("doc_id",), column: str = "text"
) -> DataFrame:
    """Every row's columns `keys` with `n_tokens` of its whole text."""
    rows = docs.select(*keys, column)

    def build():
        counter = Counter(path)

        def apply(block):
            counts = pa.array(counter.counts(texts(block, column)))
            return pa.RecordBatch.from_arrays(
                [*(block.column(k) for k in keys), counts], [*keys, "n_tokens"]
            )

        return apply

    kinds = [f"`{k}` {rows.schema[k].dataType.simpleString()}" for k in keys]
    return map_blocks(rows, column, build, ", ".join([*kinds, "n_tokens long"]), BLOCK_BYTES)
