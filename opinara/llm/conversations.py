"""Repair of the structure of conversations by the cheapest edits, streamed in sorted order.

A sound conversation is empty, or an optional system message and then one or more exchanges of
user and assistant. Rows are kept (`K`, free), given the role that the place needs (`R`, 1),
deleted (`D`, 2) or preceded by an inserted empty message (`I`, 5). Blank rows and repeats of an
earlier role and text must be deleted; a row that does not end in `.`, `!` or `?` costs 5 unless it
is deleted. Of the cheapest edits those whose letters come first in ASCII order are taken. The
letters fix the roles, because each state of a sound conversation wants one role.

Rows are brought together by conversation in one shuffle. In each partition a window first finds
repeats, which needs no further shuffle, and a second sort puts the rows in order of turn. Then
`mapInPandas` walks over the Arrow batches and carries the state of the dynamic program from one
batch to the next: the cost of each state, less the lowest, and the order of their letters so far.
These are few and small, so a step is looked up once it has been seen. A row leaves one number of
four bytes behind, the best predecessors of the states; these and the rows' texts go to spools that
spill to the executor's own disk beyond `SPOOL_BYTES` and are deleted by the task. So memory holds
one batch, the spools' buffers and the letters of one conversation, however long it is, and no
conversation is ever one group in memory. A lost executor repeats its partitions.

Order is by turn, nulls first; rows that share a turn by role and text, so equal rows follow each
other. Null roles and texts are one space. A null conversation id is a conversation. A role's first
character is its initial; roles that begin otherwise, or are empty, fit nowhere. Conversations
without rows are empty. Repeated rows are repeats, very long texts only make batches large, an empty
table gives an empty result, and extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
import struct
import tempfile
from array import array
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Costs of the edits, and what a truncated row adds unless it is deleted.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
# Faults of a row; the first that applies counts.
FAULTS = ("", "blank", "duplicate", "truncated")
# States of a sound conversation: nothing yet, after the system message, a user's, an assistant's.
START, SYSTEM, USER, ASSISTANT = range(4)
#: Initials that lead from a state to another, and the role that a place in a state can be given.
STEPS = {
    START: {"s": SYSTEM, "u": USER},
    SYSTEM: {"u": USER},
    USER: {"a": ASSISTANT},
    ASSISTANT: {"u": USER},
}
GIVEN = {START: "user", SYSTEM: "user", USER: "assistant", ASSISTANT: "user"}
#: Inserts that a conversation needs at its end.
MISSING = {START: 0, SYSTEM: 2, USER: 1, ASSISTANT: 0}
LEGAL = {"su", "ua", "au"}
#: From any state two inserts and a deletion do as well as any other state, so one that costs
#: more than that above the lowest cannot win.
HOPELESS = 2 * INSERT + DELETE
LETTERS = "DIKR"
SPOOL_BYTES = 1 << 20
POINTER_BLOCK = 1 << 14
NOT_BLANK = r"[^\x20\x09-\x0D]"

SUMMARY = (
    "conv string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
    "audit string, repaired_sha256 string"
)
REPAIRED = "conv string, place long, edit string, turn string, role string, text string"


class Program:
    """The dynamic program over the rows of one conversation after another.

    A configuration is a tuple of `(state, cost above the lowest)`, ordered by the letters that
    lead there. Letters up to a row end in that row's, so of two states neither's letters begin
    with the other's, and their order decides for all that follows.
    """

    def __init__(self):
        self.seen: dict = {}

    start = ((START, 0),)

    def step(self, config: tuple, initial: str, fault: int) -> tuple[tuple, int, int]:
        """The next configuration, how much its lowest cost has grown, and the row's pointers."""
        key = config, initial, fault
        found = self.seen.get(key)
        if found is None:
            found = self.seen[key] = self._step(config, initial, fault)
        return found

    @staticmethod
    def _step(config: tuple, initial: str, fault: int) -> tuple[tuple, int, int]:
        best: dict[int, tuple] = {}

        def reach(state: int, cost: int, order: tuple, previous: int) -> None:
            if state not in best or (cost, order) < best[state][:2]:
                best[state] = cost, order, previous

        for place, (state, cost) in enumerate(config):
            for inserts in range(3):
                before, paid = "I" * inserts, cost + INSERT * inserts
                reach(state_after(state, inserts), paid + DELETE, (place, before + "D"), state)
                if FAULTS[fault] in ("blank", "duplicate"):
                    continue
                paid += TRUNCATED if FAULTS[fault] == "truncated" else 0
                steps = STEPS[state_after(state, inserts)]
                if initial in steps:
                    reach(steps[initial], paid + KEEP, (place, before + "K"), state)
                given = steps[GIVEN[state_after(state, inserts)][0]]
                reach(given, paid + REROLE, (place, before + "R"), state)
        lowest = min(cost for cost, *_ in best.values())
        pointers, config = 0, []
        for state, (cost, order, previous) in sorted(best.items(), key=lambda s: s[1][1]):
            if cost - lowest <= HOPELESS:
                config.append((state, cost - lowest))
                letters = order[1]
                code = previous | (len(letters) - 1) << 2 | LETTERS.index(letters[-1]) << 4
                pointers |= code << 6 * state
        return tuple(config), lowest, pointers

    @staticmethod
    def end(config: tuple) -> tuple[int, int]:
        """The state that ends the cheapest edits, and what they cost above the lowest."""
        costs = [(cost + INSERT * MISSING[state], place) for place, (state, cost) in enumerate(config)]
        cost, place = min(costs)
        return config[place][0], cost


def state_after(state: int, inserts: int) -> int:
    for _ in range(inserts):
        state = USER if state in (START, SYSTEM, ASSISTANT) else ASSISTANT
    return state


def spool():
    """A file in memory that moves to the executor's own scratch disk when it grows."""
    folder = next(
        (
            path
            for name in ("SPARK_LOCAL_DIRS", "LOCAL_DIRS")
            for path in os.environ.get(name, "").split(",")
            if os.path.isdir(path)
        ),
        None,
    )
    return tempfile.SpooledTemporaryFile(max_size=SPOOL_BYTES, dir=folder)


class Conversation:
    """What is known of the conversation that is being read."""

    def __init__(self, conv: str | None, program: Program):
        self.conv, self.program = conv, program
        self.faults = dict.fromkeys(FAULTS, 0)
        self.illegal = self.rows = self.turns = self.cost = 0
        self.first = self.last = self.before = None
        self.config = program.start
        self.pointers, self.pending, self.messages = spool(), array("I"), spool()

    def add(self, turn: str | None, role: str, text: str, fault: int) -> None:
        initial = role[:1]
        self.faults[FAULTS[fault]] += 1
        if self.rows and self.before + initial not in LEGAL:
            self.illegal += 1
        self.before = initial
        self.rows += 1
        if turn is not None and (self.last is None or int(turn) != self.last):
            self.turns += 1
            self.last = int(turn)
            self.first = self.last if self.first is None else self.first
        self.config, grown, pointers = self.program.step(self.config, initial, fault)
        self.cost += grown
        self.pending.append(pointers)
        if len(self.pending) == POINTER_BLOCK:
            self.pointers.write(self.pending.tobytes())
            self.pending = array("I")
        parts = [("" if turn is None else turn).encode(), role.encode(), text.encode()]
        self.messages.write(struct.pack("<?3Q", turn is None, *map(len, parts)) + b"".join(parts))

    @property
    def gaps(self) -> int:
        return 0 if self.last is None else self.last - self.first + 1 - self.turns

    def audit(self) -> str:
        """The letters of the edits, read off the pointers from the last row back."""
        state, more = self.program.end(self.config)
        self.cost += more
        letters = bytearray(b"I" * MISSING[state])
        self.pointers.write(self.pending.tobytes())
        size = array("I").itemsize
        stop = self.rows
        while stop:
            start = max(0, stop - POINTER_BLOCK)
            self.pointers.seek(start * size)
            block = array("I", self.pointers.read((stop - start) * size))
            for pointers in reversed(block):
                code = pointers >> 6 * state
                letters += LETTERS[code >> 4 & 3].encode() + b"I" * (code >> 2 & 3)
                state = code & 3
            stop = start
        letters.reverse()
        return letters.decode()

    def repaired(self, audit: str) -> Iterator[tuple[str, str | None, str, str]]:
        """Each edit with the turn, role and text that it leaves; deleted rows are passed over."""
        self.messages.seek(0)
        size = struct.calcsize("<?3Q")
        state = START
        for letter in audit:
            if letter == "I":
                turn, role, text = None, GIVEN[state], ""
            else:
                missing, *lengths = struct.unpack("<?3Q", self.messages.read(size))
                turn, role, text = (self.messages.read(n).decode() for n in lengths)
                turn = None if missing else turn
                if letter == "D":
                    continue
                role = GIVEN[state] if letter == "R" else role
            state = STEPS[state][role[0]]
            yield letter, turn, role, text

    def close(self) -> None:
        self.pointers.close()
        self.messages.close()


def _conversations(batches: Iterator[pd.DataFrame]) -> Iterator[Conversation]:
    """The conversations of a sorted partition, each when its last row has been read."""
    program, current = Program(), None
    for batch in batches:
        for conv, turn, role, text, fault, gone in zip(*(batch[c].tolist() for c in ROW)):
            if current is None or conv != current.conv:
                if current is not None:
                    yield current
                current = Conversation(conv, program)
            if not gone:
                current.add(turn, role, text, fault)
    if current is not None:
        yield current


ROW = ("conv", "turn", "role", "text", "fault", "gone")
FRAME_ROWS, FRAME_BYTES = 4096, 4 << 20


def _frames(rows: Iterator[tuple], columns: list[str]) -> Iterator[pd.DataFrame]:
    """Rows as frames of bounded size."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += sum(len(v) for v in row if isinstance(v, str))
        if len(held) == FRAME_ROWS or size >= FRAME_BYTES:
            yield pd.DataFrame(held, columns=columns)
            held, size = [], 0
    if held:
        yield pd.DataFrame(held, columns=columns)


def _summaries(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    def rows():
        for found in _conversations(batches):
            audit = found.audit()
            digest = hashlib.sha256()
            between = b""
            for _, _, role, text in found.repaired(audit):
                digest.update(between + f"{role}:{text}".encode())
                between = b"\n"
            faults = [found.faults[name] for name in FAULTS[1:]]
            found.close()
            yield found.conv, found.gaps, *faults, found.illegal, found.cost, audit, digest.hexdigest()

    return _frames(rows(), [c.split()[0] for c in SUMMARY.split(", ")])


def _messages(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    def rows():
        for found in _conversations(batches):
            for place, message in enumerate(found.repaired(found.audit()), 1):
                yield found.conv, place, *message
            found.close()

    return _frames(rows(), [c.split()[0] for c in REPAIRED.split(", ")])


def damaged(conversations: DataFrame) -> DataFrame:
    """Conversations with faults put in by a hash of `conv_id:turn`, as `conv_id, turn, role, text`
    and `gone`: rows that are taken out stay as marks of their conversation."""
    spoken = [F.coalesce(c, F.lit(" ")) for c in ("role", "text")]
    name = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))
    hit = F.crc32(name.cast("binary")) % 20
    role = F.when(hit == 4, "user").otherwise(spoken[0])
    text = (
        F.when(hit == 1, "")
        .when(hit == 2, F.regexp_replace(spoken[1], "[.!?]", ""))
        .otherwise(spoken[1])
    )
    copies = F.array_repeat(hit == 0, F.when(hit == 3, 2).otherwise(1))
    return conversations.select(
        "conv_id", "turn", role.alias("role"), text.alias("text"), F.explode_outer(copies).alias("gone")
    )


def _fault(repeated: Column) -> Column:
    last = F.regexp_extract(F.col("text"), f"(?s)({NOT_BLANK})[\\x20\\x09-\\x0D]*\\z", 1)
    return (
        F.when(last == "", FAULTS.index("blank"))
        .when(repeated, FAULTS.index("duplicate"))
        .when(~last.isin(".", "!", "?"), FAULTS.index("truncated"))
        .otherwise(0)
    )


def _sorted(rows: DataFrame) -> DataFrame:
    """Rows with their faults, together by conversation and in order, after one shuffle.

    The window's keys hold the key of the shuffle, so it only sorts within the partitions; it
    counts as it goes and holds no group.
    """
    spoken = rows.select(
        F.col("conv_id").cast("string").alias("conv"),
        F.col("turn").cast("string").alias("turn"),
        F.col("turn").alias("number"),
        *(F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")),
        F.coalesce("gone", F.lit(False)).alias("gone") if "gone" in rows.columns else F.lit(False).alias("gone"),
    ).repartition("conv")
    alike = Window.partitionBy("conv", "gone", "role", "text").orderBy(F.col("number").asc_nulls_first())
    judged = spoken.withColumn("fault", _fault(F.row_number().over(alike) > 1))
    order = ["conv", F.col("number").asc_nulls_first(), "role", "text", "fault"]
    return judged.sortWithinPartitions(*order).select(*ROW)


def audits(rows: DataFrame) -> DataFrame:
    """Per `conv_id` of `conv_id, turn, role, text`: its faults, the edits and what they cost.

    Rows with a true `gone`, if there is such a column, only name their conversation.
    """
    kind = rows.schema["conv_id"].dataType.simpleString()
    found = _sorted(rows).mapInPandas(_summaries, SUMMARY)
    return found.select(F.col("conv").cast(kind).alias("conv_id"), *found.columns[1:])


def repaired(rows: DataFrame) -> DataFrame:
    """The messages of the repaired conversations: `conv_id, place, edit, turn, role, text`.

    Inserted messages have no turn.
    """
    kinds = {c: rows.schema[c].dataType.simpleString() for c in ("conv_id", "turn")}
    found = _sorted(rows).mapInPandas(_messages, REPAIRED)
    return found.select(
        F.col("conv").cast(kinds["conv_id"]).alias("conv_id"),
        "place",
        "edit",
        F.col("turn").cast(kinds["turn"]).alias("turn"),
        "role",
        "text",
    )
