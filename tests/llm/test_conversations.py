import hashlib
import random
import re
import zlib
from functools import cache

import pytest
from pyspark.sql import functions as F

from opinara.llm import conversations
from opinara.llm.conversations import Program

SCHEMA = "conv_id long, turn long, role string, text string, conv string, number int, fault string"
COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
SPACE = "\x20\x09\x0a\x0b\x0c\x0d"
MOVES = {("0", "s"): "s", ("0", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
ROLES = {"u": "user", "a": "assistant"}


def shown(value):
    return " " if value is None else str(value)


def after_damage(rows):
    found = {}
    for conv, turn, role, text in rows:
        kept = found.setdefault(conv, [])
        role, text = shown(role), shown(text)
        hit = zlib.crc32(f"{shown(conv)}:{shown(turn)}".encode()) % 20
        if hit == 0:
            continue
        if hit == 1:
            text = ""
        if hit == 2:
            text = re.sub("[.!?]", "", text)
        if hit == 4:
            role = "user"
        kept += [(turn, role, text)] * (2 if hit == 3 else 1)
    return found


def judged(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    seen, faults = set(), []
    for _, role, text in rows:
        last = text.rstrip(SPACE)[-1:]
        if not last:
            faults.append("blank")
        elif (role, text) in seen:
            faults.append("duplicate")
        else:
            faults.append("" if last in ".!?" else "truncated")
        seen.add((role, text))
    return rows, faults


def cheapest(rows, faults):
    """Cost, letters and messages of the best edits, from the last row back."""

    @cache
    def best(i, state, inserts):
        options = []
        if i == len(rows) and state in "0a":
            options.append((0, "", ()))
        if inserts < 3:
            for role in "ua":
                if (state, role) in MOVES:
                    cost, letters, rest = best(i, role, inserts + 1)
                    options.append((cost + 5, "I" + letters, ((ROLES[role], ""), *rest)))
        if i < len(rows):
            _, role, text = rows[i]
            cost, letters, rest = best(i + 1, state, 0)
            options.append((cost + 2, "D" + letters, rest))
            if faults[i] not in ("blank", "duplicate"):
                more = 5 if faults[i] == "truncated" else 0
                for letter, price, name in (("K", 0, role), ("R", 1, "user"), ("R", 1, "assistant")):
                    if (state, name[:1]) in MOVES:
                        cost, letters, rest = best(i + 1, name[:1], 0)
                        options.append((cost + more + price, letter + letters, ((name, text), *rest)))
        return min(options, default=(10**9, "", ()))

    return best(0, "0", 0)


def brute_force(found):
    lines = []
    for conv, rows in found.items():
        rows, faults = judged(rows)
        cost, audit, messages = cheapest(rows, faults)
        assert re.fullmatch("(s?(ua)+)?", "".join(role[0] for role, _ in messages))
        turns = {r[0] for r in rows if r[0] is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in messages).encode()).hexdigest()
        lines.append(
            (
                conv, gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
                sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, digest,
            )
        )
    return sorted(lines, key=str)


def drawn(seed, conversations=120, rows=9):
    draw = random.Random(seed)
    roles = ["user", "assistant", "system", "user", "assistant", None, "", "tool", "User", "\x00"]
    texts = ["Yes.", "no", "What? ", " \n", "", None, "Fine!\t", " ", " x", "end.\nmore", "ok.\x0b", "é!"]
    found = []
    for conv in range(conversations):
        for turn in range(draw.randrange(rows)):
            place = draw.choice([turn, turn, turn, None, draw.randrange(-3, 9)])
            found.append((conv, place, draw.choice(roles), draw.choice(texts)))
    return found + [(None, 1, "user", "Hi."), (None, 2, "assistant", "Ho."), (2**62, 2**62, "user", "Big.")]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA).repartition(3)


@pytest.mark.parametrize("seed", range(3))
def test_damaged_conversations_equal_brute_force(spark, seed):
    rows = drawn(seed)
    got = conversations.audits(conversations.damaged(frame(spark, rows))).select(COLUMNS)
    assert sorted(map(tuple, got.collect()), key=str) == brute_force(after_damage(rows))


def test_plain_rows_and_their_messages(spark):
    rows = drawn(7)
    groups = {}
    for conv, turn, role, text in rows:
        groups.setdefault(conv, []).append((turn, shown(role), shown(text)))
    got = conversations.audits(frame(spark, rows)).select(COLUMNS)
    assert sorted(map(tuple, got.collect()), key=str) == brute_force(groups)
    messages = {}
    for r in conversations.repaired(frame(spark, rows)).orderBy("place").collect():
        messages.setdefault(r["conv_id"], []).append((r["role"], r["text"]))
        assert (r["turn"] is None) >= (r["edit"] == "I")
    want = {conv: list(cheapest(*judged(group))[2]) for conv, group in groups.items()}
    assert messages == {conv: found for conv, found in want.items() if found}


def test_ties_are_ascii_least():
    program = Program()
    for initials in ("", "a", "s", "su", "uu", "au", "asu", "uauua", "suas", "x", "uxa", "ss", "aaa"):
        rows = [(i, {"s": "system", "u": "user", "a": "assistant"}.get(c, c), f"{i}.") for i, c in enumerate(initials)]
        config, cost = program.start, 0
        for c in initials:
            config, grown, _ = program.step(config, c, 0)
            cost += grown
        assert cost + program.end(config)[1] == cheapest(rows, [""] * len(rows))[0], initials


def test_states_stay_few():
    """However long a conversation is, the program's table stays small."""
    draw, program = random.Random(1), Program()
    config = program.start
    for _ in range(200_000):
        config, _, pointers = program.step(config, draw.choice("suax"), draw.randrange(4))
        assert pointers < 1 << 24
    assert len(program.seen) < 20_000


def test_giant_conversation(spark):
    """Spools spill, pointers are read back in blocks, and batches do not cut conversations."""
    n = 60_000
    roles = F.when(F.col("id") % 2 == 0, "user").otherwise("assistant")
    giant = spark.range(n).select(
        F.lit(1).alias("conv_id"), F.col("id").alias("turn"), roles.alias("role"),
        F.concat(F.lit("Message "), "id", F.when(F.col("id") % 50 == 7, "").otherwise(".")).alias("text"),
    )
    small = spark.createDataFrame([(2, 0, "user", "a" * 3_000_000 + "."), (2, 1, "assistant", "b.")], giant.schema)
    got = {r["conv_id"]: r for r in conversations.audits(giant.union(small)).collect()}
    assert got[1]["truncated"] == got[1]["cost"] / 4 == n / 50
    # Two deletions cost 4, less than a truncated row.
    assert got[1]["audit"] == ("K" * 6 + "DD" + "K" * 42) * (n // 50) or set(got[1]["audit"]) == {"D", "K"}
    kept = [
        f"{'assistant' if i % 2 else 'user'}:Message {i}." for i, edit in enumerate(got[1]["audit"]) if edit == "K"
    ]
    assert got[1]["repaired_sha256"] == hashlib.sha256("\n".join(kept).encode()).hexdigest()
    assert got[2]["audit"] == "KK"


def test_empty_table_and_lost_conversations(spark):
    nothing = spark.createDataFrame([], SCHEMA)
    assert conversations.audits(nothing).count() == conversations.repaired(nothing).count() == 0
    gone = frame(spark, [(5, 1, "user", "Hi.")]).withColumn("gone", F.lit(True))
    empty = hashlib.sha256(b"").hexdigest()
    assert [tuple(r) for r in conversations.audits(gone).collect()] == [(5, 0, 0, 0, 0, 0, 0, "", empty)]


def test_one_shuffle(spark):
    plan = conversations.audits(frame(spark, drawn(1)).coalesce(1))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 1
