"""Repair of conversations against a search over all edits."""

import hashlib
import heapq
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from tillscope.llm import dialogues
from tillscope.llm.queries import QUERIES

WHITE = " \t\n\x0b\x0c\r"
NEXT = {"": "su", "s": "u", "u": "a", "a": "u"}


def order(row):
    turn, role, text = row
    return (turn is not None, turn or 0, role.encode(), text.encode())


def brute(rows):
    """Row of the contract for one conversation's rows (turn, role, text) after damage."""
    rows = sorted(rows, key=order)
    seen, faults = set(), []
    for _, role, text in rows:
        core = text.rstrip(WHITE)
        if not core:
            faults.append("blank")
        elif (role, text) in seen:
            faults.append("duplicate")
        elif core[-1] not in ".!?":
            faults.append("truncated")
        else:
            faults.append(None)
        seen.add((role, text))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    initials = [r[:1] for _, r, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    # Uniform-cost search over (rows read, last initial), audit strings as the second key.
    queue, done = [(0, "", 0, "", ())], set()
    while queue:
        cost, audit, at, last, left = heapq.heappop(queue)
        if at == len(rows) and last in ("", "a"):
            break
        if (at, last) in done:
            continue
        done.add((at, last))
        for letter in NEXT[last].replace("s", ""):
            role = {"u": "user", "a": "assistant"}[letter]
            heapq.heappush(queue, (cost + 3, audit + "I", at, letter, (*left, f"{role}:")))
        if at < len(rows):
            _, role, text = rows[at]
            heapq.heappush(queue, (cost + 4, audit + "D", at + 1, last, left))
            if faults[at] in (None, "truncated"):
                extra = 3 if faults[at] else 0
                if role[:1] and role[0] in NEXT[last]:
                    heapq.heappush(queue, (cost + extra, audit + "K", at + 1, role[0], (*left, f"{role}:{text}")))
                for letter in NEXT[last].replace("s", ""):
                    new = {"u": "user", "a": "assistant"}[letter]
                    heapq.heappush(queue, (cost + extra + 3, audit + "R", at + 1, letter, (*left, f"{new}:{text}")))
    counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
    return (gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(left).encode()).hexdigest()), left


def damaged(rows):
    out = {}
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(key.encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        out.setdefault(conv, []).extend([(turn, role, text)] * {0: 0, 3: 2}.get(kind, 1))
    return out


COLUMNS = "gaps blank duplicate truncated illegal cost audit repaired_sha256".split()


def check(got, want):
    assert len(got) == len(want)
    for r in got:
        assert tuple(r[c] for c in COLUMNS) == brute(want[r.conv_id])[0], (r, sorted(want[r.conv_id], key=order))


def made(spark, rows):
    clash = "key code absent role_x cost audit gaps".split()
    schema = "conv_id long, turn long, role string, text string, " + ", ".join(f"`{c}` string" for c in clash)
    return spark.createDataFrame([(*r, *["x"] * len(clash)) for r in rows], schema)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "umbrella", "", None, "User"]
    texts = ["Yes.", "No!", "What?", "cut", " ", "", None, "a. ", "b.\n\t", "c.\xa0", "é", "x" * 3000 + "."]
    out = []
    for conv in range(400):
        for _ in range(rng.choice([1, 2, 3, 4, 6, 9])):
            turn = rng.choice([None, 0, 1, 2, 3, 4, 5, 6, 7, 30, -2])
            out.append((conv, turn, rng.choice(roles), rng.choice(texts)))
    out += out[:60]  # repeated rows
    out += [(None, t, rng.choice(roles), rng.choice(texts)) for t in range(12)]
    out += [(1000, t, rng.choice(roles), rng.choice(texts) if t % 3 else f"{t}.") for t in range(700)]  # a giant one
    return out


@pytest.mark.parametrize("spill", [100_000, 5])
def test_against_a_search_over_all_edits(spark, rows, spill, monkeypatch):
    """Also with Arrow batches of seven rows and conversations that go to a file."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        out = dialogues.repair(dialogues.damage(made(spark, rows)), present=F.col("present"), spill=spill).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    check(out, damaged(rows))


def test_conversation_without_rows(spark):
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    out = dialogues.repair(dialogues.damage(made(spark, [(gone, 0, "user", "Hi.")])), present=F.col("present")).collect()
    assert [tuple(r) for r in out] == [(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    assert dialogues.repair(made(spark, [])).collect() == []


def test_turns_are_what_the_digest_covers(spark, rows):
    mine = dialogues.damage(made(spark, rows[:900]))
    left = {}
    for r in dialogues.repaired_turns(mine, present=F.col("present"), spill=5).orderBy("conv_id", "place").collect():
        left.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    for conv, after in damaged(rows[:900]).items():
        assert tuple(left.get(conv, ())) == brute(after)[1]


def test_query_over_the_given_table(spark, sf):
    given = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    check(QUERIES["op13_dialogue_repair"](spark, sf).collect(), damaged(given))


def test_one_exchange(spark, sf):
    plan = QUERIES["op13_dialogue_repair"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
