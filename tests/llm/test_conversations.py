import hashlib
import itertools
import random
import re
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tradewind.llm import conversations
from tradewind.llm.conversations import BLANK, CLEAN, CUT, DUPLICATE, ENDS, START, Bounds, Row, audited, damaged, repair, repaired

SCHEMA = "conv_id long, turn long, role string, text string"
PATTERN = re.compile(r"(s?(ua)+)?")
NEXT = {"": "u", "s": "u", "a": "u", "u": "a"}


def fits(initials):
    return PATTERN.fullmatch("".join(initials)) is not None


def brute(rows):
    """Every way of keeping, changing and deleting rows with up to two insertions at every place: least (cost, audit)."""
    best = None
    for fates in itertools.product("KRD", repeat=len(rows)):
        if any(f != "D" and r.fault in (BLANK, DUPLICATE) for f, r in zip(fates, rows)):
            continue
        for inserts in itertools.product(range(3), repeat=len(rows) + 1):
            audit, said, cost = "", [], 2 * sum(inserts)
            for i in range(len(rows) + 1):
                for _ in range(inserts[i]):
                    said.append(NEXT.get(said[-1] if said else "", "?"))
                audit += "I" * inserts[i]
                if i < len(rows):
                    audit += fates[i]
                    cost += {"K": 0, "R": 2, "D": 3}[fates[i]] + (rows[i].fault == CUT and fates[i] != "D")
                    if fates[i] == "K":
                        said.append(rows[i].initial or "?")
                    elif fates[i] == "R":
                        said.append(NEXT.get(said[-1] if said else "", "?"))
            if fits(said) and (best is None or (cost, audit) < best):
                best = (cost, audit)
    return best


def by_state(rows, start=START, ends=ENDS):
    """Least (cost, audit) row by row for each last state: the same answer for long conversations."""
    following = {0: 2, 1: 2, 2: 3, 3: 2}

    def add(found, state, cost, audit):
        found[state] = min(found.get(state, (cost, audit)), (cost, audit))

    def filled(found):
        for _ in range(3):
            for state, (cost, audit) in list(found.items()):
                add(found, following[state], cost + 2, audit + "I")
        return found

    now = filled({start: (0, "")})
    for initial, fault in rows:
        found = {}
        for state, (cost, audit) in now.items():
            add(found, state, cost + 3, audit + "D")
            if fault in (CLEAN, CUT):
                add(found, following[state], cost + 2 + (fault == CUT), audit + "R")
                kept = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}.get(initial, {}).get(state)
                if kept is not None:
                    add(found, kept, cost + (fault == CUT), audit + "K")
        now = filled(found)
    return min((now[e] for e in ends if e in now), default=None)


row = st.builds(Row, st.sampled_from(["s", "u", "a", "x", ""]), st.sampled_from([CLEAN, CLEAN, CUT, BLANK, DUPLICATE]))


@settings(deadline=None, max_examples=25)
@given(st.lists(row, max_size=3))
def test_least_cost_and_audit_of_all_edits(rows):
    assert repair(rows)[:2] == brute(rows) == by_state(rows)


@settings(deadline=None, max_examples=300)
@given(st.lists(row, max_size=40), st.integers(0, 3), st.sampled_from([ENDS, *[frozenset({e}) for e in range(4)]]))
def test_long_runs_between_any_states(rows, start, ends):
    found = repair(rows, start, ends)
    assert (found and found[:2]) == by_state(rows, start, ends)
    bound = Bounds(rows, ends)
    for i in range(len(rows) + 1):
        for state in range(4):
            rest = by_state(rows[i:], state, ends)
            assert rest is None or bound(i, state) <= rest[0]


def expected(rows, ids=None):
    """The contract in plain Python, one dictionary entry per conversation."""
    out = {}
    for conv_id in {r[0] for r in rows} | set(ids or ()):
        turns = [(t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows if c == conv_id]
        turns.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, faults = set(), []
        for _, role, text in turns:
            solid = re.sub(r"[\x20\x09-\x0D]", "", text)
            fault = BLANK if not solid else DUPLICATE if (role, text) in seen else CLEAN if solid[-1] in ".!?" else CUT
            seen.add((role, text))
            faults.append(fault)
        initials = [r[1][:1] for r in turns]
        cost, audit = by_state(list(zip(initials, faults)))
        said, rest = [], iter(turns)
        for edit in audit:
            role, text = ("", "") if edit == "I" else next(rest)[1:]
            if edit in "RI":
                role = {"u": "user", "a": "assistant"}[NEXT[said[-1][:1] if said else ""]]
            if edit != "D":
                said.append(f"{role}:{text}")
        numbers = {t for t, _, _ in turns if t is not None}
        gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        counts = [faults.count(f) for f in (BLANK, DUPLICATE, CUT)]
        out[conv_id] = (gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(said).encode()).hexdigest())
    return out


def found(df):
    return {r["conv_id"]: tuple(r)[1:] for r in df.collect()}


def made(n, seed):
    rng = random.Random(seed)
    texts = ["Yes.", "No!", "half a", "", " \t", None, "What?  ", "Yes.", "é.", "a\nb."]
    return [(rng.randint(0, 40), rng.randint(0, n), rng.choice(["user", "assistant", "system", "tool", None, "", "Über"]), rng.choice(texts)) for _ in range(n)]


def test_against_plain_python(spark):
    rows = made(300, 1) + [(None, 3, "user", "no id"), (None, None, "assistant", "no turn."), (7, None, "user", "first."), (7, None, "user", "first.")]
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("place", F.lit("clash")).withColumn("kind", F.lit(9))
    assert found(audited(docs)) == expected(rows)


def test_conversations_of_many_blocks_and_tasks(spark):
    rows = made(400, 2) + [(99, i % 700, r, f"{x} {i}") for i, (_, _, r, x) in enumerate(made(1500, 3))] + [(100, 1, "user", "same.")] * 1200
    docs = spark.createDataFrame(rows, SCHEMA).repartition(7)
    parts = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert found(audited(docs)) == expected(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", parts)


def test_blocks_joined_give_the_whole():
    """Pieces of eight rows put together, without Spark, against one search over all rows."""
    rng = random.Random(5)
    for n in (1, 7, 8, 9, 64, 100):
        rows = [Row(rng.choice("uasx"), rng.choice([CLEAN, CLEAN, CUT, BLANK])) for _ in range(n)]
        joined = conversations._Joined(1)
        for at in range(0, n, 8):
            run = [(at + i, 1, at + i, r.initial, r.fault) for i, r in enumerate(rows[at : at + 8])]
            conv, place, low, high, turns, first, last, *rest = conversations._piece(run, at > 0, True)
            joined.add(place, low, high, turns, first, last, *rest)
        total, *parts = joined.plan()
        assert (total[-1], total[4]) == by_state(rows)
        assert "".join(p[4] for p in reversed(parts)) == total[4]
        assert total[5] == 0


def test_repaired_rows_follow_the_pattern(spark):
    rows = made(300, 4)
    out = repaired(spark.createDataFrame(rows, SCHEMA)).collect()
    want = expected(rows)
    for conv_id, values in want.items():
        said = sorted((r["number"], r["role"], r["text"], r["edit"]) for r in out if r["conv_id"] == conv_id)
        assert fits([r[1][:1] for r in said]) and [r[0] for r in said] == list(range(1, len(said) + 1))
        assert hashlib.sha256("\n".join(f"{r}:{t}" for _, r, t, _ in said).encode()).hexdigest() == values[-1]
        assert "".join(r[3] for r in said) == values[-2].replace("D", "")


def test_damage(spark):
    rows = [(c, t, r, x) for c in (*range(12), None) for t in (*range(8), None) for r, x in [("assistant", "A. b? c!"), (None, None)]]
    want = []
    for c, t, r, x in rows:
        k = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        r, x = " " if r is None else r, " " if x is None else x
        kept = (c, t, "user" if k == 4 else r, "" if k == 1 else re.sub("[.!?]", "", x) if k == 2 else x)
        want += [kept] * (0 if k == 0 else 2 if k == 3 else 1)
    key = lambda r: [(v is not None, v) for v in r]
    assert sorted([tuple(r) for r in damaged(spark.createDataFrame(rows, SCHEMA)).collect()], key=key) == sorted(want, key=key)
    assert len(want) != len(rows)


def test_conversations_without_rows_and_empty_tables(spark):
    rows = [(1, 0, "user", "Hi."), (1, 2, "assistant", "Yes.")]
    ids = spark.createDataFrame([(1,), (2,), (None,), (2,)], "conv_id long")
    assert found(audited(spark.createDataFrame(rows, SCHEMA), ids)) == expected(rows, [2, None])
    empty = spark.createDataFrame([], SCHEMA)
    assert audited(empty).collect() == [] and repaired(empty).collect() == [] and damaged(empty).collect() == []


def test_a_long_conversation_with_system_rows_is_searched_quickly():
    rng = random.Random(6)
    rows = [Row(rng.choice("suaxs"), rng.choice([CLEAN, CLEAN, CUT, BLANK])) for _ in range(512)]
    assert repair(rows)[:2] == by_state(rows)
