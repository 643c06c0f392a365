"""Conversation repair against a search over all edits."""

import hashlib
import random
import re
import sys
import zlib
from functools import lru_cache

import pytest

from riskloom.llm import conversations as C

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def by_search(turns):
    """(cost, audit, lines) of (role, text, fault) turns by trying every edit, strings and all."""
    after = {"": "su", "s": "u", "u": "a", "a": "u"}

    @lru_cache(maxsize=None)
    def best(i, state, inserted):
        options = [(0, "", ())] if i == len(turns) and state in ("", "a") else []
        if inserted < 3:
            for letter, name in (("u", "user"), ("a", "assistant")):
                if letter in after[state]:
                    cost, audit, lines = best(i, letter, inserted + 1)
                    options.append((cost + 5, "I" + audit, (f"{name}:",) + lines))
        if i < len(turns):
            role, text, fault = turns[i]
            cost, audit, lines = best(i + 1, state, 0)
            options.append((cost + 2, "D" + audit, lines))
            if fault not in ("blank", "duplicate"):
                late = 5 * (fault == "truncated")
                if role[:1] and role[0] in after[state]:
                    cost, audit, lines = best(i + 1, role[0], 0)
                    options.append((cost + late, "K" + audit, (f"{role}:{text}",) + lines))
                for letter, name in (("u", "user"), ("a", "assistant")):
                    if letter in after[state]:
                        cost, audit, lines = best(i + 1, letter, 0)
                        options.append((cost + late + 1, "R" + audit, (f"{name}:{text}",) + lines))
        return min(options, default=(10**9, "~", ()))

    sys.setrecursionlimit(50_000)
    return best(0, "", 0)


def expected(rows):
    """The query's rows by plain loops over the whole table."""
    found = {}
    for conv in {r[0] for r in rows}:
        turns = []
        mine = [tuple(" " if v is None else v for v in r[2:]) + (r[1],) for r in rows if r[0] == conv]
        for role, text, turn in mine:
            key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
            kind = zlib.crc32(key.encode()) % 20
            text = {1: "", 2: re.sub("[.!?]", "", text)}.get(kind, text)
            role = "user" if kind == 4 else role
            turns += [(turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1].encode(), t[2].encode()))
        seen, marked = set(), []
        for _, role, text in turns:
            bare = re.sub(r"[\x20\x09-\x0D]+\Z", "", text)
            fault = ("blank" if not bare else "duplicate" if (role, text) in seen
                     else "truncated" if bare[-1] not in ".!?" else "")
            seen.add((role, text))
            marked.append((role, text, fault))
        cost, audit, lines = by_search(tuple(marked))
        known = [t[0] for t in turns if t[0] is not None]
        faults = [m[2] for m in marked]
        pairs = [a[0][:1] + b[0][:1] for a, b in zip(marked, marked[1:])]
        found[conv] = (max(known) - min(known) + 1 - len(set(known)) if known else 0,
                       *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
                       sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
                       hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return found


def repaired(df):
    rows = C.report(C.repair(C.damage(df))).collect()
    assert len(rows) == len({r.conv_id for r in rows})
    return {r.conv_id: tuple(r)[1:] for r in rows}


def some_rows(count, convs, seed):
    rng = random.Random(seed)
    roles = ["user", "assistant", "system", "tool", "User", "", None]
    said = ["Yes.", "No!", "why", "so ", "Who? ", "", " \t", None, "ü.", "a ", "x\n."]
    return [(rng.choice(convs), rng.choice([None, *range(-3, 40)]),
             rng.choices(roles, [9, 9, 2, 1, 1, 1, 1])[0], rng.choice(said) and f"{rng.choice(said)}{rng.randint(0, 9)}.")
            if rng.random() < 0.7 else
            (rng.choice(convs), rng.randint(0, 40), rng.choice(roles), rng.choice(said)) for _ in range(count)]


@pytest.mark.parametrize("seed", [1, 2])
def test_odd_turns(spark, seed):
    rows = some_rows(160, [None, 1, 2, 3, 4, *range(100, 130)], seed)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert repaired(df) == expected(rows)


@pytest.mark.parametrize("seed", [1, 7])
def test_conversation_in_many_blocks(spark, seed):
    """A conversation with most of the turns is cut into blocks and gives what the search does."""
    rows = some_rows(350, [7, 7, 7, 7, 8, 9], seed)
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        pieces = C.repair(C.damage(spark.createDataFrame(rows, SCHEMA).repartition(3)))
        assert pieces.where("conv_id = 7").count() > 4
        assert {r.conv_id: tuple(r)[1:] for r in C.report(pieces).collect()} == expected(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_equal_turns_and_dropped_conversations(spark):
    dropped = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    rows = [(5, 3, "user", "Yes.")] * 40 + [(dropped, 0, "user", "Yes.")] + [(6, None, None, None)] * 3
    got = repaired(spark.createDataFrame(rows, SCHEMA))
    assert got == expected(rows)
    assert got[dropped] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_empty_table_and_clashing_columns(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert repaired(empty) == {}
    rows = some_rows(30, [1, 2], 3)
    clash = spark.createDataFrame([(*r, 9, "x", 1, 2) for r in rows], SCHEMA + ", copies int, place string, "
                                  "block int, conv int")
    assert repaired(clash) == expected(rows)


def test_repair_gives_turns(spark):
    df = spark.createDataFrame([(1, 0, "assistant", "Hello."), (1, 1, "user", "cut off"), (1, 2, "user", "Bye.")],
                               SCHEMA)
    pieces = C.repair(df).orderBy("part", "block").collect()
    turns = [tuple(t) for p in pieces for t in p.repaired]
    cost, audit, lines = by_search((("assistant", "Hello.", ""), ("user", "cut off", "truncated"), ("user", "Bye.", "")))
    assert ([f"{r}:{t}" for r, t in turns], "".join(p.audit for p in pieces), sum(p.cost for p in pieces)) == (
        list(lines), audit, cost)


def test_long_text(spark):
    rows = [(1, 0, "user", "long " * 200_000 + "."), (1, 1, "assistant", "Yes.")]
    assert repaired(spark.createDataFrame(rows, SCHEMA)) == expected(rows)
