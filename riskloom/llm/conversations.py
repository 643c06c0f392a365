"""Repair of conversations by the cheapest edits that give ``(system) (user assistant)+``.

A conversation's turns are read in order by an automaton of four states: at the
start, after a system turn, after a user turn, after an assistant turn.  A turn
is kept, given another role or deleted, and empty turns may be inserted before
it.  Costs go backward: a vector holds, for each state, the least cost of all
that is still to come.  The walk goes forward and takes, of the edits that keep
to the least cost, the one whose initial comes first.  Vectors are stored only
at checkpoints, one each square root of the turns, and the block behind a
checkpoint is computed anew when the walk reaches it.

Turns are dealt out by ranges of (conversation, turn), not by conversation, so
one that holds a third of all turns is spread over tasks.  A conversation that
lies within one range is repaired there and then.  One that may reach into the
next range, or is longer than a task should hold, is cut into blocks.  Their
(least, plus) matrices give the checkpoint vectors behind all blocks, then each
block says where its walk ends from each state, then all blocks are walked at
once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from math import isqrt

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from riskloom.llm.common import map_batches, small_side
from riskloom.sources.storage import materialize

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5  # costs
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = (USER, USER, ASSISTANT, USER)  # where an inserted turn or one with a new role leads
KEPT = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
NAMES = {USER: "user", ASSISTANT: "assistant"}
END = (0, 2 * INSERT, INSERT, 0)  # the vector behind the last turn
FAR = 1 << 40  # more than any cost that is compared with it
BLANKS = " \t\n\v\f\r"
LEGAL = {"su", "ua", "au"}
HELD_TURNS, HELD_CHARS = 1 << 15, 1 << 24  # of a conversation that one task repairs by itself

Turn = tuple  # (turn, role, text, copies, first)

TURN_COLUMNS = ["conv_id", "turn", "role", "text", "copies"]
PIECE = ("conv_id bigint, alone boolean, part int, block bigint, low bigint, high bigint, turns bigint, first string, "
         "last string, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, "
         "repaired array<struct<role: string, text: string>>")
PIECE_COLUMNS = ["conv_id", "alone", "part", "block", "low", "high", "turns", "first", "last", "blank", "duplicate",
                 "truncated", "illegal", "cost", "audit", "repaired"]
MENDED = PIECE_COLUMNS[4:]


# ------------------------------------------------------------ the automaton
# A turn is (initial of its role, truncated), or None if it has to be deleted.

@lru_cache(maxsize=None)
def costs_before(turn: tuple | None, after: tuple) -> tuple[tuple, int]:
    """The cost vector before a turn as (vector with least 0, what was taken off)."""
    best = [DELETE + cost for cost in after]
    if turn is not None:
        initial, more = turn[0], TRUNCATED * turn[1]
        for state in range(4):
            kept = KEPT.get(initial, {}).get(state)
            if kept is not None:
                best[state] = min(best[state], KEEP + more + after[kept])
            best[state] = min(best[state], REROLE + more + after[NEXT[state]])
    user, assistant = best[USER], best[ASSISTANT]
    best[USER], best[ASSISTANT] = min(user, INSERT + assistant), min(assistant, INSERT + user)
    best[START], best[SYSTEM] = (min(best[s], INSERT + best[USER]) for s in (START, SYSTEM))
    least = min(best)
    return tuple(min(FAR, b - least) if b < FAR else FAR for b in best), least


@lru_cache(maxsize=None)
def edits(turn: tuple | None, after: tuple, state: int) -> tuple[str, int, int]:
    """The first of the tight edits at a turn: (initials, cost, state behind it)."""
    before, taken = costs_before(turn, after)
    left, initials, spent = before[state] + taken, "", 0
    while True:
        if DELETE + after[state] == left:
            return initials + "D", spent + DELETE, state
        if INSERT + before[NEXT[state]] + taken == left:
            initials, spent, state, left = initials + "I", spent + INSERT, NEXT[state], left - INSERT
            continue
        more = TRUNCATED * turn[1]
        kept = KEPT.get(turn[0], {}).get(state)
        if kept is not None and KEEP + more + after[kept] == left:
            return initials + "K", spent + KEEP + more, kept
        return initials + "R", spent + REROLE + more, NEXT[state]


def backward(turns: list, after: tuple) -> tuple[tuple, int]:
    """The vector before all ``turns`` and what was taken off it."""
    taken = 0
    for turn in reversed(turns):
        after, less = costs_before(turn, after)
        taken += less
    return after, taken


def walk(turns: list, after: tuple, state: int) -> tuple[list[str], int, int]:
    """(initials of the edits at each turn, cost, last state), checkpoints a square root apart."""
    size = isqrt(len(turns)) + 1
    blocks = range(0, len(turns), size)
    checkpoints = [after]
    for start in reversed(blocks):
        checkpoints.append(backward(turns[start:start + size], checkpoints[-1])[0])
    found, cost = [], 0
    for number, start in enumerate(blocks):
        block = turns[start:start + size]
        vectors = [checkpoints[len(blocks) - 1 - number]]
        for turn in reversed(block):
            vectors.append(costs_before(turn, vectors[-1])[0])
        for turn, behind in zip(block, reversed(vectors[:-1])):
            initials, spent, state = edits(turn, behind, state)
            found.append(initials)
            cost += spent
    return found, cost, state


def matrix(turns: list) -> list[int]:
    """Least costs from each state before the turns to each state behind them, row by row."""
    columns = []
    for to in range(4):
        vector, taken = backward(turns, tuple(0 if s == to else FAR for s in range(4)))
        columns.append([min(FAR, v + taken) for v in vector])
    return [columns[to][of] for of in range(4) for to in range(4)]


# ------------------------------------------------------------------- turns
def look(turns: list[Turn]) -> tuple[dict, list, list[tuple[str, str]]]:
    """Counts of a run of turns, what the automaton reads, and (role, text) of the same turns.

    The fifth value of a turn says whether it is the first of the conversation
    with its role and text; if it is None, the run is the whole conversation.
    """
    seen: set = set()
    counts = dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "turns"), 0)
    counts |= {"low": None, "high": None, "first": None, "last": None}
    read, said = [], []
    for turn, role, text, copies, first in turns:
        if not copies:
            continue
        if turn is not None:
            if counts["low"] is None:
                counts["low"] = turn
            counts["turns"] += turn != counts["high"]
            counts["high"] = turn
        bare = text.rstrip(BLANKS)
        first = bool(bare) and ((role, text) not in seen if first is None else first)
        seen.add((role, text))
        for copy in range(copies):
            initial = role[:1]
            if counts["last"] is None:
                counts["first"] = initial
            elif counts["last"] + initial not in LEGAL:
                counts["illegal"] += 1
            counts["last"] = initial
            said.append((role, text))
            if not bare:
                counts["blank"] += 1
                read.append(None)
            elif not first or copy:
                counts["duplicate"] += 1
                read.append(None)
            else:
                cut = bare[-1] not in ".!?"
                counts["truncated"] += cut
                read.append((initial if initial in KEPT else "", cut))
    return counts, read, said


def edited(initials: list[str], said: list[tuple[str, str]], state: int) -> list[dict]:
    """The turns that the edits give, from ``state`` on."""
    made = []
    for letters, (role, text) in zip(initials, said):
        for letter in letters:
            if letter == "K":
                made.append({"role": role, "text": text})
                state = KEPT[role[0]][state]
            elif letter in "IR":
                state = NEXT[state]
                made.append({"role": NAMES[state], "text": text if letter == "R" else ""})
    return made


def mend(turns: list[Turn], after: tuple, state: int, last: bool) -> dict:
    """Counts, edits and what they give for a run of turns that starts in ``state``."""
    counts, read, said = look(turns)
    initials, cost, reached = walk(read, after, state)
    repaired = edited(initials, said, state)
    while last and END[reached]:
        initials.append("I")
        cost, reached = cost + INSERT, NEXT[reached]
        repaired.append({"role": NAMES[reached], "text": ""})
    return {**counts, "cost": cost, "audit": "".join(initials), "repaired": repaired}


# --------------------------------------------------------------- operators
def damage(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies): turns damaged by a checksum of conversation and turn.

    Nulls are one space, in the checksum as in role and text.  The checksum
    modulo 20 says what is done: 0 drops the turn (no copies), 1 empties its
    text, 2 takes out its stops, 3 doubles it, 4 makes it the user's.
    """
    def said(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.crc32(F.encode(F.concat(said("conv_id"), F.lit(":"), said("turn")), "UTF-8")) % 20
    text = said("text")
    return conversations.select("conv_id", "turn", said("role").alias("role"), text.alias("text"),
                                kind.alias("kind")).select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", ""))
        .otherwise(F.col("text")).alias("text"),
        F.when(F.col("kind") == 0, 0).when(F.col("kind") == 3, 2).otherwise(1).alias("copies"))


def repair(conversations: DataFrame) -> DataFrame:
    """The repaired conversations, in one piece or several: the columns of ``PIECE``, stored.

    A conversation is ``alone`` in its piece, or its pieces follow one another
    by (part, block); ``repaired``
    is a piece's turns, ``audit`` the initials of its edits (Delete, Insert,
    Keep, Rerole), ``low``, ``high`` and ``turns`` the least, largest and number
    of distinct turn numbers.  Turns are ordered by number, nulls first, then
    by role and text; ``copies`` (1 without such a column) repeats a turn in
    place, 0 leaves the conversation without it.  A turn that is blank, or has
    the role and text of an earlier one, is deleted.  Roles and texts that are
    null count as one space, conversations without id as one conversation.  A
    conversation without turns has one piece without anything in it.
    """
    blank = F.lit(" ")
    copies = F.coalesce("copies", F.lit(1)) if "copies" in conversations.columns else F.lit(1)
    rows = conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
        F.coalesce("role", blank).alias("role"), F.coalesce("text", blank).alias("text"),
        copies.cast("int").alias("copies"))
    order = ["conv_id", "turn", "role", "head", "rest"]
    # equal rows are parted by number, so that not even they have to be in one task
    ranged = (rows.withColumns({"head": F.left("text", F.lit(40)), "rest": F.xxhash64("text"),
                                "number": F.monotonically_increasing_id()})
              .repartitionByRange(*order, "number").sortWithinPartitions(*order)
              .select(*TURN_COLUMNS))
    read = materialize(map_batches(ranged, _whole_or_open, f"{PIECE}, turn bigint, role string, text string, "
                                   "copies int", streaming=True))
    whole = read.where("alone").select(*PIECE_COLUMNS)
    return whole.unionByName(_mend_open(read.where("not alone").select(
        "part", F.col("block").alias("place"), *TURN_COLUMNS)))


_NONE = object()  # no conversation yet


def _whole_or_open(batches: Iterator[dict]) -> Iterator[dict]:
    """Conversations inside a range repaired, turns of others as they are with their place.

    The first and the last conversation of a range may go on in another one.
    """
    part, place = TaskContext.get().partitionId(), 0
    held: list[Turn] = []
    done: list[dict] = []
    now, chars, opened = _NONE, 0, True

    def open_rows() -> dict:
        nonlocal place
        made = {name: [None] * len(held) for name in PIECE_COLUMNS}
        made |= {"conv_id": [now] * len(held), "alone": [False] * len(held), "part": [part] * len(held),
                 "block": list(range(place, place + len(held)))}
        place += len(held)
        return made | {name: [turn[i] for turn in held] for i, name in enumerate(TURN_COLUMNS[1:])}

    def whole_rows() -> dict:
        made = {name: [d[name] for d in done] for name in PIECE_COLUMNS}
        return made | {name: [None] * len(done) for name in TURN_COLUMNS[1:]}

    for batch in batches:
        for conv, turn, role, text, copies in zip(*(batch[name] for name in TURN_COLUMNS)):
            if conv != now:
                if held and opened:
                    yield open_rows()
                elif held:
                    done.append({"conv_id": now, "alone": True, "part": part, "block": 0,
                                 **mend(held, END, START, True)})
                opened, held, chars, now = now is _NONE, [], 0, conv
            held.append((turn, role, text, copies, None))
            chars += len(text)
            if len(held) >= HELD_TURNS or chars >= HELD_CHARS:
                yield open_rows()
                held, chars, opened = [], 0, True
        if done:
            yield whole_rows()
            done.clear()
    if held:
        yield open_rows()


def _mend_open(turns: DataFrame) -> DataFrame:
    """Pieces of conversations whose turns lie in several ranges, one piece for each block.

    Blocks of a range get longer one by one, so both their number and their
    length go with the square root of its turns.  What is collected in one place
    is a block's turns, or a conversation's blocks without them.
    """
    conv = F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("conv")
    numbered = turns.select(conv, "*", F.floor(F.sqrt(F.col("place") / 32)).alias("block"))
    words = F.sha2(F.concat_ws(":", F.length("role"), "role", "text"), 256)
    at = F.struct("part", "place")
    first = (numbered.where(F.col("copies") > 0).groupBy("conv", words.alias("words"))
             .agg(F.min(at).alias("at")).select("conv", "at.part", "at.place", F.lit(True).alias("first")))
    marked = numbered.join(first, ["conv", "part", "place"], "left").fillna(False, ["first"])
    fields = ("place", "turn", "role", "text", "copies", "first")
    blocks = materialize(marked.groupBy("conv", "part", "block").agg(
        F.first("conv_id").alias("conv_id"), F.sort_array(F.collect_list(F.struct(*fields))).alias("run")))
    key = ["conv", "part", "block"]

    def matrices(batch):
        yield {k: batch[k] for k in key} | {"matrix": [matrix(look(_turns(run))[1]) for run in batch["run"]]}

    made = map_batches(blocks, matrices, "conv string, part int, block bigint, matrix array<bigint>", [*key, "run"])
    ends = materialize(made.groupBy("conv").applyInPandas(
        _vectors_behind, "conv string, part int, block bigint, behind array<bigint>, last boolean"))

    def leads(batch):
        yield {k: batch[k] for k in key} | {"leads": [
            [walk(look(_turns(run))[1], tuple(behind), state)[2] for state in range(4)]
            for run, behind in zip(batch["run"], batch["behind"])]}

    ended = blocks.join(small_side(ends), key)
    led = map_batches(ended, leads, "conv string, part int, block bigint, leads array<int>", [*key, "run", "behind"])
    starts = led.groupBy("conv").applyInPandas(_states_before, "conv string, part int, block bigint, state int")
    placed = ended.join(small_side(starts), key)

    def pieces(batch):
        found = [mend(_turns(run), tuple(behind), state, last) for run, behind, state, last in
                 zip(batch["run"], batch["behind"], batch["state"], batch["last"])]
        yield {k: batch[k] for k in ("conv_id", "part", "block")} | {"alone": [False] * len(found)} | {
            name: [f[name] for f in found] for name in MENDED}

    return materialize(map_batches(placed, pieces, PIECE, ["conv_id", "part", "block", "run", "behind", "state", "last"]))


def _turns(run: list[dict]) -> list[Turn]:
    return [(r["turn"], r["role"], r["text"], r["copies"], r["first"]) for r in run]


def _vectors_behind(blocks: pd.DataFrame) -> pd.DataFrame:
    """The checkpoint vector behind every block of a conversation, from its end on."""
    blocks = blocks.sort_values(["part", "block"], ignore_index=True)
    vector, found = END, []
    for costs in reversed(blocks["matrix"].tolist()):
        found.append(list(vector))
        vector = [min(FAR, min(costs[4 * of + to] + vector[to] for to in range(4))) for of in range(4)]
        vector = tuple(int(v - min(vector)) if v < FAR else FAR for v in vector)
    last = [False] * (len(blocks) - 1) + [True]
    return blocks[["conv", "part", "block"]].assign(behind=found[::-1], last=last)


def _states_before(blocks: pd.DataFrame) -> pd.DataFrame:
    """The state in which the walk reaches every block."""
    blocks = blocks.sort_values(["part", "block"], ignore_index=True)
    state, found = START, []
    for leads in blocks["leads"]:
        found.append(state)
        state = int(leads[state])
    return blocks[["conv", "part", "block"]].assign(state=found)


REPORT = ("conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, "
          "cost bigint, audit string, repaired_sha256 string")
SUMMED = ("blank", "duplicate", "truncated", "illegal", "cost")


def report(pieces: DataFrame) -> DataFrame:
    """One row per conversation: counts, cost, audit and the digest of what ``repair`` gave.

    ``gaps`` is the number of turn numbers missing between the least and the
    largest; ``illegal`` the neighbouring turns whose initials don't follow one
    another.  The digest is that of ``role:text`` lines.  A conversation in one
    piece is a projection.  The pieces of another are read in order by one task
    and not held, since a digest has to see the whole in order.
    """
    lines = F.transform("repaired", lambda turn: F.concat(turn["role"], F.lit(":"), turn["text"]))
    gaps = F.coalesce(F.col("high") - F.col("low") + 1 - F.col("turns"), F.lit(0).cast("bigint"))
    alone = pieces.where("alone").select(
        "conv_id", gaps.alias("gaps"), *SUMMED, "audit", F.sha2(F.concat_ws("\n", lines), 256).alias("repaired_sha256"))
    ordered = pieces.where("not alone").repartition("conv_id").sortWithinPartitions("conv_id", "part", "block")
    return alone.unionByName(map_batches(ordered, _put_together, REPORT, PIECE_COLUMNS, streaming=True))


class _Whole:
    """What has been read of one conversation's pieces."""

    def __init__(self, conv_id):
        self.conv_id, self.sums, self.audit = conv_id, dict.fromkeys(SUMMED, 0), []
        self.low = self.high = self.last = None
        self.turns, self.empty, self.digest = 0, True, hashlib.sha256()

    def add(self, piece: dict) -> None:
        for name in SUMMED:
            self.sums[name] += piece[name]
        if piece["low"] is not None:
            self.low = piece["low"] if self.low is None else self.low
            self.turns += piece["turns"] - (piece["low"] == self.high)
            self.high = piece["high"]
        if piece["last"] is not None:
            self.sums["illegal"] += self.last is not None and self.last + piece["first"] not in LEGAL
            self.last = piece["last"]
        self.audit.append(piece["audit"])
        for turn in piece["repaired"]:
            self.digest.update(("" if self.empty else "\n").encode() + f"{turn['role']}:{turn['text']}".encode())
            self.empty = False

    def row(self) -> dict:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return {"conv_id": [self.conv_id], "gaps": [gaps], **{name: [n] for name, n in self.sums.items()},
                "audit": ["".join(self.audit)], "repaired_sha256": [self.digest.hexdigest()]}


def _put_together(batches: Iterator[dict]) -> Iterator[dict]:
    whole = None
    for batch in batches:
        for values in zip(*batch.values()):
            piece = dict(zip(batch, values))
            if whole is None or whole.conv_id != piece["conv_id"]:
                if whole is not None:
                    yield whole.row()
                whole = _Whole(piece["conv_id"])
            whole.add(piece)
    if whole is not None:
        yield whole.row()
