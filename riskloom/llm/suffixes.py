"""Removal of repeated byte strings by bucket-pointer refinement of sampled suffixes.

Every string of ``LENGTH`` bytes is represented by one of its q-grams: the one
with the least hash, which equal strings have at the same place.  Suffixes at
these places fall into initial q-gram buckets.  A bucket is refined by the
bucket identifiers of later offsets: a run of strings with one representative
is told from others by the q-grams q and more bytes on, and, where runs of a
bucket differ, each string by the pair of its q-gram and the one q bytes on.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window, functions as F

from riskloom.llm.common import identified, map_batches, small_side
from riskloom.llm.shingles import mix
from riskloom.llm.spans import collected, merged, unpacked, without
from riskloom.sources.storage import materialize, scratch

Q = 50
LENGTH = 2 * Q  # two q-grams make a string, so a pair of identifiers tells it
STEP = 1 << 17  # strings of a document that are looked at together, few enough for a core's cache
PLACE_BITS = 21  # of the least-hash search, enough for the places of a buffer

_random = np.random.default_rng(2024)
BYTE_VALUES = _random.integers(0, 2**64, 256, dtype=np.uint64)
BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(int(BASE), -1, 2**64))
_POWERS: list[np.ndarray] = []


def powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64, made once per worker."""
    if not _POWERS:
        for base in (BASE, INVERSE):
            steps = np.full(1 << PLACE_BITS, base, np.uint64)
            steps[0] = 1
            _POWERS.append(np.multiply.accumulate(steps))
    return _POWERS[0], _POWERS[1]


class Buffer:
    """Parts of documents side by side, with the q-gram identifier at every place."""

    def __init__(self, parts: list[tuple[int, int, bytes]]):
        data = np.frombuffer(b"".join(p[2] for p in parts), np.uint8)
        sizes = np.array([len(p[2]) for p in parts])
        starts = np.cumsum(sizes) - sizes
        n = len(data)
        self._owners = np.array([p[0] for p in parts])
        self._moved = np.array([p[1] for p in parts]) - starts
        self.part = np.repeat(np.arange(len(parts), dtype=np.int32), sizes)
        power, inverse = powers()
        values = BYTE_VALUES[data]
        values *= power[:n]
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(values, out=total[1:])
        grams = total[Q:] - total[:-Q]
        grams *= inverse[:n - Q + 1]
        self.gram = mix(grams)

    @property
    def place(self) -> np.ndarray:
        """Of every byte in its document."""
        return self.places(np.arange(len(self.part)))

    def places(self, at: np.ndarray) -> np.ndarray:
        """Where each of ``at`` is in its document."""
        return at + self._moved[self.part[at]]

    def owners(self, at: np.ndarray) -> np.ndarray:
        """The number of the document that holds each of ``at``."""
        return self._owners[self.part[at]]

    def strings(self) -> np.ndarray:
        """Where a string of ``LENGTH`` bytes starts that stays within its part."""
        return np.flatnonzero(self.part[:-LENGTH + 1] == self.part[LENGTH - 1:])

    def runs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """First and last string of each run with one representative; bucket and run identifier."""
        mask = np.uint64((1 << PLACE_BITS) - 1)
        least = (self.gram & ~mask) | np.arange(len(self.gram), dtype=np.uint64)
        width = 1
        while 2 * width <= Q + 1:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        least = np.minimum(least[:len(least) - (Q + 1 - width)], least[Q + 1 - width:])
        at = self.strings()
        if not len(at):
            return at, at, at.view(np.uint64), at.view(np.uint64)
        chosen = (least[at] & mask).astype(np.int64)
        new = np.r_[True, (chosen[1:] != chosen[:-1]) | (at[1:] != at[:-1] + 1)]
        first = np.flatnonzero(new)
        low, high = at[first], at[np.r_[first[1:], len(at)] - 1]
        run = mix(mix(mix(self.gram[low]) + self.gram[low + Q]) + self.gram[high + Q])
        return low, high, self.gram[chosen[first]], run + (high - low).astype(np.uint64)


def buffers(documents: list[bytes], ranges: list[list[tuple[int, int]]] | None = None) -> Iterator[Buffer]:
    """All strings of ``documents``, each in one buffer of bounded size; of their ``ranges`` only, if given."""
    parts, size = [], 0
    for i, data in enumerate(documents):
        for first, last in [(0, len(data))] if ranges is None else ranges[i]:
            for at in range(first, max(first, last - LENGTH + 1), STEP):
                part = data[at:min(at + STEP + LENGTH - 1, last)]
                parts.append((i, at, part))
                size += len(part)
                if size >= STEP:
                    yield Buffer(parts)
                    parts, size = [], 0
    if parts:
        yield Buffer(parts)


def string_runs(docs: DataFrame) -> DataFrame:
    """(bucket, run, doc_id, low, span): the runs of strings of all documents."""
    def rows(batch):
        ids = np.array(batch["doc_id"], np.int64)
        for b in buffers([t.encode() for t in batch["text"]]):
            low, high, bucket, run = b.runs()
            yield {"bucket": bucket.view(np.int64), "run": run.view(np.int64), "doc_id": ids[b.owners(low)],
                   "low": b.places(low), "span": (high - low).astype(np.int32)}

    return map_batches(docs, rows, "bucket bigint, run bigint, doc_id bigint, low bigint, span int")


def refined(runs: DataFrame) -> DataFrame:
    """Runs of buckets with several members: (doc_id, low, span, repeated).

    ``repeated`` runs equal an earlier one as a whole.  The others are first of
    their kind in a bucket where runs differ, so parts of them may be repeated.
    """
    inside = Window.partitionBy("bucket").orderBy("run", "doc_id", "low")
    bucket = inside.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    repeated = F.coalesce(F.lag("run").over(inside) == F.col("run"), F.lit(False))
    return (runs.select("doc_id", "low", "span", repeated.alias("repeated"),
                        (F.min("run").over(bucket) != F.max("run").over(bucket)).alias("differ"))
            .where("repeated or differ").drop("differ"))


def single_strings(docs: DataFrame, open_runs: DataFrame) -> DataFrame:
    """(doc_id, low) of strings in ``open_runs`` of which an earlier copy exists."""
    listed = open_runs.groupBy("doc_id").agg(collected("low", "end").alias("runs"))
    wanted = docs.join(small_side(listed), "doc_id")

    def rows(batch):
        ids = np.array(batch["doc_id"], np.int64)
        # a run with the one that starts where it stops: each string is in one of the ranges
        ranges = [[(a, b + LENGTH - 1) for a, b in merged([(a, b) for a, b, _ in unpacked(runs)])]
                  for runs in batch["runs"]]
        for b in buffers([t.encode() for t in batch["text"]], ranges):
            at = b.strings()
            yield {"here": b.gram[at].view(np.int64), "later": b.gram[at + Q].view(np.int64),
                   "doc_id": ids[b.owners(at)], "low": b.places(at)}

    pairs = map_batches(wanted, rows, "here bigint, later bigint, doc_id bigint, low bigint",
                        ["doc_id", "text", "runs"])
    number = F.row_number().over(Window.partitionBy("here", "later").orderBy("doc_id", "low"))
    return pairs.withColumn("number", number).where("number > 1").select("doc_id", "low")


def islands(spans: DataFrame) -> DataFrame:
    """Overlapping and touching spans of a document joined into maximal ones."""
    before = Window.partitionBy("doc_id").orderBy("start", "end")
    reached = F.max("end").over(before.rowsBetween(Window.unboundedPreceding, -1))
    new = F.coalesce(F.col("start") > F.col("reached"), F.lit(True)).cast("int")
    return (spans.withColumn("reached", reached).withColumn("island", F.sum(new).over(before))
            .groupBy("doc_id", "island").agg(F.min("start").alias("start"), F.max("end").alias("end"))
            .drop("island"))


def repeated_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, start, end), maximal, of the bytes of strings that also start earlier."""
    found = materialize(refined(string_runs(docs)))
    whole = found.where("repeated").select("doc_id", F.col("low").alias("start"),
                                           (F.col("low") + F.col("span") + LENGTH).alias("end"))
    single = single_strings(docs, found.where("not repeated").withColumn("end", F.expr("low + span + 1")))
    return islands(whole.unionByName(
        single.select("doc_id", F.col("low").alias("start"), (F.col("low") + LENGTH).alias("end"))))


def remove_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, kept binary, n_bytes, n_removed, n_spans), one row per document.

    A byte goes if a string of ``LENGTH`` bytes covers it that also starts
    earlier: in a document with a smaller id, or before in the same one.  Texts
    that are null count as empty; shorter texts than ``LENGTH`` stay whole.
    Rows without id and repeated ids: see ``identified``.  Strings are compared
    by 128 bits of hash.
    """
    known = identified(docs)
    with scratch(docs.sparkSession) as keep:
        spans = keep(repeated_spans(known))
    listed = spans.groupBy("doc_id").agg(collected("start", "end").alias("spans"))
    joined = known.join(small_side(listed), "doc_id", "left")

    def rows(batch):
        made = {"doc_id": batch["doc_id"], "kept": [], "n_bytes": [], "n_removed": [], "n_spans": []}
        for text, spans in zip(batch["text"], batch["spans"]):
            data, runs = text.encode(), merged([(a, b) for a, b, _ in unpacked(spans)])
            made["kept"].append(without(data, runs))
            made["n_bytes"].append(len(data))
            made["n_removed"].append(sum(b - a for a, b in runs))
            made["n_spans"].append(len(runs))
        yield made

    return map_batches(joined, rows, "doc_id bigint, kept binary, n_bytes bigint, n_removed bigint, n_spans bigint")
