"""Substring dedup by MinHash bands over paragraphs.

A line is a paragraph.  Longer lines are also cut at places that only the words
around them choose, so a passage inside a longer line gives the same pieces
wherever it stands.  Whole lines get bands tuned for high recall and link by
exact Jaccard similarity; pieces link when they are equal.

The rest without lines that are only similar is also read as words without lines, and
strings of it that are repeated go as far as they reach to both sides, so a
passage goes wherever it stands in a line and however it is wrapped.  A changed
word in it stays, unless its line is like another one.
"""

from __future__ import annotations

import re
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from riskloom.llm import suffixes
from riskloom.llm.common import identified, map_batches, small_side
from riskloom.llm.links import linked_components, shared_only
from riskloom.llm.shingles import WIDTH, hashes_of_words, mix, shingles_of, windows, word_hashes, words_in  # noqa: F401
from riskloom.llm.spans import collected, merged, unpacked, without
from riskloom.sources.storage import materialize, scratch

THRESHOLD = 75
RECALL = 0.99
REACH = 6  # a line is cut before a word whose hash is the least among so many on either side
WORD = re.compile(rb"[^\x20\x09-\x0D]+")
BLANKS = re.compile(rb"[\x20\x09\x0B-\x0D]*")


def tune_bands(threshold: float, recall: float, background: float = 0.1,
               cost_of_candidate: float = 10.0) -> tuple[int, int]:
    """(bands, rows) of least cost that finds pairs at ``threshold`` with ``recall``.

    The cost counts a row per band and ``cost_of_candidate`` for each collision
    of a pair with the similarity ``background``.
    """
    def least_bands(rows: int) -> int:
        return int(np.ceil(np.log(1 - recall) / np.log(1 - threshold ** rows)))

    def cost(rows: int) -> float:
        bands = least_bands(rows)
        return bands + cost_of_candidate * (1 - (1 - background ** rows) ** bands) * bands

    rows = min(range(1, 9), key=cost)
    return least_bands(rows), rows


BANDS, ROWS = tune_bands(THRESHOLD / 100, RECALL)


class Lines:
    """The lines of a batch of texts with at least so many words, and all their words in a row."""

    def __init__(self, texts: list[str], least: int = WIDTH, fold: bool = True):
        encoded = [text.encode() for text in texts]
        data = b"\n".join([*encoded, b""])  # every text ends with a line feed, and so does its last line
        data = data.lower() if fold else data
        size = np.fromiter(map(len, encoded), np.int64, len(encoded))
        origin = np.cumsum(size + 1) - size - 1
        begin, stop = words_in(data)
        feeds = np.flatnonzero(np.frombuffer(data, np.uint8) == ord("\n"))
        before = np.searchsorted(begin, feeds)
        count = np.diff(before, prepend=0)
        line = np.flatnonzero(count >= least)
        start = np.r_[0, feeds[:-1] + 1][line]
        self.doc = np.searchsorted(origin, start, "right") - 1
        self.start = start - origin[self.doc]
        self.end = np.minimum(feeds[line] + 1 - origin[self.doc], size[self.doc])
        self.count = count[line]
        kept = np.repeat(count >= least, count)
        self.hashes = hashes_of_words(data, stop - begin)[kept]
        self.place = begin[kept] - np.repeat(origin[self.doc], self.count)  # in its text, in bytes
        self.first = np.cumsum(self.count) - self.count
        self.line = np.repeat(np.arange(len(line)), self.count)

    def band_keys(self) -> np.ndarray:
        """A row for each line: one key per band of its MinHashes."""
        inside = self.line[:-WIDTH + 1] == self.line[WIDTH - 1:]
        shingled = windows(self.hashes, WIDTH)[inside]
        n = self.count - WIDTH + 1
        first = np.cumsum(n) - n
        keys = np.tile(np.arange(BANDS, dtype=np.uint64), (len(n), 1))
        for row in range(ROWS):
            least = [np.minimum.reduceat(mix(shingled, 100 + band * ROWS + row), first) for band in range(BANDS)]
            keys = mix(keys + np.stack(least, axis=1), 7)
        return keys

    def cut_places(self) -> np.ndarray:
        """Words that start a piece inside a line: the least hash within ``REACH`` on both sides."""
        place = np.arange(len(self.hashes)) - self.first[self.line]
        least = (place >= REACH) & (place < self.count[self.line] - REACH)
        at = np.flatnonzero(least)
        for j in range(1, REACH + 1):
            at = at[(self.hashes[at] < self.hashes[at - j]) & (self.hashes[at] <= self.hashes[at + j])]
        return at

    def digests(self, first: np.ndarray, kind: int) -> np.ndarray:
        """Of the word sequences from each of ``first`` to before the next."""
        place = np.arange(len(self.hashes)) - np.repeat(first, np.diff(np.r_[first, len(self.hashes)]))
        return np.add.reduceat(mix(self.hashes ^ mix(place.astype(np.uint64), kind)), first).view(np.int64)


def units(docs: DataFrame) -> DataFrame:
    """(doc_id, start, end, id, sigs): lines of five words or more, and their pieces, without keys.

    Places are in bytes; a line ends after its line feed, a piece before the next.
    """
    def run(batch):
        lines = Lines(batch["text"])
        if not len(lines.count):
            return
        ids = np.array(batch["doc_id"], np.int64)
        yield {"doc_id": ids[lines.doc], "start": lines.start, "end": lines.end,
               "id": lines.digests(lines.first, 1), "sigs": pa.ListArray.from_arrays(
                   np.arange(len(lines.count) + 1, dtype=np.int32) * BANDS, lines.band_keys().view(np.int64).ravel())}
        cut = lines.cut_places()
        first = np.union1d(lines.first, cut)
        size = np.diff(np.r_[first, len(lines.hashes)])
        line = lines.line[first]
        parted = np.bincount(lines.line[cut], minlength=len(lines.count)) > 0
        start = lines.place[first]
        inner = np.r_[line[1:] == line[:-1], False]
        end = np.where(inner, np.r_[start[1:], 0], lines.end[line])
        start = np.where(first == lines.first[line], lines.start[line], start)
        kept = parted[line] & (size >= WIDTH)
        yield {"doc_id": ids[lines.doc[line[kept]]], "start": start[kept], "end": end[kept],
               "id": lines.digests(first, 2)[kept], "sigs": pa.nulls(int(kept.sum()), pa.list_(pa.int64()))}

    return map_batches(docs, run, "doc_id bigint, start bigint, end bigint, id bigint, sigs array<bigint>")


def _items(docs: DataFrame, found: DataFrame, ids: DataFrame) -> DataFrame:
    """(id, items): the shingles of one occurrence of each line in ``ids``."""
    place = found.join(small_side(ids), "id").groupBy("id").agg(F.min(F.struct("doc_id", "start", "end")).alias("p"))
    listed = place.groupBy("p.doc_id").agg(F.collect_list(F.struct("id", "p.start", "p.end")).alias("lines"))
    wanted = docs.join(small_side(listed), "doc_id")

    def run(batch):
        ids, words = [], []
        for text, lines in zip(batch["text"], batch["lines"]):
            data = text.encode()
            ids += [x["id"] for x in lines]
            words += [data[x["start"]:x["end"]].lower().split() for x in lines]
        yield {"id": ids, "items": [items.view(np.int64) for items in shingles_of(words)]}

    return map_batches(wanted, run, "id bigint, items array<bigint>", ["text", "lines"])


def repeated_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, start, end, similar): paragraphs of which an earlier one is in the same component.

    ``docs`` has unique ids.  Earlier means a smaller ``doc_id`` or the same
    document and a smaller start; the first paragraph of a component stays.
    ``similar`` ones do not equal that first one.
    """
    found = materialize(units(docs))
    rows = found.where("sigs is not null").select(F.explode("sigs").alias("sig"), "id")
    shared = materialize(shared_only(rows))
    classes = linked_components(shared, partial(_items, docs, found), THRESHOLD, rounds=4)
    # first by id, with partial aggregation, then by component
    by_id = found.groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("doc_id", "start")).alias("first"))
    by_id = materialize(by_id.join(classes, "id", "left").where("n > 1 or component is not null")
                        .withColumn("component", F.coalesce("component", "id")))
    firsts = (by_id.groupBy("component").agg(F.sum("n").alias("total"), F.min("first").alias("first"))
              .where("total > 1").select("component", "first"))
    known = (by_id.select("id", "component", F.col("first").alias("own")).join(firsts, "component")
             .select("id", "first", (F.col("own") != F.col("first")).alias("similar")))
    return (found.select("doc_id", "start", "end", "id").join(known, "id")
            .where((F.col("doc_id") != F.col("first.doc_id")) | (F.col("start") != F.col("first.start")))
            .select("doc_id", "start", "end", "similar"))


def passages(data: bytes, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Where the words stand in ``data`` that ``spans`` of its ``unwrapped`` form hold as a whole.

    A run ends before the next word of its line; one that starts a line takes the line feed too.
    """
    begin, stop = words_in(data)
    ends = np.cumsum(stop - begin + 1) - 1
    starts = ends - (stop - begin)
    found = []
    for start, end in merged(spans):
        first, last = np.searchsorted(starts, start), np.searchsorted(ends, end, "right") - 1
        if first <= last:
            a, b = begin[first], stop[last]
            rest = BLANKS.match(data, b).end()
            line = data.rfind(b"\n", 0, a) + 1
            if not data[line:a].strip() and data[rest:rest + 1] in (b"\n", b""):
                a, rest = line, min(rest + 1, len(data))
            found.append((int(a), int(rest)))
    return merged(found)


def unwrapped(text: str) -> str:
    """The words of ``text``, A-Z in lower case, with a space between them."""
    return b" ".join(text.encode().lower().split()).decode()


def _similar(spans: list[int] | None) -> list[tuple[int, int]]:
    return merged([(a, b) for a, b, similar in unpacked(spans) if similar])


def replaced(spans: list[tuple[int, int]], removed: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """``spans`` of what stays without ``removed`` as spans of the whole."""
    sizes = np.cumsum([0] + [b - a for a, b in removed])
    joints = np.array([a for a, _ in removed], np.int64) - sizes[:-1]
    return [(int(a + sizes[np.searchsorted(joints, a, "right")]), int(b + sizes[np.searchsorted(joints, b, "left")]))
            for a, b in spans]


def repeated_passages(joined: DataFrame) -> DataFrame:
    """(doc_id, start, end) in the unwrapped rests without similar lines of ``joined`` (doc_id, text, spans)."""
    def run(batch):
        yield {"doc_id": batch["doc_id"], "text": [
            unwrapped(without(text.encode(), _similar(spans)).decode())
            for text, spans in zip(batch["text"], batch["spans"])]}

    rests = map_batches(joined, run, "doc_id bigint, text string", ["doc_id", "text", "spans"])
    return suffixes.repeated_spans(materialize(rests))


def cleaned(docs: DataFrame, *others: str, unwrap: bool = False) -> DataFrame:
    """(doc_id, text, n_spans, n_removed) and ``others``: texts without repeated paragraphs.

    With ``unwrap`` they are without repeated passages too, which are strings of
    at least ``suffixes.LENGTH`` bytes in the unwrapped rest.  ``n_removed``
    counts bytes.  Null texts count as empty; rows without id and repeated ids
    are treated as ``identified`` says.
    """
    known = identified(docs, *others)
    with scratch(docs.sparkSession) as keep:
        spans = keep(repeated_spans(known.select("doc_id", "text")))
    listed = spans.groupBy("doc_id").agg(collected("start", "end", "similar").alias("spans"))
    joined = known.join(small_side(listed), "doc_id", "left")
    if unwrap:
        with scratch(docs.sparkSession) as keep:
            found = keep(repeated_passages(joined))
        listed = found.groupBy("doc_id").agg(collected("start", "end").alias("more"))
        joined = joined.join(small_side(listed), "doc_id", "left")
    else:
        joined = joined.withColumn("more", F.lit(None).cast("array<bigint>"))

    def run(batch):
        made = {name: batch[name] for name in ("doc_id", *others)}
        made |= {"text": [], "n_spans": [], "n_removed": []}
        for text, found, more in zip(batch["text"], batch["spans"], batch["more"]):
            runs = merged([(a, b) for a, b, _ in unpacked(found)])
            if more:
                removed = _similar(found)
                inner = passages(without(text.encode(), removed), [(a, b) for a, b, _ in unpacked(more)])
                runs = merged(runs + replaced(inner, removed))
            made["text"].append(without(text.encode(), runs).decode() if runs else text)
            made["n_spans"].append(len(runs))
            made["n_removed"].append(sum(b - a for a, b in runs))
        yield made

    kinds = "".join(f", {name} {dict(known.dtypes)[name]}" for name in others)
    return map_batches(joined, run, "doc_id bigint, text string, n_spans bigint, n_removed bigint" + kinds)


def digests(docs: DataFrame, unwrap: bool = False) -> DataFrame:
    """One row per document: what was removed and a digest of what stays."""
    kept: Column = F.sha2("text", 256)
    return cleaned(docs, unwrap=unwrap).select(
        "doc_id", (F.octet_length("text") + F.col("n_removed")).cast("bigint").alias("n_bytes"),
        "n_removed", "n_spans", kept.alias("kept_sha256"))
