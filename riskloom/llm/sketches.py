"""Document fingerprints: invertible Bloom lookup tables of paragraph digests.

A paragraph is a line or, in longer lines, a piece cut where the words around
choose.  Two tables of one size subtract cell by cell; peeling what is left
gives the digests that only one of the texts has.  If peeling gets stuck, both
texts get tables of twice the size.  Work is done for a batch of texts at once.
"""

from __future__ import annotations

import base64
import hashlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.functions import pandas_udf

from riskloom.llm.common import identified, map_batches
from riskloom.llm.paragraphs import Lines
from riskloom.llm.shingles import mix

HASHES = 3
CELLS = 8  # of each of the three parts of a fingerprint
ROUNDS = 24
BUCKET_ROWS = 1000


def paragraph_keys(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(index of text, key), ordered; equal paragraphs of a text are told apart by number."""
    lines = Lines(texts, least=1, fold=False)
    if not len(lines.count):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    first = np.union1d(lines.first, lines.cut_places())
    owner = lines.doc[lines.line[first]]
    digest = lines.digests(first, 3).view(np.uint64)
    order = np.lexsort((digest, owner))
    owner, digest = owner[order], digest[order]
    new = np.r_[True, (owner[1:] != owner[:-1]) | (digest[1:] != digest[:-1])]
    start = np.flatnonzero(new)
    number = np.arange(len(digest)) - np.repeat(start, np.diff(np.r_[start, len(digest)]))
    return owner, mix(digest + number.astype(np.uint64), 400)


@dataclass
class Tables:
    """One table per owner: ``size`` cells in each of three parts, all in a row."""

    size: np.ndarray
    count: np.ndarray
    keys: np.ndarray
    checks: np.ndarray

    @property
    def start(self) -> np.ndarray:
        return HASHES * (np.cumsum(self.size) - self.size)

    def cells(self, owner: np.ndarray, keys: np.ndarray, part: int) -> np.ndarray:
        size = self.size[owner].astype(np.uint64)
        return self.start[owner] + part * self.size[owner] + (mix(keys ^ size, 200 + part) % size).astype(np.int64)

    def add(self, owner: np.ndarray, keys: np.ndarray, times: np.ndarray) -> None:
        weight = times.astype(np.uint64)  # minus one wraps
        for part in range(HASHES):
            at = self.cells(owner, keys, part)
            np.add.at(self.count, at, times)
            np.add.at(self.keys, at, keys * weight)
            np.add.at(self.checks, at, mix(keys, 300) * weight)


def build(owner: np.ndarray, keys: np.ndarray, size: np.ndarray) -> Tables:
    n = HASHES * int(size.sum())
    made = Tables(size, np.zeros(n, np.int64), np.zeros(n, np.uint64), np.zeros(n, np.uint64))
    made.add(owner, keys, np.ones(len(keys), np.int64))
    return made


def peel(left: Tables, right: Tables) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(owner, key, sign) of keys that one side has alone, left ones with sign 1; and per owner whether all came out."""
    rest = Tables(left.size, left.count - right.count, left.keys - right.keys, left.checks - right.checks)
    n = len(left.size)
    owner_of = np.repeat(np.arange(n), HASHES * left.size)
    found = [(np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64))]
    for _ in range(10_000):
        at = np.flatnonzero(np.abs(rest.count) == 1)
        sign = rest.count[at]
        keys = rest.keys[at] * sign.astype(np.uint64)
        pure = mix(keys, 300) * sign.astype(np.uint64) == rest.checks[at]
        if not pure.any():
            break
        owner, keys, sign = owner_of[at[pure]], keys[pure], sign[pure]
        order = np.lexsort((keys, owner))
        owner, keys, sign = owner[order], keys[order], sign[order]
        once = np.r_[True, (owner[1:] != owner[:-1]) | (keys[1:] != keys[:-1])]
        owner, keys, sign = owner[once], keys[once], sign[once]
        rest.add(owner, keys, -sign)
        found.append((owner, keys, sign))
    stuck = (rest.count != 0) | (rest.keys != 0) | (rest.checks != 0)
    owner, keys, sign = map(np.concatenate, zip(*found))
    return owner, keys, sign, np.bincount(owner_of[stuck], minlength=n) == 0


def _chosen(bounds: np.ndarray, keys: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place in ``texts``, key) of the keys of some texts, which start at ``bounds``."""
    sizes = bounds[texts + 1] - bounds[texts]
    at = np.arange(sizes.sum()) + np.repeat(bounds[texts] - np.cumsum(sizes) + sizes, sizes)
    return np.repeat(np.arange(len(texts)), sizes), keys[at]


def likeness(owner: np.ndarray, keys: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Shared over all paragraphs, from 0 to 1, of the texts ``left[i]`` and ``right[i]``.

    Two texts without paragraphs are alike.
    """
    total = max(left.max(initial=-1), right.max(initial=-1)) + 1
    bounds = np.searchsorted(owner, np.arange(total + 1))
    n = np.diff(bounds)
    result, todo, cells = np.ones(len(left)), np.arange(len(left)), CELLS

    for _ in range(ROUNDS):
        size = np.full(len(todo), cells)
        one = build(*_chosen(bounds, keys, left[todo]), size)
        two = build(*_chosen(bounds, keys, right[todo]), size)
        owner, _, sign, peeled = peel(one, two)
        only = np.bincount(owner[sign > 0], minlength=len(todo))
        a, b = n[left[todo]], n[right[todo]]
        union = np.maximum(b + only, 1)
        result[todo[peeled]] = np.where(a + b == 0, 1.0, (a - only) / union)[peeled]
        todo, cells = todo[~peeled], 2 * cells
        if not len(todo):
            return result
    raise RuntimeError("paragraph tables did not peel")


def fingerprints(owner: np.ndarray, keys: np.ndarray, n: int) -> list[str]:
    """The table of ``CELLS`` cells a part and the number of paragraphs, as text."""
    made = build(owner, keys, np.full(n, CELLS))
    width = HASHES * CELLS
    numbers = np.bincount(owner, minlength=n).astype("<u4")
    rows = [x.reshape(n, width).astype(kind) for x, kind in
            ((made.count, "<i4"), (made.keys, "<u8"), (made.checks, "<u8"))]
    return [base64.b64encode(numbers[i].tobytes() + b"".join(x[i].tobytes() for x in rows)).decode()
            for i in range(n)]


def stored_tables(marks: list[str]) -> Tables:
    """The tables that ``fingerprints`` wrote."""
    width, n = HASHES * CELLS, len(marks)
    whole = b"".join(base64.b64decode(m)[4:] for m in marks)
    cells = np.frombuffer(whole, np.dtype([("count", "<i4", width), ("keys", "<u8", width), ("checks", "<u8", width)]))
    return Tables(np.full(n, CELLS), *[cells[name].reshape(-1).astype(kind) for name, kind in
                                       (("count", np.int64), ("keys", np.uint64), ("checks", np.uint64))])


def differing_keys(marks: list[tuple[str, str]], texts: list[tuple[str, str]]) -> list[tuple[list[int], list[int], int]]:
    """(keys of the first alone, of the second alone, rounds) of each pair of stored fingerprints.

    Only where the stored tables do not peel are tables of twice the size built
    from both texts, and so on.
    """
    found: list = [None] * len(marks)
    todo, cells = np.arange(len(marks)), CELLS
    owner, keys = np.zeros(0, np.int64), np.zeros(0, np.uint64)
    for number in range(1, ROUNDS + 1):
        if number == 1:
            one, two = (stored_tables([m[side] for m in marks]) for side in (0, 1))
        else:
            if number == 2:  # the texts of those that are left, side by side
                left = todo
                owner, keys = paragraph_keys([texts[i][0] for i in left] + [texts[i][1] for i in left])
                bounds = np.searchsorted(owner, np.arange(2 * len(left) + 1))
            at, size = np.searchsorted(left, todo), np.full(len(todo), cells)
            one = build(*_chosen(bounds, keys, at), size)
            two = build(*_chosen(bounds, keys, at + len(left)), size)
        who, key, sign, peeled = peel(one, two)
        for i in np.flatnonzero(peeled):
            mine = who == i
            found[todo[i]] = (sorted(key[mine & (sign > 0)].tolist()), sorted(key[mine & (sign < 0)].tolist()), number)
        todo, cells = todo[~peeled], 2 * cells
        if not len(todo):
            return found
    raise RuntimeError("paragraph tables did not peel")


def sketch(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint), to be stored with a version of the documents; see ``identified`` for odd ids."""
    def run(batch):
        owner, keys = paragraph_keys(batch["text"])
        yield {"doc_id": batch["doc_id"], "fingerprint": fingerprints(owner, keys, len(batch["text"]))}

    return map_batches(identified(docs), run, "doc_id bigint, fingerprint string")


def paragraphs_of(docs: DataFrame) -> DataFrame:
    """(doc_id, digest): every paragraph of every document, as ``differing_paragraphs`` names it."""
    def run(batch):
        owner, keys = paragraph_keys(batch["text"])
        yield {"doc_id": np.array(batch["doc_id"], np.int64)[owner], "digest": [f"{k:016x}" for k in keys.tolist()]}

    return map_batches(identified(docs), run, "doc_id bigint, digest string")


def differing_paragraphs(before: DataFrame, after: DataFrame) -> DataFrame:
    """(doc_id, removed, added, rounds): digests of the paragraphs that one version has and the other not.

    Both versions have doc_id, text and the ``fingerprint`` that ``sketch``
    gave.  The stored tables are subtracted and peeled; texts are only looked at
    where that gets stuck.  A document of one version alone differs from an
    empty text.  A paragraph that a text repeats is a digest for each time.
    Ids have to be there and unique in each version.
    """
    empty = fingerprints(np.zeros(0, np.int64), np.zeros(0, np.uint64), 1)[0]

    def side(docs: DataFrame, k: str) -> DataFrame:
        return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").alias(f"text{k}"),
                           F.col("fingerprint").alias(f"mark{k}"))

    both = side(before, "1").join(side(after, "2"), "doc_id", "full").select(
        "doc_id", *[F.coalesce(f"text{k}", F.lit("")).alias(f"text{k}") for k in "12"],
        *[F.coalesce(f"mark{k}", F.lit(empty)).alias(f"mark{k}") for k in "12"])

    def run(batch):
        found = differing_keys(list(zip(batch["mark1"], batch["mark2"])), list(zip(batch["text1"], batch["text2"])))
        yield {"doc_id": batch["doc_id"], "removed": [[f"{k:016x}" for k in f[0]] for f in found],
               "added": [[f"{k:016x}" for k in f[1]] for f in found], "rounds": [f[2] for f in found]}

    return map_batches(both, run, "doc_id bigint, removed array<string>, added array<string>, rounds int",
                       ["doc_id", "text1", "text2", "mark1", "mark2"])


def edited(text: str, following: str) -> str:
    """``text`` with its last quarter replaced by as much of the start of ``following``."""
    part = len(text) // 4
    return text[:len(text) - part] + following[:part]


def with_next(docs: DataFrame) -> DataFrame:
    """Rows in buckets of neighbouring ids, sorted, each bucket closed by the head of the next.

    Bounds between buckets are quantiles of the ids.  The first document of
    every bucket is sent to the bucket before as well, and the very first to the
    last, so a task can tell the next document of each of its rows.  What comes
    to the driver is one id for each ``BUCKET_ROWS`` documents.
    """
    rows = docs.count()
    buckets = max(1, -(-rows // BUCKET_ROWS))
    bounds = np.array(docs.approxQuantile("doc_id", [i / buckets for i in range(1, buckets)], 0.2 / buckets)
                      if rows and buckets > 1 else [])

    @pandas_udf("bigint")
    def bucket_of(ids: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, ids.to_numpy(np.float64), side="right"))

    placed = docs.withColumn("bucket", bucket_of("doc_id")).withColumn("tail", F.lit(False))
    heads = sorted((r["bucket"], r["doc_id"]) for r in
                   placed.groupBy("bucket").agg(F.min("doc_id").alias("doc_id")).collect())
    if not heads:
        return placed
    before = [heads[i - 1][0] for i in range(len(heads))]
    marks = docs.sparkSession.createDataFrame([(h[1], b) for h, b in zip(heads, before)],
                                              "doc_id bigint, bucket bigint")
    tails = docs.join(F.broadcast(marks), "doc_id").select(*docs.columns, "bucket", F.lit(True).alias("tail"))
    return placed.unionByName(tails).repartition("bucket").sortWithinPartitions("bucket", "tail", "doc_id")


def compare_versions(docs: DataFrame) -> DataFrame:
    """One row per document: its fingerprint, that of its edited text, and likenesses.

    Null texts count as empty; rows without id and repeated ids: see
    ``identified``.  A single document is its own next one.
    """
    arrow = "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, " \
            "edited_fingerprint string, near_edited double, near_next double, n_paragraphs bigint"

    def compared(rows: list[tuple]) -> dict[str, list]:
        """All but the last of ``rows``, where the next one is in the same bucket."""
        kept = [i for i in range(len(rows) - 1) if not rows[i][1] and rows[i][0] == rows[i + 1][0]]
        texts = [r[3] for r in rows]
        changed = [edited(texts[i], texts[i + 1]) for i in kept]
        owner, keys = paragraph_keys(texts + changed)
        marks = fingerprints(owner, keys, len(texts) + len(changed))
        at, n = np.array(kept, np.int64), len(kept)
        both = likeness(owner, keys, np.r_[at, at], np.r_[len(texts) + np.arange(n), at + 1])
        return {"doc_id": [rows[i][2] for i in kept], "n_chars": [len(texts[i]) for i in kept],
                "edited_sha256": [hashlib.sha256(c.encode()).hexdigest() for c in changed],
                "fingerprint": [marks[i] for i in kept], "edited_fingerprint": marks[len(texts):],
                "near_edited": both[:n], "near_next": both[n:],
                "n_paragraphs": np.bincount(owner, minlength=len(marks))[at]}

    def run(batches):
        carried: list[tuple] = []
        for batch in batches:
            rows = carried + list(zip(batch["bucket"], batch["tail"], batch["doc_id"], batch["text"]))
            carried = rows[-1:]
            yield compared(rows)

    ordered = with_next(identified(docs))
    return map_batches(ordered, run, arrow, ["bucket", "tail", "doc_id", "text"], streaming=True)
