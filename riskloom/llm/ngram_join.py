"""Similarity join of shingle sets by PartEnum signatures.

Sets are put into size bands.  A band divides the domain of shingles into
cells and knows how many cells two similar sets of its sizes can differ in.
Among enough of the first non-empty cells of both, a subset of cells must then
be equal; each subset with its contents is a signature.  In the bands of small
sets, where a cell is a single shingle, all subsets of two are listed; in the
others subsets of one cell are, and a similar partner shows in several.
"""

from __future__ import annotations

from functools import partial
from itertools import combinations

import numpy as np
import xxhash
from pyspark.sql import DataFrame, functions as F

from riskloom.llm.common import identified, map_batches, small_side
from riskloom.llm.links import linked_components, shared_only
from riskloom.llm.shingles import mix, shingles_of, words_of
from riskloom.sources.storage import materialize, scratch

THRESHOLD = 75
BAND = 4  # a band reaches up to this many times its least size
SMALL_BANDS = 2  # so many bands have one shingle per cell
SPARE = 12  # one more signature per so many shingles
SALTS = 8


def most_different(size: int, threshold: int = THRESHOLD) -> int:
    """How many shingles a set of ``size`` and a similar one can have that the other lacks."""
    partner = 100 * size // threshold
    return (100 - threshold) * (size + partner) // (100 + threshold)


def bands(size: int, threshold: int = THRESHOLD) -> list[int]:
    """The band of ``size`` and, if a similar larger set can lie in it, the next."""
    band = 0
    while BAND ** (band + 1) <= size:
        band += 1
    return [band] + [band + 1] * (100 * size >= threshold * BAND ** (band + 1))


def spare(size: int) -> int:
    return max(1, size // SPARE)


def least_shared(size: int, threshold: int = THRESHOLD) -> int:
    """Signatures a set shares with any similar one at least."""
    return spare(-(-size * threshold // 100))


def signatures(items: np.ndarray, salt: int = 0, threshold: int = THRESHOLD) -> np.ndarray | None:
    """Signatures of a sorted set; None if its shingles fill too few cells under this salt."""
    size = len(items)
    found = []
    for band in bands(size, threshold):
        differ = most_different(size, threshold)
        if band < SMALL_BANDS:
            cells = mix(items, band)
            cells.sort()
            chosen = 2 if size > 1 else 1
            found += [mix(np.array([sum(subset) % 2**64], np.uint64), band)[0]
                      for subset in combinations(map(int, cells[:differ + chosen]), chosen)]
            continue
        spread = mix(items, 64 + salt)
        spread.sort()
        bits = 1 + (BAND.bit_length() - 1) * (band + 1)
        cell = spread >> np.uint64(64 - bits)
        starts = np.flatnonzero(np.concatenate(([True], cell[1:] != cell[:-1])))
        wanted = differ + spare(size)
        if len(starts) < wanted:
            return None
        contents = np.add.reduceat(mix(spread), starts)[:wanted]
        found.append(mix(contents + mix(cell[starts[:wanted]]), band))
    return np.hstack(found) if found else np.zeros(0, np.uint64)


def shingle_sets(docs: DataFrame, salt: int = 0) -> DataFrame:
    """(doc_id, n_shingles, set, set2, sigs) per document; the shingles' digest of 128 bits is in two halves."""
    def run(batch):
        made = {"doc_id": batch["doc_id"], "n_shingles": [], "set": [], "set2": [], "sigs": []}
        for items in shingles_of([words_of(text) for text in batch["text"]]):
            sigs = signatures(items, salt)
            made["n_shingles"].append(len(items))
            digest = xxhash.xxh3_128_intdigest(items.tobytes())
            made["set"].append((digest >> 64) - 2**63)
            made["set2"].append((digest & (2**64 - 1)) - 2**63)
            made["sigs"].append(None if sigs is None else sigs.view(np.int64))
        yield made

    return map_batches(docs, run, "doc_id bigint, n_shingles bigint, set bigint, set2 bigint, sigs array<bigint>")


def items_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(id, items) of the documents in ``ids``."""
    wanted = docs.join(small_side(ids.select(F.col("id").alias("doc_id"))), "doc_id")

    def run(batch):
        found = shingles_of([words_of(text) for text in batch["text"]])
        yield {"id": batch["doc_id"], "items": [items.view(np.int64) for items in found]}

    return map_batches(wanted, run, "id bigint, items array<bigint>", ["doc_id", "text"])


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id), one row per document, stored.

    Two documents link when their shingle sets have a Jaccard similarity of at
    least 75 percent; ``component_id`` is the least ``doc_id`` within reach.
    Null texts and texts without a word have no shingles and link with nothing;
    shorter texts than a shingle count as one shingle.  Rows without id and
    repeated ids: see ``identified``.  Shingles are compared by 64-bit hashes,
    equal sets by 128 bits of them.
    """
    known = identified(docs)
    with scratch(docs.sparkSession) as keep:
        equal, shared = _equal_and_shared(known)
        need = F.greatest(F.lit(1), F.floor(F.ceil(F.col("n_shingles") * THRESHOLD / 100) / SPARE))
        first = equal.where("n_shingles > 0 and doc_id = id").select("id", need.alias("need"))
        classes = linked_components(shared, partial(items_of, known), THRESHOLD, rounds=2, need=first)
        return keep(equal.join(classes, "id", "left").select(
            "doc_id", "n_shingles", F.coalesce("component", "id").alias("component_id")))


def _equal_and_shared(known: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(doc_id, n_shingles, id) with the first document of equal sets, and what ``shared_only`` leaves of those."""
    with scratch(known.sparkSession) as keep:
        for salt in range(SALTS):
            sets = materialize(shingle_sets(known, salt))
            if sets.where("sigs is null").isEmpty():
                break
        else:
            raise RuntimeError("no salt spreads every set over enough cells")
        filled = sets.where("n_shingles > 0")
        same = [F.col("set"), F.col("set2")]
        first = filled.groupBy(*same).agg(F.min("doc_id").alias("id"))
        empty = sets.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("id"))
        equal = keep(filled.select("doc_id", "n_shingles", *same).join(first, ["set", "set2"])
                     .select("doc_id", "n_shingles", "id").unionByName(empty))
        # from here on the first document of equal sets stands for all of them
        single = filled.join(small_side(equal.where("doc_id <> id").select("doc_id")), "doc_id", "left_anti")
        return equal, keep(shared_only(single.select(F.explode("sigs").alias("sig"), F.col("doc_id").alias("id"))))


def keep_one(docs: DataFrame, *others: str) -> DataFrame:
    """(doc_id, text) and ``others`` of the document with the least id of every component."""
    known = identified(docs, *others)
    kept = near_duplicates(known).where("doc_id = component_id").select("doc_id")
    return known.join(small_side(kept), "doc_id", "left_semi")
