"""Compression of vectors to codes: one codebook for each part of a vector, in exact integers.

Components become integers.  The dot products of parts with codebook entries
are float64 matrix products of limbs: integers are broken into so few bits that
no sum of products reaches 2^53, so every product is exact, and the limbs'
products are put together in int64.  A part belongs to the first entry with the
least squared distance.

Rounds are passes over the stored integers.  A task adds up what falls to each
entry and hands on one row per entry, so what is shuffled and what the driver
holds is the codebooks' size times tasks, whatever the number of vectors.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from riskloom.llm.common import small_batches, small_side
from riskloom.sources.storage import materialize

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
EXACT_BITS = 53  # integers up to 2^53 are exact in float64
CHUNK = 4096  # vectors whose distances are held at once


def limbs(values: np.ndarray, bits: int) -> list[np.ndarray]:
    """``values`` as float64 limbs, least first: values = sum of limb_i * 2^(bits * i).

    All but the last lie in [0, 2^bits); the last has the sign and is at most 2^bits in size.
    """
    parts, rest = [], values
    while len(rest) and max(abs(int(rest.min())), abs(int(rest.max()))) > (1 << bits):
        parts.append((rest & ((1 << bits) - 1)).astype(np.float64))
        rest = rest >> bits
    return [*parts, rest.astype(np.float64)]


def limb_bits(length: int) -> int:
    """Bits of a limb such that ``length`` products of limbs add up to at most 2^53."""
    return (EXACT_BITS - max(length, 1).bit_length()) // 2


def exact_products(rows: np.ndarray, entries: np.ndarray, bits: int | None = None) -> np.ndarray:
    """All dot products of int64 ``rows`` with ``entries``, exact as long as they fit int64."""
    if not rows.shape[1]:
        return np.zeros((len(rows), len(entries)), np.int64)
    bits = limb_bits(rows.shape[1]) if bits is None else bits
    total = np.zeros((len(rows), len(entries)), np.int64)
    for i, a in enumerate(limbs(rows.ravel(), bits)):
        for j, b in enumerate(limbs(entries.ravel(), bits)):
            product = a.reshape(rows.shape) @ b.reshape(entries.shape).T
            total += product.astype(np.int64) << (bits * (i + j))
    return total


def nearest(rows: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry to each row, the first of equals, and its squared distance."""
    own = (entries * entries).sum(axis=1)
    distance = exact_products(rows, entries)
    distance *= -2
    distance += own
    best = distance.argmin(axis=1)
    return best, distance[np.arange(len(rows)), best] + (rows * rows).sum(axis=1)


class Codebooks:
    """``books[p][e]``: the integer components of entry e for part p."""

    def __init__(self, vectors: list[list[int]], parts: int = PARTS):
        width = len(vectors[0]) // parts if vectors else 0
        whole = np.array(vectors, np.int64).reshape(len(vectors), parts * width)
        self.books = np.ascontiguousarray(whole.reshape(len(vectors), parts, width).transpose(1, 0, 2))

    @property
    def width(self) -> int:
        return self.books.shape[2]

    def assign(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(vector, part) -> entry, and the squared distances added over parts."""
        parts = vectors.reshape(len(vectors), len(self.books), self.width)
        found = [nearest(np.ascontiguousarray(parts[:, p]), book) for p, book in enumerate(self.books)]
        return np.stack([f[0] for f in found], axis=1), sum(f[1] for f in found)

    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.books.ravel().tolist())).encode()).hexdigest()


def integer_vectors(vectors: DataFrame, scale: int = SCALE, vector: str = "embedding") -> DataFrame:
    """(vec_id, label, whole array<int>): components times ``scale``, all floors going down.

    Rows whose vector is null or holds a null or a component that is not finite
    are left out.  A scaled component so large that squared distances might not
    fit 64 bits (2^28 at 16 components, less with more) raises a ValueError.
    """
    small_batches(vectors.sparkSession)
    kinds = _arrow("vec_id bigint, label string, whole array<int>", vectors)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = batch.column(2)
            flat = found.flatten()
            values = flat.cast(pa.float64()).to_numpy(zero_copy_only=False)  # nulls become NaN
            sizes = np.array(found.value_lengths().fill_null(0), np.int64)
            bad = np.r_[0, np.cumsum(~np.isfinite(values))]
            ends = np.cumsum(sizes)
            good = np.array(found.is_valid()) & (bad[ends] == bad[ends - sizes])
            kept = values[np.repeat(good, sizes)]
            whole = np.floor(kept * scale)
            largest = min(2**31 - 1, math.isqrt(2**60 // int(sizes[good].max(initial=1) or 1)))
            if np.abs(whole).max(initial=0) > largest:
                raise ValueError(f"a component beyond {largest} after scaling")
            offsets = np.r_[0, np.cumsum(sizes[good])].astype(np.int32)
            mask = pa.array(good)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).filter(mask), batch.column(1).filter(mask),
                 pa.ListArray.from_arrays(offsets, pa.array(whole.astype(np.int32))).cast(kinds[2].type)],
                schema=kinds)

    return (vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"),
                           F.col("label").cast("string").alias("label"), F.col(vector).alias("vector"))
            .mapInArrow(run, "vec_id bigint, label string, whole array<int>"))


def _arrow(schema: str, df: DataFrame) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(schema))


def _chunks(batch: pa.RecordBatch, column: str, length: int) -> Iterator[tuple[int, np.ndarray]]:
    """Pieces of a batch as matrices, with the row each starts at."""
    whole = batch.column(batch.schema.get_field_index(column)).flatten().to_numpy(zero_copy_only=False)
    matrix = whole.astype(np.int64).reshape(batch.num_rows, length)
    for start in range(0, batch.num_rows, CHUNK):
        yield start, matrix[start:start + CHUNK]


def _sums(whole: DataFrame, books: Codebooks) -> DataFrame:
    """(part, entry, n, s0, s1, ...): number and sums of the parts that each entry is nearest to."""
    n_parts, n_entries, width = books.books.shape
    names = [f"s{i}" for i in range(width)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = np.zeros(n_parts * n_entries, np.int64)
        total = np.zeros((n_parts * n_entries, width), np.int64)
        for batch in batches:
            for _, chunk in _chunks(batch, "whole", n_parts * width):
                entry = books.assign(chunk)[0] + np.arange(n_parts) * n_entries
                flat = entry.ravel()
                number += np.bincount(flat, minlength=len(number))
                order = np.argsort(flat, kind="stable")
                first = np.flatnonzero(np.diff(flat[order], prepend=-1))
                if width:
                    total[flat[order][first]] += np.add.reduceat(chunk.reshape(-1, width)[order], first, axis=0)
        used = np.flatnonzero(number)
        yield pa.RecordBatch.from_arrays(
            [pa.array((used // n_entries).astype(np.int32)), pa.array((used % n_entries).astype(np.int32)),
             pa.array(number[used]), *[pa.array(total[used, i]) for i in range(width)]],
            names=["part", "entry", "n", *names])

    schema = "part int, entry int, n bigint" + "".join(f", {s} bigint" for s in names)
    return (whole.select("whole").mapInArrow(run, schema).groupBy("part", "entry")
            .agg(F.sum("n").alias("n"), *[F.sum(s).alias(s) for s in names]))


def train(whole: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> Codebooks:
    """Codebooks that start as the vectors with the least ids, bettered ``rounds`` times.

    Ids that are null come last, equal ids are ordered by their vectors.  The
    driver gets ``entries`` vectors once, and one row per part and entry a round.
    An entry becomes the floor of the mean of its parts; one without any stays.
    """
    first = whole.orderBy(F.asc_nulls_last("vec_id"), "whole").limit(entries).collect()
    books = Codebooks([list(r.whole) for r in first], parts)
    for _ in range(rounds if first else 0):
        for row in _sums(whole, books).collect():
            books.books[row["part"], row["entry"]] = [s // row["n"] for s in row[3:]]
    return books


def encode(whole: DataFrame, books: Codebooks) -> DataFrame:
    """(vec_id, label, codes array<int>, error): the entry of every part, distances added up."""
    n_parts, _, width = books.books.shape
    schema = "vec_id bigint, label string, codes array<int>, error bigint"
    kinds = _arrow(schema, whole)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, chunk in _chunks(batch, "whole", n_parts * width):
                entry, error = books.assign(chunk)
                offsets = np.arange(0, len(chunk) * n_parts + 1, n_parts, dtype=np.int32)
                part = batch.slice(start, len(chunk))
                codes = pa.ListArray.from_arrays(offsets, pa.array(entry.ravel().astype(np.int32)))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), codes.cast(kinds[2].type), pa.array(error)], schema=kinds)

    return whole.select("vec_id", "label", "whole").mapInArrow(run, schema)


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
             scale: int = SCALE, vector: str = "embedding") -> tuple[DataFrame, Codebooks]:
    """Codes of all kept vectors, as ``encode`` gives them, and the codebooks.

    See ``integer_vectors`` for rows left out.  All kept vectors need one length
    that ``parts`` divides, or a ValueError is raised.  An id or label that is
    null is a value like others; rows that repeat an id are rows of their own.
    Only the id, the label and the vector are looked at.  Without any vector
    the result is empty.
    """
    whole = materialize(integer_vectors(vectors, scale, vector))
    sizes = whole.agg(F.min(F.size("whole")).alias("least"), F.max(F.size("whole")).alias("most")).first()
    if sizes.least != sizes.most or (sizes.least or 0) % parts:
        raise ValueError(f"vectors of {sizes.least} to {sizes.most} components, wanted one multiple of {parts}")
    books = train(whole, parts, entries, rounds)
    return materialize(encode(whole, books)), books


def with_label_error(codes: DataFrame) -> DataFrame:
    """``codes`` with ``label_error``, the error added up over equal labels, nulls together.

    Errors are added before anything is joined, so a label that a third of all
    rows have is one row per task; the sums are broadcast only if small.
    """
    sums = small_side(codes.groupBy(F.col("label").alias("of_label")).agg(F.sum("error").alias("label_error")))
    return codes.join(sums, F.col("label").eqNullSafe(F.col("of_label"))).drop("of_label")


def report(codes: DataFrame, books: Codebooks) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256), codes as two hex digits each."""
    hexed = F.concat_ws("", F.transform("codes", lambda c: F.lpad(F.lower(F.hex(c)), 2, "0")))
    return with_label_error(codes).select(
        "vec_id", hexed.alias("code"), "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256"))
