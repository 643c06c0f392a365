"""Packing of token streams into windows by best-fit decreasing.

Documents are cut into full windows and one rest.  Rests go to shards of a
bounded number of pieces by hash; within a shard the tightest open window is
found in a segment tree over remaining capacity.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from riskloom.llm.bpe import broadcast_definition, encoder
from riskloom.llm.common import identified, map_batches
from riskloom.sources.storage import materialize

WINDOW = 1024
SHARD_PIECES = 50_000
END_ID = 0


class OpenWindows:
    """Open windows by remaining capacity; ``take`` finds the tightest that fits."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.filled = [0] * (2 * self.leaves)
        self.stacks: list[list[int]] = [[] for _ in range(self.leaves)]

    def _count(self, room: int, by: int) -> None:
        node = room + self.leaves
        while node:
            self.filled[node] += by
            node >>= 1

    def put(self, room: int, window: int) -> None:
        if room > 0:
            self.stacks[room].append(window)
            self._count(room, 1)

    def take(self, length: int) -> tuple[int, int] | None:
        """(room, window) of the least room that is at least ``length``."""
        node = length + self.leaves
        while not self.filled[node]:
            while node & 1:  # a right child: go up until something lies to the right
                node >>= 1
            if node == 0:
                return None
            node += 1
        while node < self.leaves:
            node <<= 1
            if not self.filled[node]:
                node += 1
        room = node - self.leaves
        self._count(room, -1)
        return room, self.stacks[room].pop()


def best_fit(lengths: list[int], capacity: int) -> tuple[list[int], list[int]]:
    """(window, offset) of each piece; ``lengths`` must not rise."""
    windows, offsets, used, open_windows = [], [], 0, OpenWindows(capacity)
    for length in lengths:
        found = open_windows.take(length)
        room, window = found or (capacity, used)
        used += found is None
        windows.append(window)
        offsets.append(capacity - room)
        open_windows.put(room - length, window)
    return windows, offsets


def cut(docs: DataFrame, definition: str, pattern: str, window: int = WINDOW,
        end_id: int = END_ID) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens): full windows, then the rest."""
    shared = broadcast_definition(docs.sparkSession, definition)
    end = np.array([end_id], "<u4").tobytes()

    def run(batch):
        enc = encoder(shared, pattern)
        made = {"doc_id": [], "start": [], "length": [], "ids_crc32": [], "doc_tokens": []}
        for doc_id, text in zip(batch["doc_id"], batch["text"]):
            ids = enc.encode(text) + end
            for at in range(0, len(ids), 4 * window):
                part = ids[at:at + 4 * window]
                made["doc_id"].append(doc_id)
                made["start"].append(at // 4)
                made["length"].append(len(part) // 4)
                made["ids_crc32"].append(zlib.crc32(part))
                made["doc_tokens"].append(len(ids) // 4)
        yield made

    return map_batches(identified(docs), run,
                       "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint")


def pack(docs: DataFrame, definition: str, pattern: str, window: int = WINDOW,
         shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """The pieces of all documents with ``sequence_id`` and ``offset``.

    Every document ends with one end id, so null and empty texts give a piece
    of length one.  Rows without id and repeated ids: see ``identified``.  Ties
    in length are ordered by document and start, so the result does not depend
    on the order of rows.
    """
    pieces = materialize(cut(docs, definition, pattern, window))
    shards = max(1, -(-pieces.count() // shard_pieces))

    def fill(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["length", "doc_id", "start"], ascending=[False, True, True])
        windows, offsets = best_fit(group["length"].tolist(), window)
        ids = group["shard"].to_numpy() + shards * np.array(windows, np.int64)
        return group.drop(columns="shard").assign(sequence_id=ids, offset=np.array(offsets, np.int64))

    shard = F.pmod(F.xxhash64("doc_id", "start"), F.lit(shards)).cast("bigint")
    return pieces.withColumn("shard", shard).groupBy("shard").applyInPandas(
        fill, "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
              "sequence_id bigint, offset bigint")
