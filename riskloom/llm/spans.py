"""Runs of removed bytes."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

FLAG = 1 << 31  # a span is its start, 31 bits of length and a flag in one long


def collected(start: str, end: str, flag: str | None = None) -> Column:
    """All spans of a group, as ``unpacked`` reads them; no text reaches a length of 2^31 bytes."""
    length = F.col(end) - F.col(start)
    marked = F.lit(0) if flag is None else F.col(flag).cast("bigint") * FLAG
    return F.collect_list(F.shiftleft(F.col(start).cast("bigint"), 32) + marked + length)


def unpacked(spans: list[int] | None) -> list[tuple[int, int, bool]]:
    """(start, end, flag) of ``collected`` spans."""
    return [(x >> 32, (x >> 32) + (x & FLAG - 1), bool(x & FLAG)) for x in spans or []]


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of overlapping or touching spans."""
    runs: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if runs and start <= runs[-1][1]:
            runs[-1] = (runs[-1][0], max(end, runs[-1][1]))
        else:
            runs.append((start, end))
    return runs


def without(data: bytes, runs: list[tuple[int, int]]) -> bytes:
    edges = [0, *[e for run in runs for e in run], len(data)]
    return b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2]))
