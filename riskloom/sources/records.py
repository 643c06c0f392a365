"""CSV records that go on over line breaks, cut out of files by many tasks at once.

A line break inside quotes can only be told from the end of a record by what
stands before it in the file.  Every part of a file says where it would end,
inside quotes or not, for both ways it may start; these few answers are put
together in order, and then every part knows how it starts and cuts its own
records.  A record that crosses from one part to the next is joined afterwards.
"""

from __future__ import annotations

import csv
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from riskloom.sources.storage import fits_broadcast, materialize

# A quoted field between commas or the ends of a line, quotes inside it doubled.
CLOSED_FIELD = r'(^|,)"[^"]*(?:""[^"]*)*"(?=,|\r?$)'
PART = ["file", "start"]
WHOLE, HEAD, TAIL = 0, 1, 2  # a record; the end of an earlier part's; one that the next part goes on with


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, start, value): the lines of all files, ``start`` telling the parts of a file apart."""
    return (spark.read.option("lineSep", "\n").text(path)
            .select(F.col("_metadata.file_path").alias("file"),
                    F.col("_metadata.file_block_start").alias("start"), "value"))


def files_with_open_quotes(spark: SparkSession, path: str) -> list[str]:
    """Files with a line in which a quote is not part of a field that is closed on that line.

    That holds for every file with a line break inside quotes, and for files
    with stray quotes.  One narrow pass; what comes back is file names.
    """
    rest = F.regexp_replace("value", CLOSED_FIELD, "$1")
    suspect = _lines(spark, path).where(F.contains("value", F.lit('"'))).where(F.contains(rest, F.lit('"')))
    return [row.file for row in suspect.select("file").distinct().collect()]


def ends_inside(line: str, inside: bool) -> bool:
    """Whether a quoted field is open at the end of ``line``, given whether one is at its start.

    A quote opens a field only as its first character.  What follows a closing
    quote belongs to the field up to the next comma.
    """
    at = 0
    if not inside and line.startswith('"'):
        inside, at = True, 1
    while True:
        while inside:
            quote = line.find('"', at)
            if quote < 0:
                return True
            at = quote + 1
            if line.startswith('"', at):
                at += 1
            else:
                inside = False
        opening = line.find(',"', at)
        if opening < 0:
            return False
        inside, at = True, opening + 2


def _by_part(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch.column(batch.schema.get_field_index(n)).to_pylist() for n in names))


def _ways(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(file, start, from_outside, from_inside): where each part ends for both ways to start."""
    now, ways, found = None, (False, True), []
    for file, start, line in _by_part(batches, *PART, "value"):
        if (file, start) != now:
            if now is not None:
                found.append((*now, *ways))
            now, ways = (file, start), (False, True)
        if '"' in line:
            ways = tuple(ends_inside(line, way) for way in ways)
    if now is not None:
        found.append((*now, *ways))
    columns = list(zip(*found)) or [[], [], [], []]
    kinds = (pa.string(), pa.int64(), pa.bool_(), pa.bool_())
    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                     names=[*PART, "from_outside", "from_inside"])


def _starting_inside(parts: pd.DataFrame) -> pd.DataFrame:
    """The parts of one file that start inside quotes."""
    parts = parts.sort_values("start", ignore_index=True)
    inside, found = False, []
    for outside_way, inside_way in zip(parts["from_outside"], parts["from_inside"]):
        found.append(inside)
        inside = bool(inside_way if inside else outside_way)
    return parts[found][PART].assign(inside=True)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(file, start, number, kind, record) of the records and ends of records in each part."""
    names = [*PART, "number", "kind", "record"]
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.string())

    def batch() -> pa.RecordBatch:
        made = [pa.array(c, k) for c, k in zip(list(zip(*rows)) or [[]] * 5, kinds)]
        rows.clear()
        return pa.RecordBatch.from_arrays(made, names=names)

    rows: list[tuple] = []
    now, held, inside, kind, number = None, [], False, WHOLE, 0
    for file, start, line, starts_inside in _by_part(batches, *PART, "value", "inside"):
        if (file, start) != now:
            if held:
                rows.append((*now, number, HEAD if kind == HEAD else TAIL, "\n".join(held)))
            now, held, number = (file, start), [], 0
            inside = bool(starts_inside)
            kind = HEAD if inside else WHOLE
        held.append(line)
        if '"' in line:
            inside = ends_inside(line, inside)
        if not inside:
            record = "\n".join(held)
            rows.append((*now, number, kind, record[:-1] if record.endswith("\r") else record))
            held, kind, number = [], WHOLE, number + 1
        if len(rows) >= 1000:
            yield batch()
    if held:
        rows.append((*now, number, HEAD if kind == HEAD else TAIL, "\n".join(held)))
    yield batch()


def assembled_records(spark: SparkSession, path: str, files: list[str], header: list[str]) -> DataFrame:
    """(file, record) of the given files under ``path``, without headers and empty lines.

    A header other than ``header`` raises a ValueError.  A quote that is never
    closed takes the rest of its file into its record, as CSV has it.
    """
    lines = _lines(spark, path).where(F.col("file").isin(files))
    ways = lines.mapInArrow(_ways, "file string, start bigint, from_outside boolean, from_inside boolean")
    inside = materialize(ways.groupBy("file").applyInPandas(
        _starting_inside, "file string, start bigint, inside boolean"))
    if fits_broadcast(inside):
        marked = lines.join(F.broadcast(inside), PART, "left")
    else:  # the order of lines is lost in a shuffle and made anew
        marked = (lines.withColumn("line", F.monotonically_increasing_id()).join(inside, PART, "left")
                  .repartition(*PART).sortWithinPartitions(*PART, "line").drop("line"))
    cut = materialize(marked.mapInArrow(
        _cut, "file string, start bigint, number bigint, kind int, record string"))
    # ends of records only: two a part at most
    order = W.partitionBy("file").orderBy("start", "number")
    crossing = cut.where(F.col("kind") != WHOLE).withColumn(
        "of", F.sum((F.col("kind") == TAIL).cast("int")).over(order.rowsBetween(W.unboundedPreceding, 0)))
    piece = F.struct("start", "number", "record")
    joined = crossing.groupBy("file", "of").agg(
        F.min(F.struct("start", "number")).alias("at"), F.sort_array(F.collect_list(piece)).alias("pieces"))
    whole = cut.where(F.col("kind") == WHOLE).select("file", "start", "number", "record").unionByName(joined.select(
        "file", "at.start", "at.number", F.concat_ws("\n", F.col("pieces.record")).alias("record")))
    first = (F.col("start") == 0) & (F.col("number") == 0)
    for row in whole.where(first).select("record").distinct().collect():
        if next(csv.reader([row.record])) != header:
            raise ValueError(f"header of a file in {path} is not {header}: {row.record}")
    return whole.where(~first & (F.trim("record") != "")).select("file", "record")
