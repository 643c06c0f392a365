"""What the operators of this folder share: clean inputs and Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from riskloom.sources.storage import materialize

TABLE = "{sf}/{name}.parquet"
BROADCAST_BYTES = 48 * 1024 * 1024
DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(TABLE.format(sf=sf, name=name))


def texts(docs: DataFrame, *others: str) -> DataFrame:
    """``doc_id``, ``text`` with null as empty, and the named columns.

    One row for each row of ``docs``; all other columns are left behind, so
    none of them can clash with what an operator adds.
    """
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                       F.coalesce(F.col("text"), F.lit("")).alias("text"), *others)


def identified(docs: DataFrame, *others: str) -> DataFrame:
    """``texts``, one row per document that has an id.

    Rows without ``doc_id`` are left out: nothing could be reported on them.
    Rows that repeat a ``doc_id`` are one document, with its smallest text.
    Whether ids repeat is looked up first, from the id column alone, so a table
    with unique ids is not shuffled.
    """
    found = texts(docs, *others).where(F.col("doc_id").isNotNull())
    repeated = found.groupBy("doc_id").count().where("count > 1")
    if repeated.isEmpty():
        return found
    first = Window.partitionBy("doc_id").orderBy("text", *others)
    return found.withColumn("_row", F.row_number().over(first)).where("_row = 1").drop("_row")


def small_side(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``df``, stored, with a broadcast hint if what it holds stays under ``limit`` bytes.

    Array elements count 32 bytes each, longs 8.  Beyond the limit the join is an
    ordinary one, which Spark shuffles.
    """
    stored = materialize(df)
    return F.broadcast(stored) if fits(stored, limit) else stored


def fits(stored: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    """Whether what ``stored`` holds stays under ``limit`` bytes, counted as ``small_side`` says."""
    width = F.lit(64)
    for name, kind in stored.dtypes:
        if kind == "string":
            width = width + F.coalesce(F.octet_length(name), F.lit(0))
        elif kind.startswith("array"):
            width = width + (8 if kind == "array<bigint>" else 32) * F.coalesce(F.greatest(F.size(name), F.lit(0)), F.lit(0))
    return (stored.agg(F.sum(width.cast("bigint"))).first()[0] or 0) <= limit


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Let Python tasks get batches of ``rows`` rows unless the session says otherwise."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(name, "10000") == "10000":
        spark.conf.set(name, str(rows))


def map_batches(df: DataFrame, function: Callable, schema: str, columns: list[str] | None = None,
                streaming: bool = False) -> DataFrame:
    """Apply ``function`` to batches as lists by column name; it yields such lists.

    With ``streaming`` it is given an iterator of all batches of a task instead.
    Columns may also come back as NumPy or Arrow arrays.
    """
    small_batches(df.sparkSession)
    arrow = _arrow_schema(df.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given = (batch.to_pydict() for batch in batches if batch.num_rows)
        for made in function(given) if streaming else (m for g in given for m in function(g)):
            yield pa.RecordBatch.from_arrays(
                [pa.array(made[f.name], type=f.type) for f in arrow], schema=arrow)

    return (df.select(*columns) if columns else df).mapInArrow(run, schema)


def _arrow_schema(spark: SparkSession, schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(schema))
