"""Shared storage for written intermediates, and size-checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession, functions as F

BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_stored: ContextVar[list[tuple[DataFrame, str]] | None] = ContextVar("stored", default=None)


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local session without the setting gets a temporary folder of its
    own; on a cluster the setting is required, since a folder of one machine
    is lost with that machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is not None:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return _own_folder()


@lru_cache(maxsize=None)
def _own_folder() -> str:
    return tempfile.mkdtemp(prefix="riskloom-")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/riskloom/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> DataFrame:
    """Compute ``df`` once into the shared folder and read it back.

    The written rows outlive any executor, cut the lineage, and are columnar,
    so later steps read only what they need.  What was shuffled for them goes
    at once instead of when the driver collects its garbage.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "table")
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
    made = spark.read.schema(df.schema).parquet(path)
    if _stored.get() is not None:
        _stored.get().append((made, path))
    return made


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """What is materialized inside is deleted at the end, but for what is kept.

    Yields ``keep``, which takes a frame and returns it stored; it belongs to the
    scope around this one, if there is one.  Nothing else that was made inside
    may be read afterwards.
    """
    made: list[tuple[DataFrame, str]] = []
    kept: list[tuple[DataFrame, str]] = []

    def keep(df: DataFrame) -> DataFrame:
        if all(df is not stored for stored, _ in made):
            df = materialize(df)
        kept.extend(entry for entry in made if entry[0] is df)
        return df

    token = _stored.set(made)
    try:
        yield keep
    finally:
        _stored.reset(token)
        paths = {path for _, path in made} - {path for _, path in kept}
        for path in paths:
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
        if _stored.get() is not None:
            _stored.get().extend(kept)


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_LIMIT_BYTES) -> bool:
    """Whether the rows of ``df`` together stay under ``limit`` bytes.

    Runs one job over ``df``; give it a materialized frame.
    """
    width = F.lit(16 + 8 * len(df.columns))
    for name, dtype in df.dtypes:
        if dtype == "string":
            width = width + F.coalesce(F.octet_length(name), F.lit(0))
    size = df.agg(F.coalesce(F.sum(width.cast("bigint")), F.lit(0)).alias("size"))
    return size.first()["size"] <= limit


def small_side(df: DataFrame, limit: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """``df`` with a broadcast hint if it is small enough, else as it is.

    Without the hint Spark shuffles both sides and may split skewed keys.
    """
    return F.broadcast(df) if fits_broadcast(df, limit) else df
