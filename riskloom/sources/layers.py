"""Warehouse layers: namespaces, tables by path or name, split scans, samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from riskloom.sources import versions

LAYERS = ("raw", "staging", "profile", "features")


def create_layers(spark: SparkSession, names: tuple[str, ...] = LAYERS,
                  root: str | None = None) -> None:
    """A namespace per layer, its tables under ``root`` or the warehouse folder."""
    for name in names:
        place = "" if root is None else f" LOCATION '{root.rstrip('/')}/{name}'"
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{place}")


def write_layer(df: DataFrame, target: str, partition_by: str | None = None) -> DataFrame:
    """Replace a layer and return it as read back.

    ``target`` is a path when it holds a slash, else a table name.  The layer
    before stays as it is until all of the new one is there, and stays readable
    if the write fails; ``df`` may be computed from it.
    """
    if "/" in target:
        versions.write_path(df, target, partition_by)
    else:
        versions.write_table(df, target, partition_by)
    return read_layer(df.sparkSession, target)


def read_layer(spark: SparkSession, source: str) -> DataFrame:
    """The current version of a layer, or any Parquet path or table."""
    return versions.read_path(spark, source) if "/" in source else spark.table(source)


def filter_split(df: DataFrame, split: str) -> DataFrame:
    return df.where(F.col("split") == split)


def read_split(spark: SparkSession, source: str, split: str, columns: list[str]) -> DataFrame:
    """Chosen columns of one split; repeated names are read once."""
    wanted = list(dict.fromkeys(columns))
    return filter_split(read_layer(spark, source), split).select(*wanted)


def sample_split(df: DataFrame, n: int, split: str, key: str = "id") -> DataFrame:
    """``n`` rows of one split, always the same ones: those whose key has the least md5.

    The split is taken first and sampled after, so the sample has ``n`` rows
    whatever the share of the split.  Rows are counted by the first four digits
    of the md5; all rows before the digits in which the ``n``-th falls are
    taken as they come, and only rows with those digits are sorted.
    """
    mixed = F.md5(F.col(key).cast("string"))
    part = filter_split(df, split)
    prefix = F.substring(mixed, 1, 4)
    # rows without a key come last
    counts = part.groupBy(F.coalesce(prefix, F.lit("~")).alias("prefix")).count()
    before = F.sum("count").over(W.orderBy("prefix").rowsBetween(W.unboundedPreceding, -1))
    edge = (counts.withColumn("before", F.coalesce(before, F.lit(0)))
            .where((F.col("before") < n) & (F.col("before") + F.col("count") >= n)).first())
    if edge is None:
        return part if n > 0 else part.limit(0)
    own = F.coalesce(prefix, F.lit("~"))
    last = part.where(own == edge.prefix).orderBy(F.asc_nulls_last(mixed), key).limit(n - edge.before)
    return part.where(own < edge.prefix).unionByName(last)


def sample_fraction(df: DataFrame, n: int, split: str, seed: int = 42) -> DataFrame:
    """About ``n`` rows of one split without any sort; costs one count."""
    part = filter_split(df, split)
    total = part.count()
    return part.sample(fraction=min(1.0, n / total) if total else 1.0, seed=seed)


def register_view(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)
