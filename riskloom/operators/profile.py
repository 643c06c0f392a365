"""Data quality profile of numeric columns and descriptions of layers."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from riskloom import fixed_values as V
from riskloom.functions.numeric import dround, half_even
from riskloom.operators.quantiles import exact_quantiles, value_counts
from riskloom.sources.storage import materialize

HLL_BITS, KLL_SIZE = 14, 400
QUARTILES = {"p25": 0.25, "p50": 0.50, "p75": 0.75}


def unpivot_numeric(df: DataFrame, columns: list[str], ids: list[str] = (),
                    name: str = "column") -> DataFrame:
    """Long form (ids, column name, value as double)."""
    numbers = df.select(*ids, *[F.col(c).cast("double").alias(c) for c in columns])
    return numbers.unpivot(list(ids), columns, name, "value")


def profile_columns(df: DataFrame, columns: list[str] = V.PROFILE_COLUMNS,
                    approximate: bool = False) -> DataFrame:
    """One row per column: counts, distinct values, moments, range, quartiles.

    All is exact and the layer is scanned once, into counts per column and
    value.  ``approximate`` takes moments and sketches in a single pass instead
    and never shuffles values.
    """
    if approximate:
        return merged_profile(profile_parts(df, columns=columns))
    return _rounded(_exact(materialize(value_counts(unpivot_numeric(df, columns), ["column"]))))


def _rounded(stats: DataFrame) -> DataFrame:
    null_pct = half_even(F.try_divide(F.col("null_count") * 100.0, F.col("total_rows")), 2)
    return stats.select(
        "column", "total_rows", "null_count", null_pct.alias("null_pct"), "distinct_count",
        *[dround(F.col(name), 4).alias(name)
          for name in ("mean", "std_dev", "min", "max", *QUARTILES)])


def profile_parts(df: DataFrame, by: list[str] = (), columns: list[str] = V.PROFILE_COLUMNS) -> DataFrame:
    """What ``merged_profile`` needs of each group of rows: one row per group and column.

    Counts, range, mean and variance, and two sketches: one of distinct values
    (standard error 0.8 percent) and one of ranks (quartiles within 1 percent
    of their rank).  All are taken map-side, so no value is shuffled.  Parts are
    meant to be stored: a new part of a layer is profiled alone and merged.
    """
    long = unpivot_numeric(df, columns, by)
    hashed = F.when(F.col("value").isNotNull(), F.xxhash64(F.col("value") + 0.0))  # -0 is 0
    return long.groupBy(*by, "column").agg(
        F.count("*").alias("total_rows"), F.count("value").alias("n"),
        F.avg("value").alias("mean"), F.var_pop("value").alias("variance"),
        F.min("value").alias("min"), F.max("value").alias("max"),
        F.hll_sketch_agg(hashed, HLL_BITS).alias("distinct"), F.kll_sketch_agg_double("value", KLL_SIZE).alias("ranks"))


def merged_profile(parts: DataFrame) -> DataFrame:
    """The profile of all rows behind ``parts``, with distinct values and quartiles estimated."""
    whole = W.partitionBy("column")
    mean = F.try_divide(F.sum(F.col("mean") * F.col("n")).over(whole), F.sum("n").over(whole))
    centred = parts.withColumn("off", F.col("n") * (F.col("variance") + F.pow(F.col("mean") - mean, 2)))
    present = F.col("n") > 0
    merged = centred.groupBy("column").agg(
        F.sum("total_rows").alias("total_rows"), F.sum("n").alias("n"), F.min("min").alias("min"), F.max("max").alias("max"),
        F.try_divide(F.sum(F.col("mean") * F.col("n")), F.sum("n")).alias("mean"), F.sum("off").alias("off"),
        F.hll_sketch_estimate(F.hll_union_agg(F.when(present, F.col("distinct")))).alias("distinct_count"),
        F.kll_merge_agg_double(F.when(present, F.col("ranks")), KLL_SIZE).alias("ranks"))
    quartiles = [F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("ranks", F.lit(p))).alias(name)
                 for name, p in QUARTILES.items()]
    return _rounded(merged.select(
        "column", "total_rows", (F.col("total_rows") - F.col("n")).alias("null_count"),
        F.coalesce("distinct_count", F.lit(0)).alias("distinct_count"), "mean",
        F.sqrt(F.try_divide(F.col("off"), F.nullif(F.col("n") - 1, F.lit(0)))).alias("std_dev"), "min", "max", *quartiles))


def _exact(counts: DataFrame) -> DataFrame:
    """Statistics from value counts.  Joined sides have a row per profiled column."""
    value, n = F.col("value"), F.col("n")
    present = F.sum(F.when(value.isNotNull(), n))
    base = counts.groupBy("column").agg(
        F.sum("n").alias("total_rows"),
        F.coalesce(F.sum(F.when(value.isNull(), n)), F.lit(0)).alias("null_count"),
        F.count("value").alias("distinct_count"),
        F.try_divide(F.sum(value * n), present).alias("mean"),
        F.min("value").alias("min"), F.max("value").alias("max"))
    centred = counts.join(F.broadcast(base.select("column", "mean")), "column")
    spread = centred.groupBy("column").agg(F.sqrt(F.try_divide(
        F.sum(n * F.pow(value - F.col("mean"), 2)), present - 1)).alias("std_dev"))
    quantiles = exact_quantiles(counts, ["column"], list(QUARTILES.values()))
    wide = quantiles.groupBy("column").agg(*[
        F.max(F.when(F.col("probability") == p, F.col("quantile"))).alias(name)
        for name, p in QUARTILES.items()])
    return (base.join(F.broadcast(spread), "column", "left")
            .join(F.broadcast(wide), "column", "left"))


def top_null_columns(profile: DataFrame, n: int = 10) -> DataFrame:
    return profile.orderBy(F.desc_nulls_last("null_pct"), "column").limit(n)


def layer_summary(df: DataFrame) -> DataFrame:
    """Row count and bad rate of a layer."""
    return df.agg(F.count("*").alias("n_rows"), dround(F.avg("is_bad"), 4).alias("bad_rate"))


def describe_layer(df: DataFrame) -> DataFrame:
    """One row per column: name, type, and the layer's shape and bad rate."""
    columns = F.array(*[
        F.struct(F.lit(i).alias("position"), F.lit(name).alias("column"), F.lit(kind).alias("dtype"))
        for i, (name, kind) in enumerate(df.dtypes, start=1)])
    shape = layer_summary(df).withColumn("n_columns", F.lit(len(df.columns)))
    return shape.withColumn("c", F.explode(columns)).select(
        "c.position", "c.column", "c.dtype", "n_rows", "n_columns", "bad_rate")
