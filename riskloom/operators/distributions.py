"""Winsorizing, histograms and correlations."""

from __future__ import annotations

from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame, functions as F

from riskloom import fixed_values as V
from riskloom.functions.numeric import half_even
from riskloom.functions.scoring import score_minmax
from riskloom.operators.profile import unpivot_numeric
from riskloom.operators.quantiles import exact_quantiles, value_counts
from riskloom.sources.storage import materialize


def upper_caps(counts: DataFrame, p: float, reference: int) -> DataFrame:
    """A quantile of one outcome group as the cap of each column: a row per column."""
    good = counts.where(F.col("is_bad") == reference)
    return materialize(exact_quantiles(good, ["column"], [p]).select(
        "column", F.col("quantile").alias("cap")))


def winsorize_at(df: DataFrame, columns: list[str], p: float = 0.99,
                 reference: int = 0, ids: list[str] = ()) -> DataFrame:
    """Long form of ``columns`` capped at a quantile of one outcome group.

    NULL values are left out.
    """
    long = unpivot_numeric(df, columns, [*ids, "is_bad"]).where(F.col("value").isNotNull())
    good = long.where(F.col("is_bad") == reference)
    caps = upper_caps(materialize(value_counts(good, ["column", "is_bad"])), p, reference)
    return (long.join(F.broadcast(caps), "column", "left")
            .withColumn("value", F.least("value", "cap"))
            .select(*ids, "is_bad", "column", "value", "cap"))


def bin_number(value: Column, low: Column, high: Column, bins: int) -> Column:
    """0-based equal-width bin; the last one is closed on both sides, NULL is in none."""
    position = F.floor((value - low) / (high - low) * bins)
    return F.when(value.isNotNull(), F.least(F.greatest(position, F.lit(0)), F.lit(bins - 1))).cast("int")


def class_histogram(df: DataFrame, columns: list[str] = V.HISTOGRAM_COLUMNS,
                    bins: int = 50, p: float = 0.99, reference: int = 0) -> DataFrame:
    """Density histogram per column and outcome over its own capped range.

    The loans are scanned once, into value counts.  Empty bins are kept.  Ranges
    are one row per column and outcome, and bins a fixed number of each, so both
    are broadcast.  A range of a single value is widened by a half.
    """
    keys = ["column", "is_bad"]
    long = unpivot_numeric(df, columns, ["is_bad"]).where(F.col("value").isNotNull())
    counts = materialize(value_counts(long, keys))
    caps = upper_caps(counts, p, reference)
    capped = (counts.join(F.broadcast(caps), "column", "left")
              .withColumn("value", F.least("value", "cap")))
    flat = F.col("low_raw") == F.col("high_raw")
    ranges = (capped.groupBy(*keys)
              .agg(F.min("value").alias("low_raw"), F.max("value").alias("high_raw"),
                   F.sum("n").alias("n"))
              .select(*keys, "n",
                      F.when(flat, F.col("low_raw") - 0.5).otherwise(F.col("low_raw")).alias("low"),
                      F.when(flat, F.col("high_raw") + 0.5).otherwise(F.col("high_raw")).alias("high")))
    placed = (capped.withColumnRenamed("n", "loans").join(F.broadcast(ranges), keys)
              .withColumn("bin", bin_number(F.col("value"), F.col("low"), F.col("high"), bins))
              .groupBy(*keys, "bin").agg(F.sum("loans").alias("in_bin")))
    frame = ranges.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    width = (F.col("high") - F.col("low")) / bins
    filled = frame.join(F.broadcast(placed), [*keys, "bin"], "left").fillna(0, ["in_bin"])
    return filled.select(
        *keys, "bin",
        (F.col("low") + F.col("bin") * width).alias("left_edge"),
        F.col("in_bin").alias("total"),
        (F.col("in_bin") / (F.col("n") * width)).alias("density"))


def score_histogram(scored: DataFrame, probability: str = "champ_pd", bins: int = 50) -> DataFrame:
    """Loans per score bin and outcome on the unrounded min-max scale, loans without a PD left out."""
    score = score_minmax(F.col(probability), rounded=False)
    low, high = F.lit(float(V.SCORE_MIN)), F.lit(float(V.SCORE_MAX))
    width = (V.SCORE_MAX - V.SCORE_MIN) / bins
    return (scored.where(F.col(probability).isNotNull())
            .select("is_bad", bin_number(score, low, high, bins).alias("bin"))
            .groupBy("is_bad", "bin").agg(F.count("*").alias("total"))
            .withColumn("left_edge", low + F.col("bin") * width))


def correlation_matrix(df: DataFrame, columns: list[str] = V.CORRELATION_COLUMNS,
                       pilot_rows: int = 1000) -> DataFrame:
    """Pearson correlations over rows without any NULL, as (row, column, corr).

    One pass of plain sums, which merge in any order: values, and products of
    values, counted from a pilot mean.  The pilot is the mean of the first
    ``pilot_rows`` complete rows; any number near the mean will do, as it drops
    out of the result and only keeps the sums from losing digits.
    """
    complete = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).dropna()
    pilot = complete.limit(pilot_rows).agg(*[F.avg(c).alias(c) for c in columns]).first()
    # Text expressions: a hundred sums as Column objects are slow to build.
    shifted = complete.selectExpr(*[f"`{c}` - {float(pilot[c] or 0.0)!r}D AS `{c}`" for c in columns])
    pairs = list(combinations_with_replacement(columns, 2))
    sums = shifted.selectExpr("count(*) AS `|n`", *[f"sum(`{c}`) AS `{c}`" for c in columns],
                              *[f"sum(`{a}` * `{b}`) AS `{a}|{b}`" for a, b in pairs])
    moments = sums.selectExpr(*[f"`{a}|{b}` - try_divide(`{a}` * `{b}`, `|n`) AS `{a}|{b}`" for a, b in pairs])
    cells = []
    for a, b in pairs:
        value = "1D" if a == b else f"try_divide(`{a}|{b}`, sqrt(`{a}|{a}`) * sqrt(`{b}|{b}`))"
        cells += [(x, y, value) for x, y in sorted({(a, b), (b, a)})]
    entries = ", ".join(f"named_struct('feature_a', '{x}', 'feature_b', '{y}', 'corr', {value})"
                        for x, y, value in cells)
    return moments.selectExpr(f"inline(array({entries}))")


def target_correlation_rank(matrix: DataFrame, target: str = "is_bad") -> DataFrame:
    """Correlations with the target, strongest first whatever the sign."""
    return (matrix.where((F.col("feature_b") == target) & (F.col("feature_a") != target))
            .select(F.col("feature_a").alias("feature"), half_even(F.col("corr"), 4).alias("corr"))
            .orderBy(F.desc(F.abs("corr")), "feature"))
