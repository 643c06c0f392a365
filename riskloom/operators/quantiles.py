"""Exact interpolated quantiles without gathering a column in one place.

Values are counted first, so repeated values are one row.  A quantile is then
found by narrowing: values are grouped by their leading three decimal digits,
running totals over these few groups show which group holds the wanted rank,
the same is done with six digits inside that group, and only values that agree
in six digits are ever ordered together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

DIGIT_LEVELS = (3, 6)


def value_counts(long: DataFrame, by: list[str], value: str = "value") -> DataFrame:
    return long.groupBy(*by, value).agg(F.count("*").alias("n"))


def leading_digits(value: Column, digits: int) -> Column:
    """A key that never decreases as ``value`` grows, by sign, size and digits."""
    sign = F.signum(value)
    size = F.when(value == 0, 0.0).otherwise(F.floor(F.log10(F.abs(value))).cast("double"))
    step = F.pow(F.lit(10.0), size - (digits - 1))
    return F.struct(sign.alias("sign"), (sign * size).alias("size"),
                    F.floor(value / step).cast("double").alias("digits"))


def _hit(groups: DataFrame, window: W) -> DataFrame:
    """Groups with the running total before them, kept where they hold ``rest``."""
    before = F.coalesce(
        F.sum("n").over(window.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    return (groups.withColumn("before", before)
            .where((F.col("before") <= F.col("rest"))
                   & (F.col("rest") < F.col("before") + F.col("n")))
            .withColumn("rest", F.col("rest") - F.col("before")))


def exact_quantiles(counts: DataFrame, by: list[str], probabilities: list[float],
                    value: str = "value") -> DataFrame:
    """One row per group and probability, linear between neighbouring ranks.

    ``counts`` comes from ``value_counts`` and is read three times, so it should
    be materialized.  The chosen groups are broadcast:
    they number two per probability and ``by`` group, so ``by`` is meant for
    few groups such as profiled columns.
    """
    present = counts.where(F.col(value).isNotNull()).withColumns(
        {f"key{digits}": leading_digits(F.col(value), digits) for digits in DIGIT_LEVELS})
    first, second = (f"key{digits}" for digits in DIGIT_LEVELS)

    whole = W.partitionBy(*by)
    coarse = (present.groupBy(*by, first).agg(F.sum("n").alias("n"))
              .withColumn("last_rank", F.sum("n").over(whole) - 1)
              .withColumn("before", F.coalesce(
                  F.sum("n").over(whole.orderBy(first).rowsBetween(W.unboundedPreceding, -1)),
                  F.lit(0))))
    targets = F.array(*[
        F.struct(F.lit(float(p)).alias("probability"), F.lit(side).alias("side"),
                 (F.floor if side == "low" else F.ceil)(F.col("last_rank") * float(p)).alias("rank"),
                 (F.col("last_rank") * float(p)).alias("position"))
        for p in probabilities for side in ("low", "high")])
    chosen = (coarse.withColumn("target", F.explode(targets))
              .where((F.col("before") <= F.col("target.rank"))
                     & (F.col("target.rank") < F.col("before") + F.col("n")))
              .select(*by, first, "target.probability", "target.side", "target.position",
                      (F.col("target.rank") - F.col("before")).alias("rest")))

    one = [*by, "probability", "side"]
    carried = [*one, "position", "rest"]
    fine = (present.join(F.broadcast(chosen), [*by, first])
            .groupBy(*carried, first, second).agg(F.sum("n").alias("n")))
    chosen = (_hit(fine, W.partitionBy(*one).orderBy(second))
              .select(*carried, second))
    exact = (present.join(F.broadcast(chosen), [*by, second])
             .select(*carried, value, "n"))
    found = _hit(exact, W.partitionBy(*one).orderBy(value))

    ends = found.groupBy(*by, "probability").agg(
        F.max("position").alias("position"),
        F.max(F.when(F.col("side") == "low", F.col(value))).alias("low"),
        F.max(F.when(F.col("side") == "high", F.col(value))).alias("high"))
    share = F.col("position") - F.floor("position")
    return ends.select(*by, "probability",
                       (F.col("low") + share * (F.col("high") - F.col("low"))).alias("quantile"))
