"""Score bands, population stability and calibration."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from riskloom import fixed_values as V
from riskloom.functions.bands import cut_ordinal, cut_right, psi_status
from riskloom.functions.scoring import score_odds


def score_band_stats(scored: DataFrame, probability: str = "champ_pd", score: Column | None = None,
                     edges: list = V.SCORE_BAND_CUT[0],
                     labels: list[str] = V.SCORE_BAND_CUT[1]) -> DataFrame:
    """Loans and bad rate per score band; empty bands are absent.

    The score defaults to the rounded odds scale of ``probability``.
    """
    value = score_odds(F.col(probability)) if score is None else score
    return (scored.select(value.alias("score"), "is_bad")
            .select(cut_ordinal(F.col("score"), edges).alias("band_ord"),
                    cut_right(F.col("score"), edges, labels).alias("score_band"), "is_bad")
            .where(F.col("band_ord").isNotNull())
            .groupBy("band_ord", "score_band")
            .agg(F.count("is_bad").alias("total"), F.sum("is_bad").alias("bad"))
            .withColumn("bad_rate", F.col("bad") * 100.0 / F.col("total"))
            .orderBy("band_ord"))


def align_bands(expected: DataFrame, actual: DataFrame, score: str = "score",
                edges: list = V.PSI_CUT[0], labels: list[str] = V.PSI_CUT[1]) -> DataFrame:
    """Counts of both populations for every band, empty bands included.

    One global aggregate counts all bands, so every band has its place without
    a join and each population is scanned once.
    """
    both = expected.select(score, F.lit(True).alias("is_expected")).unionByName(
        actual.select(score, F.lit(False).alias("is_expected")))
    placed = both.select(cut_ordinal(F.col(score), edges).alias("ord"), "is_expected")
    sides = {"exp": F.col("is_expected"), "act": ~F.col("is_expected")}
    wide = placed.agg(*[F.count_if((F.col("ord") == i) & side).alias(f"{name}_{i}")
                        for i in range(1, len(labels) + 1) for name, side in sides.items()])
    rows = F.array(*[F.struct(F.lit(i).alias("band_ord"), F.lit(label).alias("band"),
                              F.col(f"exp_{i}").alias("exp_count"),
                              F.col(f"act_{i}").alias("act_count"))
                     for i, label in enumerate(labels, start=1)])
    totals = {name: sum((F.col(f"{name}_{i}") for i in range(1, len(labels) + 1)), F.lit(0))
              for name in sides}
    return wide.select(F.inline(rows), totals["exp"].alias("exp_total"),
                       totals["act"].alias("act_total"))


def psi(expected: DataFrame, actual: DataFrame, score: str = "score",
        edges: list = V.PSI_CUT[0], labels: list[str] = V.PSI_CUT[1]) -> DataFrame:
    """Shares of both populations and the stability component of every band."""
    share_e = F.try_divide(F.col("exp_count"), F.col("exp_total"))
    share_a = F.try_divide(F.col("act_count"), F.col("act_total"))
    component = (F.col("act_pct") - F.col("exp_pct")) * F.log(
        (F.col("act_pct") + V.PSI_EPSILON) / (F.col("exp_pct") + V.PSI_EPSILON))
    return (align_bands(expected, actual, score, edges, labels)
            .withColumns({"exp_pct": share_e, "act_pct": share_a})
            .withColumn("psi_component", component)
            .select("band_ord", "band", "exp_pct", "act_pct", "psi_component"))


def psi_total(bands: DataFrame) -> DataFrame:
    """The index of a whole population and how to read it."""
    return (bands.agg(F.sum("psi_component").alias("psi"))
            .withColumn("status", psi_status(F.col("psi"))))


def calibration_curve(scored: DataFrame, probability: str = "prob", bins: int = 10,
                      by: list[str] = ()) -> DataFrame:
    """Mean prediction and bad share per uniform bin; empty bins are absent.

    A probability on a bin edge belongs to the lower bin.  Loans without a
    probability are in no bin.
    """
    prob = F.col(probability)
    number = F.least(F.greatest(F.ceil(prob * bins), F.lit(1)), F.lit(bins)).cast("int")
    return (scored.where(prob.isNotNull()).select(*by, number.alias("bin"), prob.alias("p"), "is_bad")
            .groupBy(*by, "bin")
            .agg(F.avg("p").alias("mean_predicted"), F.avg("is_bad").alias("bad_share"),
                 F.count("*").alias("total")))
