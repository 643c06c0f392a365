"""Champion against challenger: tests, loss and the decision."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from riskloom import fixed_values as V
from riskloom.functions.numeric import half_even, norm_sf

CHAMPION, CHALLENGER = "champion", "challenger"
POSTERIOR = ["prob_challenger_wins", "expected_uplift", "uplift_ci_lower", "uplift_ci_upper"]


def one_row(*frames: DataFrame) -> DataFrame:
    """One-row frames with different columns side by side, without a join."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])


def _of(model: str, column: str) -> Column:
    return F.max(F.when(F.col("model") == model, F.col(column)))


def ztest_auc(summary: DataFrame, alpha: float = V.SIGNIFICANCE_LEVEL,
              replicates: DataFrame | None = None) -> DataFrame:
    """One-tailed z-test of the challenger's AUC against the champion's.

    Both bootstrap distributions count as independent.  Given paired
    ``replicates`` the deviation is taken from the paired differences instead;
    those of tick draws are not paired and raise a ValueError.
    """
    sides = summary.agg(
        _of(CHAMPION, "mean").alias("a"), _of(CHALLENGER, "mean").alias("b"),
        F.sqrt(_of(CHAMPION, "std") ** 2 + _of(CHALLENGER, "std") ** 2).alias("se"))
    if replicates is not None:
        if not replicates.schema["replicate"].metadata.get("paired", True):
            raise ValueError("replicates of tick draws are not paired; use hashed_replicates")
        paired = (replicates.groupBy("replicate")
                  .agg(_of(CHAMPION, "auc").alias("a"), _of(CHALLENGER, "auc").alias("b")))
        spread = paired.agg(F.stddev_pop(F.col("b") - F.col("a")).alias("se"))
        sides = one_row(sides.drop("se"), spread)
    p = norm_sf(F.col("z"))
    return (sides.withColumn("d", F.col("b") - F.col("a"))
            .withColumn("z", F.try_divide(F.col("d"), F.col("se")))
            .select(half_even(F.col("d"), 6).alias("auc_diff"),
                    half_even(F.col("z"), 4).alias("z_score"),
                    half_even(p, 6).alias("p_value"),
                    (p < alpha).alias("significant"), F.lit(float(alpha)).alias("alpha")))


def difference_at(a: np.ndarray, b: np.ndarray, rank: int) -> float:
    """The ``rank``-th least (from 0) of all differences b_j - a_i of two ascending lists.

    The answer is narrowed down over the doubles in their order, 64 halvings at
    most; how many differences are at most x is a binary search per b_j, since
    b_j - a_i falls as i grows.  No list of differences is ever made.
    """
    def ordered(x: float) -> int:
        bits = int(np.float64(x).view(np.int64))
        return bits if bits >= 0 else -(bits & (2**63 - 1))

    def double(n: int) -> float:
        return float(np.int64(n).view(np.float64)) if n >= 0 else -float(np.int64(-n).view(np.float64))

    def at_most(x: float) -> int:
        low, high = np.zeros(len(b), np.int64), np.full(len(b), len(a))
        while (low < high).any():
            middle = (low + high) // 2
            fits = (b - a[np.minimum(middle, len(a) - 1)] <= x) & (low < high)
            high = np.where(fits, middle, high)
            low = np.where(fits | (low >= high), low, middle + 1)
        return int((len(a) - low).sum())

    low, high = ordered(b[0] - a[-1]), ordered(b[-1] - a[0])
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if at_most(double(middle)) > rank else (middle + 1, high)
    return double(low)


def difference_quantile(a: np.ndarray, b: np.ndarray, share: float) -> float:
    """A quantile of all differences b_j - a_i, linear between neighbouring ranks."""
    position = share * (len(a) * len(b) - 1)
    low, high = (difference_at(a, b, int(r)) for r in (np.floor(position), np.ceil(position)))
    return low + (high - low) * (position - np.floor(position))


def _posterior(replicates: pd.DataFrame) -> pd.DataFrame:
    a, b = (np.sort(replicates.loc[replicates["model"] == m, "auc"].to_numpy(float)) for m in (CHAMPION, CHALLENGER))
    if not len(a) or not len(b):
        return pd.DataFrame([[None] * 4], columns=POSTERIOR, dtype=float)
    wins = int(np.searchsorted(a, b, side="left").sum())
    bounds = [difference_quantile(a, b, share) for share in (0.025, 0.975)]
    return pd.DataFrame([[wins / (len(a) * len(b)), b.mean() - a.mean(), *bounds]], columns=POSTERIOR)


def bayesian_ab(replicates: DataFrame) -> DataFrame:
    """Chance that the challenger wins and the spread of its uplift.

    Both models draw from their bootstrap distributions independently, so every
    pair of replicates is equally likely, and all of them are counted: the
    chance by ranks of one list in the other, the bounds by selection on the two
    sorted lists.  One task reads one number per model and replicate.  Without
    replicates of a model all is NULL.
    """
    exact = replicates.select("model", "auc").groupBy().applyInPandas(
        _posterior, ", ".join(f"{name} double" for name in POSTERIOR))
    chance, *uplift = POSTERIOR
    return exact.select(half_even(F.col(chance), 4).alias(chance),
                        *[half_even(F.col(name), 6).alias(name) for name in uplift])


def business_impact(scored: DataFrame, threshold: float = V.APPROVAL_THRESHOLD,
                    lgd: float = V.LOSS_GIVEN_DEFAULT, champion: str = "champ_pd",
                    challenger: str = "chall_pd") -> DataFrame:
    """Approvals, expected loss and approved bads of both models in one pass.

    A loan is approved strictly below the threshold; expected loss is
    probability times loss given default times amount over approved loans.
    """
    measures = [F.count("*").alias("n_loans")]
    for name, column in (("champ", champion), ("chall", challenger)):
        pd, approved = F.col(column), F.col(column) < threshold
        measures += [
            F.avg(approved.cast("int")).alias(f"{name}_rate"),
            F.coalesce(F.sum(F.when(approved, pd * lgd * F.col("loan_amnt"))),
                       F.lit(0.0)).alias(f"{name}_el"),
            F.coalesce(F.sum(F.when(approved, F.col("is_bad"))), F.lit(0)).alias(f"{name}_fn")]
    c = F.col
    saved = c("champ_el") - c("chall_el")
    return scored.agg(*measures).select(
        "n_loans", F.lit(float(threshold)).alias("threshold"), F.lit(float(lgd)).alias("lgd"),
        half_even(c("champ_rate"), 4).alias("champ_approval_rate"),
        half_even(c("chall_rate"), 4).alias("chall_approval_rate"),
        half_even(c("champ_el"), 0).alias("champ_expected_loss"),
        half_even(c("chall_el"), 0).alias("chall_expected_loss"),
        half_even(saved, 0).alias("el_reduction"),
        half_even(F.try_divide(saved, c("champ_el")) * 100, 2).alias("el_reduction_pct"),
        c("champ_fn").alias("champ_false_negatives"),
        c("chall_fn").alias("chall_false_negatives"),
        (c("champ_fn") - c("chall_fn")).alias("fn_reduction"))


def _deploy() -> Column:
    return (F.col("significant") & (F.col("prob_challenger_wins") > V.WIN_PROBABILITY)
            & F.col("challenger_wins"))


def _word() -> Column:
    return F.when(_deploy(), "DEPLOY CHALLENGER").otherwise("RETAIN CHAMPION")


def decide(ztest: DataFrame, bayes: DataFrame, ks: DataFrame) -> DataFrame:
    """Deploy only if significant, likely to win and ahead in KS."""
    return one_row(ztest, bayes, ks).select(
        "significant", "prob_challenger_wins", "challenger_wins", _word().alias("decision"))


def decision_record(summary: DataFrame, ztest: DataFrame, bayes: DataFrame, ks: DataFrame,
                    impact: DataFrame) -> DataFrame:
    """Every number behind the decision, in one row."""
    auc = summary.agg(*[
        _of(model, measure).alias(f"{model}_auc_{measure}")
        for model in (CHAMPION, CHALLENGER) for measure in ("mean", "std", "lower", "upper")])
    everything = one_row(auc, ztest, bayes, ks, impact)
    return everything.select(
        *everything.columns,
        (2 * F.col("champion_auc_mean") - 1).alias("champion_gini"),
        (2 * F.col("challenger_auc_mean") - 1).alias("challenger_gini"),
        (F.col("chall_approval_rate") - F.col("champ_approval_rate")).alias("approval_rate_diff"),
        F.when(F.col("challenger_auc_mean") > F.col("champion_auc_mean"), CHALLENGER)
        .otherwise(CHAMPION).alias("auc_winner"),
        F.when(F.col("challenger_wins"), CHALLENGER).otherwise(CHAMPION).alias("ks_winner"),
        F.col("significant").alias("rationale_significant"),
        (F.col("prob_challenger_wins") > V.WIN_PROBABILITY).alias("rationale_likely_win"),
        (F.col("el_reduction") > 0).alias("rationale_less_loss"),
        _word().alias("decision"))
