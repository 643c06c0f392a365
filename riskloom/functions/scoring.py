"""Probability of default, score scales and risk tiers."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

from riskloom import fixed_values as V
from riskloom.functions.numeric import clip, half_even


def predict_linear(coefficients: dict[str, float], intercept: float) -> Column:
    """Logistic regression probability from columns named in ``coefficients``."""
    linear = F.lit(float(intercept))
    for name, weight in coefficients.items():
        linear = linear + F.lit(float(weight)) * F.col(name)
    return 1 / (1 + F.exp(-linear))


def score_minmax(pd: Column, rounded: bool = True) -> Column:
    """Score by rescaling the model's PD range to 300..850."""
    low, high = V.MINMAX_PD
    raw = V.SCORE_MAX - (pd - low) / (high - low) * (V.SCORE_MAX - V.SCORE_MIN)
    if not rounded:
        return clip(raw, V.SCORE_MIN, V.SCORE_MAX)
    return clip(half_even(raw), V.SCORE_MIN, V.SCORE_MAX).cast("int")


def odds_scale() -> tuple[float, float]:
    """Factor and offset of the points-to-double-the-odds scale."""
    factor = V.POINTS_TO_DOUBLE / math.log(2)
    return factor, V.BASE_SCORE - factor * math.log(V.BASE_ODDS)


def score_odds(pd: Column, rounded: bool = True) -> Column:
    """Score on the log-odds scale, 300..850."""
    factor, offset = odds_scale()
    # pd = 0 has infinite odds: a NULL ratio falls through to the top score.
    odds = F.greatest(F.try_divide(1 - pd, pd), F.lit(V.ODDS_FLOOR))
    raw = F.lit(offset) + F.lit(factor) * F.log(odds)
    score = F.when(pd == 0, F.lit(float(V.SCORE_MAX))).when(
        pd.isNotNull(), clip(raw, V.SCORE_MIN, V.SCORE_MAX))
    return half_even(score) if rounded else score


def _tier_part(score: Column, part: int) -> Column:
    result = F
    for row in V.RISK_TIERS[:-1]:
        result = result.when(score >= row[0], row[part])
    return result.when(score.isNotNull(), V.RISK_TIERS[-1][part])


def risk_tier(score: Column) -> Column:
    return _tier_part(score, 1)


def decision(score: Column) -> Column:
    return _tier_part(score, 2)


def decision_reason(score: Column) -> Column:
    return _tier_part(score, 3)
