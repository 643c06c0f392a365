"""Models: coefficients as expressions, a scorecard by Newton's method, trees with pyspark.ml."""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations_with_replacement

import numpy as np
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from riskloom import fixed_values as V
from riskloom.functions.numeric import half_even
from riskloom.functions.scoring import (odds_scale, predict_linear, score_minmax, score_odds)
from riskloom.operators.cleaning import fill_missing
from riskloom.operators.woe import woe_extremes
from riskloom.sources.storage import materialize

PD_DIGITS = 6


def score_champion(df: DataFrame, coefficients: dict[str, float], intercept: float,
                   name: str = "champ_pd") -> DataFrame:
    """Default probability from the WoE features; NULL inputs count as 0."""
    return _score_linear(df, coefficients, intercept, V.WOE_FEATURES, name)


def score_challenger(df: DataFrame, coefficients: dict[str, float], intercept: float,
                     name: str = "chall_pd") -> DataFrame:
    """Default probability from the raw features; NULL inputs count as 0."""
    return _score_linear(df, coefficients, intercept, V.RAW_FEATURES, name)


def _score_linear(df: DataFrame, coefficients: dict[str, float], intercept: float,
                  features: list[str], name: str) -> DataFrame:
    unknown = set(coefficients) - set(features)
    if unknown:
        raise ValueError(f"not inputs of this model: {sorted(unknown)}")
    filled = {f: F.coalesce(F.col(f).cast("double"), F.lit(0.0)).alias(f) for f in coefficients}
    inner = df.withColumn("_inputs", F.struct(*filled.values()))
    terms = {f"_inputs.{f}": weight for f, weight in coefficients.items()}
    pd = half_even(predict_linear(terms, intercept), PD_DIGITS)
    return inner.withColumn(name, pd).drop("_inputs")


def balanced_weight(df: DataFrame, label: str = "is_bad") -> Column:
    """Weight that gives both classes half of the total each."""
    rate = df.agg(F.avg(label).alias("rate")).scalar()
    return F.when(F.col(label) == 1, 0.5 / rate).otherwise(0.5 / (1 - rate))


def _vectors(df: DataFrame, features: list[str]) -> DataFrame:
    ready = fill_missing(df.withColumns({f: F.col(f).cast("double") for f in features}), features)
    return VectorAssembler(inputCols=features, outputCol="inputs").transform(ready)


@dataclass
class Scorecard:
    """A logistic regression: weights by input, and how its fit ended."""
    coefficients: dict[str, float]
    intercept: float
    steps: int
    change: float


def _newton_sums(design: DataFrame, names: list[str], weights: list[float]) -> tuple[np.ndarray, np.ndarray]:
    """Gradient and curvature of the weighted log-likelihood, from one aggregate over the loans."""
    linear = " + ".join(f"{float(w)!r}D * `{name}`" for name, w in zip(names, weights))
    scored = design.selectExpr("*", f"1D / (1D + exp(-({linear}))) AS _p").selectExpr(
        *[f"`{name}`" for name in names], "_w * (_y - _p) AS _g", "_w * _p * (1D - _p) AS _h")
    pairs = list(combinations_with_replacement(range(len(names)), 2))
    row = scored.selectExpr(*[f"sum(_g * `{name}`)" for name in names],
                            *[f"sum(_h * `{names[i]}` * `{names[j]}`)" for i, j in pairs]).first()
    gradient, curvature = np.array(row[:len(names)], float), np.zeros((len(names),) * 2)
    for (i, j), value in zip(pairs, row[len(names):]):
        curvature[i, j] = curvature[j, i] = value
    return gradient, curvature


def fit_scorecard(train: DataFrame, features: list[str] = V.WOE_FEATURES, balanced: bool = True,
                  tolerance: float = 1e-10, most_steps: int = 50) -> Scorecard:
    """Maximum likelihood by Newton's method; NULL inputs count as 0.

    A step is one aggregate over the loans: what the driver gets is 11 sums and
    66 sums of products, whatever the number of loans.  The inputs are stored
    once.  A step that would be too long is shortened to 5 in each weight.
    Inputs that can't be told apart share their weight, one without any spread
    gets none.  Raises a ValueError without loans of both outcomes, or if steps
    have not come under ``tolerance`` after ``most_steps``, as happens when an
    input separates the outcomes.
    """
    ready = fill_missing(train.select("is_bad", *[F.col(f).cast("double").alias(f) for f in features]), features)
    design = materialize(ready.select(
        *features, F.lit(1.0).alias("_one"), F.col("is_bad").cast("double").alias("_y"),
        (balanced_weight(train) if balanced else F.lit(1.0)).alias("_w")).where("_y IS NOT NULL"))
    outcomes = design.agg(F.min("_y").alias("low"), F.max("_y").alias("high")).first()
    if (outcomes.low, outcomes.high) != (0.0, 1.0):
        raise ValueError(f"outcomes from {outcomes.low} to {outcomes.high}, wanted both 0 and 1")
    names, weights = [*features, "_one"], np.zeros(len(features) + 1)
    for step in range(1, most_steps + 1):
        gradient, curvature = _newton_sums(design, names, weights)
        move = np.linalg.lstsq(curvature, gradient, rcond=1e-12)[0]
        weights = weights + np.clip(move, -5, 5)
        if np.abs(move).max() < tolerance:
            fitted = [float(w) for w in weights]
            return Scorecard(dict(zip(features, fitted)), fitted[-1], step, float(np.abs(move).max()))
    raise ValueError(f"no fit after {most_steps} steps, the last changed a weight by {np.abs(move).max()}")


def score_equations(train: DataFrame, model: Scorecard, balanced: bool = True) -> DataFrame:
    """(feature, observed, predicted): weighted means of outcome and probability times each input.

    Both agree at the maximum of the likelihood, so this shows that a fit is one.
    """
    features = list(model.coefficients)
    ready = fill_missing(train.select("is_bad", *[F.col(f).cast("double").alias(f) for f in features]), features)
    weight = balanced_weight(train) if balanced else F.lit(1.0)
    scored = ready.withColumns({"_w": weight, "_p": predict_linear(model.coefficients, model.intercept)})
    inputs = {"intercept": F.lit(1.0), **{f: F.col(f) for f in features}}
    rows = [F.struct(F.lit(name).alias("feature"),
                     F.try_divide(F.sum(F.col("_w") * F.col("is_bad") * x), F.sum("_w")).alias("observed"),
                     F.try_divide(F.sum(F.col("_w") * F.col("_p") * x), F.sum("_w")).alias("predicted"))
            for name, x in inputs.items()]
    return scored.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))


def scorecard_points(df: DataFrame, coefficients: dict[str, float]) -> DataFrame:
    """Points per unit of WoE: minus the odds factor times the coefficient."""
    factor, _ = odds_scale()
    rows = [(f, float(w), -factor * float(w)) for f, w in coefficients.items()]
    return df.sparkSession.createDataFrame(
        rows, "feature string, coefficient double, points_per_unit_woe double")


def coefficients_of(model: Scorecard) -> tuple[dict[str, float], float]:
    """Coefficients by name and the intercept, for ``predict_linear``."""
    return dict(model.coefficients), model.intercept


def fit_forest(train: DataFrame, features: list[str] = V.RAW_FEATURES, trees: int = 50,
               depth: int = 6, seed: int = 42):
    ready = _vectors(train, features).withColumn("label", F.col("is_bad").cast("double"))
    return RandomForestClassifier(featuresCol="inputs", labelCol="label", numTrees=trees,
                                  maxDepth=depth, seed=seed).fit(ready)


def fit_boosted(train: DataFrame, features: list[str] = V.RAW_FEATURES, rounds: int = 20,
                depth: int = 4, seed: int = 42):
    ready = _vectors(train, features).withColumn("label", F.col("is_bad").cast("double"))
    return GBTClassifier(featuresCol="inputs", labelCol="label", maxIter=rounds,
                         maxDepth=depth, seed=seed).fit(ready)


def score_with(model, df: DataFrame, features: list[str], name: str) -> DataFrame:
    """``df`` with the model's default probability, six digits."""
    probability = vector_to_array("probability")[1]
    scored = model.transform(_vectors(df, features))
    return (scored.withColumn(name, half_even(probability, PD_DIGITS))
            .drop("inputs", "rawPrediction", "probability", "prediction"))


def extreme_applicants(woe: DataFrame, coefficients: dict[str, float],
                       intercept: float) -> DataFrame:
    """PD and scores of the applicants with the lowest and highest WoE everywhere."""
    extremes = woe_extremes(woe)

    def inputs(column: str) -> list[Column]:
        return [F.coalesce(F.max(F.when(F.col("feature") == feature, F.col(column))),
                           F.lit(0.0)).alias(f"{feature}_woe") for feature in V.BINNED_FEATURES]

    both = extremes.agg(F.struct(F.lit("best").alias("applicant"), *inputs("min_woe")).alias("low"),
                        F.struct(F.lit("worst").alias("applicant"), *inputs("max_woe")).alias("high"))
    rows = both.select(F.inline(F.array("low", "high")))
    pd = F.col("pd")
    return (rows.withColumn("pd", predict_linear(coefficients, intercept))
            .select("applicant", pd, score_minmax(pd).alias("score_minmax"),
                    score_odds(pd).cast("int").alias("score_odds")))
