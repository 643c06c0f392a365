"""Scoring of loan applications: checks, encodings, score, tier and points."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from riskloom import fixed_values as V
from riskloom.functions.numeric import half_even
from riskloom.functions.scoring import (decision, decision_reason, predict_linear, risk_tier,
                                        score_minmax)
from riskloom.operators.features import add_bands
from riskloom.operators.woe import lookup_woe
from riskloom.sources.storage import small_side


def normalize_codes(df: DataFrame) -> DataFrame:
    """Upper-case grade and home ownership."""
    return df.withColumns({name: F.upper(name) for name in ("grade", "home_ownership")})


def application_rules() -> dict[str, tuple[Column, str]]:
    """Per field: the condition a valid value meets, and its description."""
    c = F.col
    rules = {
        "loan_amnt": ((c("loan_amnt") > 0) & (c("loan_amnt") <= 40000), "above 0, at most 40000"),
        "term_months": (c("term_months").isin(V.APPLICATION_TERMS), "36 or 60"),
        "int_rate": ((c("int_rate") > 0) & (c("int_rate") <= 35), "above 0, at most 35"),
        "grade": (c("grade").isin(V.APPLICATION_GRADES), "A to G"),
        "emp_length_yrs": (c("emp_length_yrs").between(0, 10), "0 to 10"),
        # NaN is above every number in Spark
        "annual_inc": ((c("annual_inc") > 0) & ~F.isnan("annual_inc"), "above 0"),
        "home_ownership": (c("home_ownership").isin(V.APPLICATION_OWNERSHIP),
                           "one of " + " ".join(V.APPLICATION_OWNERSHIP)),
        "dti": (c("dti").between(*V.DTI_RANGE), "0 to 60"),
        "fico_avg": (c("fico_avg").between(*V.FICO_RANGE), "580 to 850"),
        "revol_util": (c("revol_util").between(0, 100), "0 to 100"),
        "verification_status": (c("verification_status").isNotNull(), "present"),
        "purpose": (c("purpose").isNotNull(), "present"),
    }
    for count in ("inq_last_6mths", "open_acc", "pub_rec", "total_acc", "delinq_2yrs"):
        rules[count] = ((c(count) >= 0) & ~F.isnan(count), "0 or more")
    return rules


def check_applications(df: DataFrame) -> DataFrame:
    """Normalized applications with ``errors``, an array that is empty if all is well."""
    ready = normalize_codes(df)
    kind = "application_type"
    given = F.col(kind) if kind in df.columns else F.lit(None).cast("string")
    ready = ready.withColumn(kind, F.coalesce(given, F.lit(V.DEFAULT_APPLICATION_TYPE)))
    problems = [F.when(~F.coalesce(good, F.lit(False)), f"{field}: {text}")
                for field, (good, text) in application_rules().items()]
    return ready.withColumn("errors", F.array_compact(F.array(*problems)))


def validate_applications(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid applications, and rejects with their ``errors``."""
    checked = check_applications(df)
    good = F.size("errors") == 0
    return checked.where(good).drop("errors"), checked.where(~good)


def join_points(long: DataFrame, points: DataFrame) -> DataFrame:
    """Long (feature, woe) rows with their points; features without points drop out."""
    side = small_side(points.select("feature", "points_per_unit_woe"))
    return (long.join(side, "feature")
            .withColumn("points", half_even(F.col("woe") * F.col("points_per_unit_woe"), 2)))


def sort_contributions(pointed: DataFrame, key: str = "id") -> DataFrame:
    """Named contributions of each application, most harmful first, numbered from 1.

    The few contributions of one application are sorted as one array, so
    applications are neither ordered among each other nor dealt out by range.
    """
    named = F
    for feature, name in V.FACTOR_NAMES.items():
        named = named.when(F.col("feature") == feature, name)
    factor = named.otherwise(F.col("feature"))
    listed = pointed.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(
        F.col("points").alias("contribution"), factor.alias("factor")))).alias("listed"))
    placed = listed.select(key, F.posexplode("listed").alias("place", "c"))
    return placed.select(key, (F.col("place") + 1).alias("place"), "c.factor", "c.contribution")


def points_struct(points: DataFrame, features: list[str] = V.WOE_FEATURES) -> Column:
    """Points per unit of every feature as one struct value, NULL where absent."""
    wide = points.agg(*[F.max(F.when(F.col("feature") == f, F.col("points_per_unit_woe"))).alias(f)
                        for f in features])
    return wide.select(F.struct(*features)).scalar()


def score_points(df: DataFrame, points: DataFrame,
                 features: list[str] = V.WOE_FEATURES) -> DataFrame:
    """``df`` with a map from feature to its points, without a shuffle."""
    unit = F.col("_unit")
    entries = [part for f in features for part in
               (F.lit(f), half_even(F.col(f) * unit[f], 2))]
    pointed = df.withColumn("_unit", points_struct(points, features))
    return pointed.withColumn("scorecard_points", F.map_filter(
        F.create_map(*entries), lambda _, value: value.isNotNull())).drop("_unit")


def score_valid(valid: DataFrame, woe: DataFrame, points: DataFrame, coefficients: dict[str, float],
                intercept: float, key: str = "id") -> DataFrame:
    """Scores of checked applications.

    Narrow all through: the WoE table is broadcast (behind a size check) and the
    points come in as one value.
    """
    encoded = score_points(lookup_woe(add_bands(valid), woe), points)
    scored = encoded.withColumn("pd", predict_linear(coefficients, intercept))
    scored = scored.withColumn("credit_score", score_minmax(F.col("pd")))
    score = F.col("credit_score")
    return scored.select(
        key, "credit_score", half_even(F.col("pd"), 6).alias("probability_of_default"),
        risk_tier(score).alias("risk_tier"), decision(score).alias("decision"),
        decision_reason(score).alias("decision_reason"), "scorecard_points")


def score_or_reject(apps: DataFrame, woe: DataFrame, points: DataFrame,
                    coefficients: dict[str, float], intercept: float,
                    key: str = "id") -> tuple[DataFrame, DataFrame]:
    """Scores of the valid applications, and the rejected ones with their ``errors``."""
    valid, rejects = validate_applications(apps)
    return score_valid(valid, woe, points, coefficients, intercept, key), rejects


def score_applications(apps: DataFrame, woe: DataFrame, points: DataFrame,
                       coefficients: dict[str, float], intercept: float,
                       key: str = "id") -> DataFrame:
    """The scores of ``score_or_reject``; the same plan serves batch and stream."""
    return score_or_reject(apps, woe, points, coefficients, intercept, key)[0]


def batch_decision_summary(scored: DataFrame) -> DataFrame:
    """Totals of a batch; whatever is not approved counts as declined."""
    approved = F.count_if(F.col("decision") == "APPROVED")
    return scored.agg(F.count("*").alias("total_applications"), approved.alias("approved"),
                      (F.count("*") - approved).alias("declined"))
