"""Named queries and their SQL, collected by decoration."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from checks import loan_view as L
from riskloom.functions.numeric import half_even
from riskloom.functions.scoring import odds_scale
from riskloom.operators import cleaning, features, models, staging, woe as woe_ops
from riskloom.session import configure
from riskloom.sources.storage import materialize

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def add(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query named twice: {name}")
        QUERIES[name] = lambda spark, sf_dir: function(configure(spark), sf_dir)
        if oracle is not None:
            ORACLES[name] = oracle
        return function
    return add


# ------------------------------------------------------------ shared inputs
def raw(spark: SparkSession, sf: str) -> DataFrame:
    return L.loans_raw(spark, sf)


def staged(spark: SparkSession, sf: str) -> DataFrame:
    return staging.stage_loans(raw(spark, sf))


def clean(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.clean_loans(staged(spark, sf))


def derived(spark: SparkSession, sf: str) -> DataFrame:
    return features.derive_features(clean(spark, sf), L.TRAIN_LAST, L.VALIDATION)


def fitted_woe(spark: SparkSession, sf: str) -> DataFrame:
    return woe_ops.fit_woe(derived(spark, sf))


def with_woe(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """The features and the WoE table fitted on them."""
    made = derived(spark, sf)
    return made, woe_ops.fit_woe(made)


def encoded(spark: SparkSession, sf: str) -> DataFrame:
    return woe_ops.apply_woe(*with_woe(spark, sf))


def scored(spark: SparkSession, sf: str) -> DataFrame:
    """Both PDs of every loan, one narrow stage after the WoE fit."""
    both = models.score_challenger(
        models.score_champion(encoded(spark, sf), L.CHAMPION_COEFFICIENTS, L.CHAMPION_INTERCEPT),
        L.CHALLENGER_COEFFICIENTS, L.CHALLENGER_INTERCEPT)
    return both.select("id", "is_bad", "split", "loan_amnt", "champ_pd", "chall_pd")


def oot(spark: SparkSession, sf: str) -> DataFrame:
    return scored(spark, sf).where(F.col("split") == "oot")


def stored_oot(spark: SparkSession, sf: str) -> DataFrame:
    """For measures that pass over the scored loans several times."""
    return materialize(oot(spark, sf))


def challenger_oot(spark: SparkSession, sf: str) -> DataFrame:
    """The challenger's PDs need no WoE, so nothing is fitted."""
    part = derived(spark, sf).where(F.col("split") == "oot")
    return models.score_challenger(part, L.CHALLENGER_COEFFICIENTS, L.CHALLENGER_INTERCEPT).select(
        "id", "is_bad", "loan_amnt", F.col("chall_pd").alias("prob"))


def applications(made: DataFrame) -> DataFrame:
    """All loans as applications."""
    return made.select(*L.APPLICATION_COLUMNS)


def spread(spark: SparkSession, sf: str) -> DataFrame:
    """PDs that fill all score bands, and a population shifted by 15 points."""
    factor, offset = odds_scale()
    u = ((F.col("id") * 7919) % 9973 + 1) / F.lit(9974.0)

    def pd(shift: float):
        target = F.lit(400.0) + F.lit(420.0) * u - F.lit(shift)
        return 1 / (1 + F.exp((target - F.lit(offset)) / F.lit(factor)))

    return staged(spark, sf).select("id", "is_bad", pd(0.0).alias("pd"), pd(15.0).alias("pd_later"))


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: half_even(F.col(c), digits) for c in columns})


def typed(df: DataFrame, **types: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast(t) for c, t in types.items()})


def points_table(spark: SparkSession) -> DataFrame:
    """Points of the champion; two features are left without on purpose."""
    kept = {f: w for f, w in L.CHAMPION_COEFFICIENTS.items()
            if f not in ("purpose_woe", "application_type_woe")}
    return models.scorecard_points(spark.range(1), kept)

