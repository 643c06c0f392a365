"""Loans without a probability, and NaN in applications."""

import math

import pytest
from pyspark.sql import functions as F

from riskloom.functions import scoring as S
from riskloom.operators import applications as A, bootstrap as B, champion as C
from riskloom.operators import distributions as D, monitoring as M, ranking as R

SCORED = [(1, 1, 0.9), (2, 0, 0.7), (3, 1, 0.4), (4, 0, 0.1)]
MISSING = [(5, 1, None), (6, 0, None)]


@pytest.fixture(scope="module")
def known(spark):
    return spark.createDataFrame(SCORED, "id long, is_bad int, prob double")


@pytest.fixture(scope="module")
def mixed(spark):
    return spark.createDataFrame(SCORED + MISSING, "id long, is_bad int, prob double")


def test_no_probability_gives_no_score(mixed):
    pd = F.col("prob")
    score = S.score_minmax(pd)
    got = mixed.where(pd.isNull()).select(
        score, S.score_minmax(pd, rounded=False), S.score_odds(pd), S.score_odds(pd, rounded=False),
        S.risk_tier(score), S.decision(score), S.decision_reason(score)).distinct().collect()
    assert [tuple(row) for row in got] == [(None,) * 7]


@pytest.mark.parametrize("digits", [None, 6])
def test_ranking_leaves_missing_out(known, mixed, digits):
    def all_of(df):
        table = R.threshold_table(df, digits=digits)
        return [sorted(map(tuple, frame.collect()), key=str) for frame in (
            R.roc_curve(table), R.ks_curve(table), R.auc_gini(table), R.ks_statistic(table),
            R.gains_lift(df, percentiles=4, digits=digits), R.capture_at(df, digits=digits))]

    got = all_of(mixed)
    assert got == all_of(known)
    assert max(row[1] for row in got[0]) == 1.0


def test_bins_leave_missing_out(known, mixed):
    for measure in (M.calibration_curve, lambda df: D.score_histogram(df, "prob"),
                    lambda df: M.score_band_stats(df, "prob")):
        assert sorted(map(tuple, measure(mixed).collect())) == sorted(map(tuple, measure(known).collect()))


def test_nan_is_no_valid_value(spark):
    good = {"annual_inc": 1.0, "open_acc": 0.0}
    rules = A.application_rules()
    rows = [good, good | {"annual_inc": math.nan}, good | {"open_acc": math.nan}]
    got = spark.createDataFrame(rows).select(*[rules[name][0].alias(name) for name in good])
    assert [tuple(row) for row in got.collect()] == [(True, True), (False, True), (True, False)]


def test_paired_test_refuses_tick_draws(mixed):
    scored = mixed.where("prob IS NOT NULL").withColumn("other", F.col("prob"))
    models = {"champion": "prob", "challenger": "other"}
    drawn = B.bootstrap_replicates(scored, models, n=20)
    with pytest.raises(ValueError, match="paired"):
        C.ztest_auc(B.summarize_replicates(drawn), replicates=drawn)
    same = B.hashed_replicates(scored, models, 20).groupBy("replicate").agg(
        (F.max("auc") - F.min("auc")).alias("gap"))
    assert same.agg(F.max("gap")).first()[0] == 0.0


def test_tick_bootstrap_follows_exact_auc(spark):
    """Mean near the exact AUC, deviation near that of per-loan draws."""
    rows = [(i, int(i * 7919 % 10 < 3), round((i * 104729 % 1000) / 2000 + 0.1 * (i * 7919 % 10 < 3), 6))
            for i in range(3000)]
    scored = spark.createDataFrame(rows, "id long, is_bad int, prob double")
    exact = R.auc_gini(R.threshold_table(scored, digits=6)).first().auc
    ticks = B.bootstrap_auc(scored, {"champion": "prob"}).first()
    loans = B.summarize_replicates(B.hashed_replicates(scored, {"champion": "prob"}, 400)).first()
    assert ticks.n_replicates == 1000
    assert abs(ticks["mean"] - exact) < 4 * ticks["std"] / math.sqrt(1000)
    assert ticks["std"] == pytest.approx(loans["std"], rel=0.2)
    assert ticks["lower"] < exact < ticks["upper"]
