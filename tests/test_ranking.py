"""Ordered measures against brute force, with hot and tied probabilities."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.operators import ranking as R


def population(n=3000, seed=1, hot=0.37, digits=None):
    """A third of all loans share one probability; the others are dense near 0.2."""
    rng = np.random.default_rng(seed)
    prob = np.clip(rng.normal(0.2, 0.002, n), 0, 1)
    prob[: n // 3] = hot
    prob[n // 3: n // 3 + 20] = 0.0
    prob[n // 3 + 20: n // 3 + 40] = 1.0
    if digits is not None:
        prob = np.round(prob, digits)
    bad = (rng.random(n) < 0.1 + prob).astype(int)
    return [(int(i), float(p), int(b)) for i, p, b in zip(range(n), prob, bad)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "id long, prob double, is_bad int")


def brute_auc(rows):
    pos = np.array([p for _, p, b in rows if b == 1])
    neg = np.array([p for _, p, b in rows if b == 0])
    gap = pos[:, None] - neg[None, :]
    return ((gap > 0).sum() + (gap == 0).sum() / 2) / gap.size


def brute_curve(rows):
    n_pos = sum(b for _, _, b in rows)
    n_neg = len(rows) - n_pos
    points = []
    for cut in sorted({p for _, p, _ in rows}, reverse=True):
        above = [b for _, p, b in rows if p >= cut]
        points.append((cut, sum(above) / n_pos, (len(above) - sum(above)) / n_neg))
    return points


@pytest.mark.parametrize("digits", [None, 6, 3])
def test_roc_auc_ks(spark, digits):
    rows = population(digits=digits)
    table = R.threshold_table(frame(spark, rows), digits=digits).cache()
    want = brute_curve(rows)
    got = sorted(((r.threshold, r.tpr, r.fpr) for r in R.roc_curve(table).collect() if r.threshold is not None), reverse=True)
    assert len(got) == len(want)
    assert np.allclose(got, want)
    assert got[-1][1:] == (1.0, 1.0)
    assert R.roc_curve(table).where("threshold IS NULL AND tpr = 0 AND fpr = 0").count() == 1
    auc = R.auc_gini(table).first()
    assert auc.auc == pytest.approx(brute_auc(rows)) and auc.gini == pytest.approx(2 * auc.auc - 1)
    ks = max(t - f for _, t, f in want)
    assert R.ks_statistic(table).first().ks == pytest.approx(ks) and 0 <= ks <= 1
    best = R.argmax_row(R.ks_curve(table)).first()
    assert best.ks == pytest.approx(ks)
    assert best.prob == max(c for c, t, f in want if t - f > ks - 1e-12)


def test_one_and_two_levels_agree(spark):
    df = frame(spark, population(digits=6))
    one, two = R.threshold_table(df, digits=6), R.threshold_table(df)
    assert one.exceptAll(two).count() == 0 and two.exceptAll(one).count() == 0


def test_groups_are_separate(spark):
    first, second = population(seed=2), population(1000, seed=3)
    df = frame(spark, first).withColumn("m", F.lit("a")).unionByName(
        frame(spark, second).withColumn("m", F.lit("b")))
    got = {r.m: r.auc for r in R.auc_gini(R.threshold_table(df, ["m"]), ["m"]).collect()}
    assert got == {"a": pytest.approx(brute_auc(first)), "b": pytest.approx(brute_auc(second))}
    assert R.roc_curve(R.threshold_table(df, ["m"]), ["m"]).where("threshold IS NULL").count() == 2


def test_auc_of_reversed_scores(spark):
    df = frame(spark, population())
    auc = R.auc_gini(R.threshold_table(df)).first().auc
    turned = R.auc_gini(R.threshold_table(df.withColumn("prob", 1 - F.col("prob")))).first().auc
    assert auc + turned == pytest.approx(1)


def test_one_class_has_no_auc(spark):
    df = frame(spark, [(1, 0.2, 1), (2, 0.3, 1)])
    assert R.auc_gini(R.threshold_table(df)).first().auc is None


def ranked(rows):
    key = lambda r: (-r[1], hashlib.md5(str(r[0]).encode()).hexdigest(), r[0])
    return np.cumsum([b for *_, b in sorted(rows, key=key)])


@pytest.mark.parametrize("n", [3000, 37])
def test_gains_and_capture(spark, n):
    rows = population(n) if n > 100 else [(i, 0.5, i % 2) for i in range(n)]
    bads = ranked(rows)
    df = frame(spark, rows)
    gains = {r.percentile: r for r in R.gains_lift(df).collect()}
    assert sorted(gains) == list(range(1, 101))
    for k, row in gains.items():
        top = -(-n * k // 100)
        assert row.n_top == top
        assert row.gains == pytest.approx(bads[top - 1] * 100 / bads[-1])
        assert row.lift == pytest.approx(row.gains / (top * 100 / n))
    assert gains[100].gains == pytest.approx(100)
    for row in R.capture_at(df).collect():
        assert row.captured_pct == pytest.approx(bads[int(n * row.share)] * 100 / bads[-1])


def test_compare_ks(spark):
    rows = population()
    df = frame(spark, rows).select("is_bad", F.lit(0.5).alias("champ_pd"), F.col("prob").alias("chall_pd"))
    row = R.compare_ks(df).first()
    assert row.champion_ks == 0 and row.challenger_ks == row.ks_diff > 0 and row.challenger_wins


def test_loans_are_scanned_once_and_only_cell_totals_meet(spark, tmp_path):
    path = str(tmp_path / "loans")
    frame(spark, population()).write.parquet(path)
    table = R.threshold_table(spark.read.parquet(path))
    plan = R.ks_statistic(table)._jdf.queryExecution().executedPlan().toString()
    assert path not in plan    # later steps read the ticks
    # One task sees the thousand coarse cells, one the result; never the ticks.
    assert plan.count("Exchange SinglePartition") <= 2


@pytest.mark.parametrize("digits", [None, 3])
def test_gains_by_loan(spark, digits):
    """A point per loan, as a sort of all loans gives it; loans without a probability have none."""
    rows = population(900, digits=digits)
    got = {r.id: r for r in R.gains_by_loan(frame(spark, rows + [(-1, None, 1)]), digits=digits).collect()}
    order = sorted(rows, key=lambda r: (-r[1], hashlib.md5(str(r[0]).encode()).hexdigest(), r[0]))
    n_pos, bads = sum(b for _, _, b in rows), 0
    assert len(got) == len(rows)
    for place, (i, _, bad) in enumerate(order, start=1):
        bads += bad
        assert got[i].place == place
        assert got[i].gains == pytest.approx(bads * 100 / n_pos)
        assert got[i].lift == pytest.approx((bads / n_pos) / (place / len(rows)))
    by_percentile = R.gains_lift(frame(spark, rows), digits=digits).collect()
    assert all(r.gains == pytest.approx(next(g.gains for g in got.values() if g.place == r.n_top)) for r in by_percentile)
