"""Bootstrap, tests, loss and the decision."""

import hashlib
import math

import numpy as np
import pytest

from riskloom.functions.hashing import md5_words
from riskloom.operators import bootstrap as B, champion as C

MODELS = {"champion": "champ_pd", "challenger": "chall_pd"}


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(11)
    bad = (rng.random(600) < 0.25).astype(int)
    champ = np.round(np.clip(0.2 + 0.05 * bad + rng.normal(0, 0.1, 600), 0, 1), 6)
    chall = np.round(np.clip(0.2 + 0.15 * bad + rng.normal(0, 0.1, 600), 0, 1), 6)
    champ[:200] = 0.25   # a third of all loans share one value
    return [(i, int(b), float(x), float(y), 1000.0 + i) for i, (b, x, y) in enumerate(zip(bad, champ, chall))]


@pytest.fixture(scope="module")
def scored(spark, rows):
    return spark.createDataFrame(rows, "id long, is_bad int, champ_pd double, chall_pd double, loan_amnt double")


def weighted_auc(prob, bad, weight):
    order = np.argsort(prob)
    prob, bad, weight = prob[order], bad[order], weight[order]
    won = below = 0.0
    for p in np.unique(prob):
        here = prob == p
        pos, neg = (weight * bad)[here].sum(), (weight * (1 - bad))[here].sum()
        won += pos * (below + neg / 2)
        below += neg
    return won / ((weight * bad).sum() * below)


def draw(i, replicate):
    digest = hashlib.md5(f"{i}-{replicate // 4}".encode()).hexdigest()
    part = (replicate % 4) * 8
    u = int(digest[part:part + 8], 16) / 2 ** 32
    k, total, term = 0, math.exp(-1), math.exp(-1)
    while u >= total and k < B.LARGEST_DRAW:
        k += 1
        term /= k
        total += term
    return k


def test_hashed_replicates_by_hand(scored, rows):
    got = {(r.model, r.replicate): r.auc for r in B.hashed_replicates(scored, MODELS, 6).collect()}
    assert len(got) == 12
    bad = np.array([r[1] for r in rows])
    for replicate in range(6):
        weight = np.array([draw(r[0], replicate) for r in rows], dtype=float)
        for model, column in (("champion", 2), ("challenger", 3)):
            want = weighted_auc(np.array([r[column] for r in rows]), bad, weight)
            assert got[model, replicate] == pytest.approx(want, abs=1e-11)


def test_hashed_replicates_make_no_row_per_loan_and_replicate(scored):
    plan = B.hashed_replicates(scored, MODELS, 1000)._jdf.queryExecution().optimizedPlan().toString().lower()
    assert "explode" not in plan and "mapinarrow" in plan


@pytest.mark.parametrize("parts", ["1", "13"])
def test_hashed_replicates_with_ties_cut_apart(spark, parts):
    """A hot probability, ids of all lengths that repeat or are missing, loans without probability or outcome."""
    rng = np.random.default_rng(5)
    ids = [None, "", "é", "x" * 60, *map(str, rng.integers(0, 10 ** 7, 196))] * 2
    prob = [None if u < 0.05 else 0.25 if u < 0.5 else float(round(u, 2)) for u in rng.random(400)]
    bad = [None if u < 0.05 else int(u < 0.4) for u in rng.random(400)]
    rows = list(zip(ids, bad, prob))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        scored = spark.createDataFrame(rows, "id string, is_bad int, prob double")
        got = {r.replicate: r.auc for r in B.hashed_replicates(scored, {"champion": "prob"}, 7).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(got) == 7
    for replicate, auc in got.items():
        known = [(B.LARGEST_DRAW if i is None else draw(i, replicate), y, p) for i, y, p in rows if y is not None]
        won = sum(w * v * (0.5 if p == q else 1.0 if q is None else float(p > q))
                  for w, y, p in known if y == 1 and p is not None for v, z, q in known if z == 0)
        total = sum(w for w, y, _ in known if y == 1) * sum(w for w, y, _ in known if y == 0)
        assert auc == pytest.approx(won / total, abs=1e-11)


def test_digests_of_many_texts():
    keys, suffixes = [b"", b"7", b"12", "é".encode(), b"x" * 50, b"x" * 54, b"y" * 60], [b"-0", b"-12", b"-345", b""]
    for key, words in zip(keys, md5_words(keys, suffixes)):
        assert words.astype(">u4").tobytes() == b"".join(hashlib.md5(key + s).digest() for s in suffixes)


def test_tick_bootstrap_has_the_right_spread(scored, rows):
    summary = {r.model: r for r in B.bootstrap_auc(scored, MODELS, n=800).collect()}
    rng, bad = np.random.default_rng(0), np.array([r[1] for r in rows])
    for model, column in (("champion", 2), ("challenger", 3)):
        prob = np.array([r[column] for r in rows])
        aucs = []
        for _ in range(400):
            pick = rng.integers(0, len(rows), len(rows))
            aucs.append(weighted_auc(prob[pick], bad[pick], np.ones(len(rows))))
        row = summary[model]
        assert row.n_replicates == 800
        assert row["mean"] == pytest.approx(np.mean(aucs), abs=0.004)
        assert row.std == pytest.approx(np.std(aucs), rel=0.2)
        assert row.lower < row["mean"] < row.upper


def test_tick_bootstrap_is_repeatable(scored):
    a = B.bootstrap_replicates(scored, MODELS, n=50)
    b = B.bootstrap_replicates(scored.repartition(7), MODELS, n=50)
    assert {tuple(r) for r in a.collect()} == {tuple(r) for r in b.collect()}


def test_one_class_replicates_are_skipped(spark):
    df = spark.createDataFrame([(1, 1, 0.3, 0.4), (2, 0, 0.2, 0.1)], "id long, is_bad int, champ_pd double, chall_pd double")
    replicates = B.hashed_replicates(df, MODELS, 40)
    kept = replicates.where("model = 'champion'").count()
    assert kept == sum(draw(1, r) > 0 and draw(2, r) > 0 for r in range(40)) < 40


def test_ztest_and_posterior(spark):
    rng = np.random.default_rng(1)
    a, b = rng.normal(0.688, 0.0012, 300), rng.normal(0.690, 0.0012, 300)
    rows = [(m, i, float(x)) for m, xs in (("champion", a), ("challenger", b)) for i, x in enumerate(xs)]
    replicates = spark.createDataFrame(rows, "model string, replicate int, auc double").cache()
    summary = B.summarize_replicates(replicates)
    test = C.ztest_auc(summary).first()
    z = (b.mean() - a.mean()) / math.sqrt(a.std() ** 2 + b.std() ** 2)
    assert test.z_score == pytest.approx(z, abs=6e-5)
    assert test.p_value == pytest.approx(0.5 * math.erfc(z / math.sqrt(2)), abs=6e-7)
    assert test.significant == (test.p_value < 0.05)
    paired = C.ztest_auc(summary, replicates=replicates).first()
    assert paired.z_score == pytest.approx((b.mean() - a.mean()) / (b - a).std(), abs=6e-5)
    posterior = C.bayesian_ab(replicates).first()
    gaps = (b[:, None] - a[None, :]).ravel()
    assert tuple(posterior) == pytest.approx((round((gaps > 0).mean(), 4), *(round(x, 6) for x in (
        gaps.mean(), np.percentile(gaps, 2.5), np.percentile(gaps, 97.5)))), abs=1e-9)
    assert tuple(C.bayesian_ab(replicates.where("model = 'champion'")).first()) == (None,) * 4


def test_differences_by_rank():
    """Every rank of all differences, with ties, negatives, zeros and lists of unequal length."""
    rng = np.random.default_rng(3)
    for a, b in [(rng.normal(size=9), rng.normal(size=14)), (rng.integers(0, 3, 12) / 4, rng.integers(0, 3, 5) / 4),
                 (np.array([0.5]), np.array([0.5])), (np.zeros(4), np.array([-1e-300, 0.0, 1e300]))]:
        a, b = np.sort(a.astype(float)), np.sort(b.astype(float))
        gaps = np.sort((b[:, None] - a[None, :]).ravel())
        assert [C.difference_at(a, b, k) for k in range(len(gaps))] == gaps.tolist()
        for share in (0, 0.025, 0.3, 1):
            assert C.difference_quantile(a, b, share) == pytest.approx(np.quantile(gaps, share), rel=1e-12, abs=1e-300)


def test_business_impact(scored, rows):
    row = C.business_impact(scored).first()
    approved = [r for r in rows if r[2] < 0.25]   # exactly 0.25 is not approved
    assert row.champ_approval_rate == pytest.approx(round(len(approved) / len(rows), 4))
    assert row.champ_expected_loss == pytest.approx(round(sum(r[2] * 0.6 * r[4] for r in approved)), abs=1)
    assert row.champ_false_negatives == sum(r[1] for r in approved)
    assert row.fn_reduction == row.champ_false_negatives - row.chall_false_negatives
    nobody = C.business_impact(scored, threshold=0.0).first()
    assert nobody.champ_expected_loss == 0 and nobody.el_reduction_pct is None


@pytest.mark.parametrize("significant,chance,wins,word", [
    (True, 0.81, True, "DEPLOY CHALLENGER"), (False, 0.99, True, "RETAIN CHAMPION"),
    (True, 0.80, True, "RETAIN CHAMPION"), (True, 0.99, False, "RETAIN CHAMPION")])
def test_decision(spark, significant, chance, wins, word):
    ztest = spark.createDataFrame([(significant,)], "significant boolean")
    bayes = spark.createDataFrame([(chance,)], "prob_challenger_wins double")
    ks = spark.createDataFrame([(wins,)], "challenger_wins boolean")
    assert C.decide(ztest, bayes, ks).first().decision == word
