"""Score bands, stability and calibration."""

import numpy as np
import pytest

from checks import registry as Q
from riskloom import fixed_values as V
from riskloom.operators import monitoring as M


def scores(spark, values):
    return spark.createDataFrame([(float(v),) for v in values], "score double")


def test_equal_populations_are_stable(spark):
    df = scores(spark, range(300, 851, 7))
    row = M.psi_total(M.psi(df, df)).first()
    assert row.psi == 0 and row.status == "Stable"


def test_psi_by_hand_with_empty_bands(spark):
    expected, actual = [400] * 30 + [560] * 50 + [600] * 20, [400] * 10 + [560] * 50 + [800] * 40
    edges = V.PSI_CUT[0]
    e, a = (np.histogram(np.array(x) - 1e-9, edges)[0] / len(x) for x in (expected, actual))
    want = (a - e) * np.log((a + 1e-10) / (e + 1e-10))
    rows = M.psi(scores(spark, expected), scores(spark, actual)).orderBy("band_ord").collect()
    assert [r.band for r in rows] == V.PSI_CUT[1]
    assert [r.psi_component for r in rows] == pytest.approx(list(want))
    assert M.psi_total(M.psi(scores(spark, expected), scores(spark, actual))).first().status == "Retrain"


def test_psi_edges_are_right_closed(spark):
    rows = M.align_bands(scores(spark, [550, 551, 299, 851, 900]), scores(spark, [])).collect()
    counts = {r.band: (r.exp_count, r.act_count) for r in rows}
    assert counts["<550"] == (1, 0) and counts["550-580"] == (1, 0) and counts["760+"] == (1, 0)
    assert rows[0].exp_total == 3 and rows[0].act_total == 0


def test_score_bands_hold_everyone(spark, sf):
    stats = M.score_band_stats(Q.spread(spark, sf), "pd").collect()
    assert [r.score_band for r in stats] == V.SCORE_BAND_CUT[1]
    assert sum(r.total for r in stats) == Q.staged(spark, sf).count()


def test_calibration(spark):
    rows = [(0.0, 0), (0.1, 1), (0.1000001, 0), (0.3, 1), (0.7, 1), (1.0, 1), (0.95, 0)]
    df = spark.createDataFrame(rows, "prob double, is_bad int")
    edges = np.linspace(0, 1, 11)
    bins = np.searchsorted(edges[1:-1], [p for p, _ in rows]) + 1
    got = {r.bin: r for r in M.calibration_curve(df).collect()}
    assert sorted(got) == sorted(set(bins))
    for b in got:
        part = [(p, y) for (p, y), k in zip(rows, bins) if k == b]
        assert got[b].total == len(part)
        assert got[b].mean_predicted == pytest.approx(np.mean([p for p, _ in part]))
        assert got[b].bad_share == pytest.approx(np.mean([y for _, y in part]))
