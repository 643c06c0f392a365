"""Column functions: bands, cuts, scores, parsing, rounding."""

import math

import pytest
from pyspark.sql import functions as F

from riskloom import fixed_values as V
from riskloom.functions import bands as B, cleaning as C, numeric as N, parsing as P, scoring as S


def values(spark, function, inputs, kind="double"):
    rows = [(i, x) for i, x in enumerate(inputs)]
    df = spark.createDataFrame(rows, f"i int, x {kind}")
    return [r.y for r in df.select("i", function(F.col("x")).alias("y")).orderBy("i").collect()]


BAND_CASES = [
    (B.band_fico, {580: "1_below_620", 619: "1_below_620", 620: "2_620_659", 659: "2_620_659",
                   699: "3_660_699", 700: "4_700_739", 739: "4_700_739", 740: "5_740_779",
                   780: "6_780_plus", 850: "6_780_plus", None: "6_780_plus"}),
    (B.band_dti, {0: "1_low", 9: "1_low", 10: "2_medium", 20: "3_high", 29: "3_high",
                  30: "4_very_high", 60: "4_very_high", None: "4_very_high"}),
    (B.band_emp, {0: "1_junior", 1: "1_junior", 2: "2_mid", 5: "3_senior", 7: "3_senior",
                  8: "4_veteran", 10: "4_veteran", None: "4_veteran"}),
    (B.band_int_rate, {5.0: "1_prime", 7.9: "1_prime", 8.0: "2_near_prime", 12.0: "3_subprime",
                       16.0: "4_deep_subprime", 22.0: "5_distressed", 31.0: "5_distressed",
                       None: "5_distressed"}),
    (B.band_loan_amnt, {1000: "1_micro", 4999: "1_micro", 5000: "2_small", 30000: "5_xlarge",
                        40000: "5_xlarge", None: "5_xlarge"}),
]


@pytest.mark.parametrize("function,cases", BAND_CASES, ids=lambda x: getattr(x, "__name__", ""))
def test_bands(spark, function, cases):
    inputs = [None if x is None else float(x) for x in cases]
    assert values(spark, function, inputs) == list(cases.values())


def test_cut_right_is_closed_on_the_right(spark):
    cut = lambda x: B.cut_right(x, *V.FICO_CUT)
    got = values(spark, cut, [580.0, 580.5, 620.0, 620.5, 850.0, 850.5, None])
    assert got == [None, "580-620", "580-620", "620-660", "780-850", None, None]
    ordinals = values(spark, lambda x: B.cut_ordinal(x, V.FICO_CUT[0]), [580.0, 620.0, 850.0, 851.0])
    assert ordinals == [None, 1, 6, None]


def test_score_minmax(spark):
    pds = [0.09, 0.90, 0.01, 0.99, 0.495, 0.20, 0.50, 0.80]
    got = values(spark, S.score_minmax, pds)
    assert got[:4] == [850, 300, 850, 300]
    assert 560 <= got[4] <= 620
    assert all(300 <= s <= 850 for s in got)


def test_score_odds(spark):
    factor = 20 / math.log(2)
    offset = 600 - factor * math.log(50)
    pds = [0.05, 0.10, 0.5, 0.001, 0.0, 1.0, 1e-12]
    want = [round(min(max(offset + factor * math.log(max((1 - p) / p, 1e-10)), 300), 850)) for p in pds
            if p not in (0.0, 1.0)]
    got = values(spark, S.score_odds, pds)
    assert [s for p, s in zip(pds, got) if p not in (0.0, 1.0)] == want
    assert got[4] == 850 and got[5] == 300


def test_risk_tiers(spark):
    scores = [850, 720, 719, 640, 639, 560, 559, 490, 489, 300]
    tiers = values(spark, S.risk_tier, scores, "int")
    assert tiers == ["Prime"] * 2 + ["Near-Prime"] * 2 + ["Sub-Prime"] * 2 + ["Deep Sub-Prime"] * 2 + ["High Risk"] * 2
    assert values(spark, S.decision, [720, 560, 559, 489], "int") == ["APPROVED", "APPROVED", "REVIEW", "DECLINED"]


def test_rounding_rules(spark):
    assert values(spark, lambda x: N.dround(x, 2), [1.005, 2.675, -1.235, 0.125]) == [1.0, 2.68, -1.24, 0.13]
    assert values(spark, N.half_even, [0.5, 1.5, 2.5, -0.5]) == [0.0, 2.0, 2.0, -0.0]


def test_normal_tail(spark):
    zs = [-8.0, -3.0, -1.0, -0.1, 0.0, 0.3, 1.644854, 4.8759, 6.0, 7.5]
    for z, got in zip(zs, values(spark, N.norm_sf, zs)):
        assert got == pytest.approx(0.5 * math.erfc(z / math.sqrt(2)), rel=1e-9, abs=1e-15)


def test_parsing(spark):
    assert values(spark, P.parse_term, [" 36 months", " 60 months", None], "string") == [36, 60, None]
    assert values(spark, P.parse_percent, ["13.5%", "7", None], "string") == [13.5, 7.0, None]
    words = [*V.EMP_LENGTH_YEARS, "n/a", None]
    assert values(spark, P.emp_length_years, words, "string") == [*range(11), None, None]
    lenient = lambda x: P.parse_issue_month(x, lenient=True)
    months = values(spark, lenient, ["Dec-2015", "2015", None], "string")
    assert (months[0].year, months[0].month, months[1], months[2]) == (2015, 12, None, None)
    with pytest.raises(Exception):
        values(spark, P.parse_issue_month, ["2015"], "string")


def test_vintage_label_keeps_known_part(spark):
    df = spark.createDataFrame([(2015, 4), (2015, None)], "y long, q long")
    assert [r[0] for r in df.select(P.vintage_label(F.col("y"), F.col("q"))).collect()] == ["2015-Q4", "2015-Q"]


def test_cleaning_rules(spark):
    outside = lambda x: C.null_out_of_range(x, 0, 60)
    assert values(spark, outside, [-1.0, 0.0, 60.0, 60.1, 12.346, None]) == [None, 0.0, 60.0, None, 12.35, None]
    df = spark.createDataFrame([(None, None, 1), (None, 0, 0), (0, 0, None)], "a int, b int, c int")
    flag = C.derogatory_flag(F.col("a"), F.col("b"), F.col("c"))
    assert [r[0] for r in df.select(flag).collect()] == [1, 0, 0]


def test_readings(spark):
    assert values(spark, B.psi_status, [0.0999, 0.1, 0.2499, 0.25]) == ["Stable", "Monitor", "Monitor", "Retrain"]
    assert values(spark, B.iv_strength, [0.0199, 0.02, 0.1, 0.3, 0.301]) == ["useless", "weak", "weak", "medium", "strong"]
    flag = lambda x: B.split_flag(x)
    assert values(spark, flag, [2007, 2015, 2016, 2017], "long") == ["train", "train", "validation", "oot"]
