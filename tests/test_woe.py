"""WoE, IV and encoding."""

import math

import pytest
from pyspark.sql import functions as F

from riskloom.operators import woe as W


def frame(spark, rows):
    return spark.createDataFrame(rows, "is_bad int, split string, grade string, purpose string")


def rows():
    out = []
    for grade, bad, good in (("A", 10, 90), ("B", 30, 70), ("C", 5, 0), (None, 0, 8)):
        out += [(1, "train", grade, "car")] * bad + [(0, "train", grade, "car")] * good
    return out + [(1, "oot", "A", "car")] * 50


def test_woe_by_hand(spark):
    table = {(r.feature, r.bin): r for r in W.woe_table(frame(spark, rows()), ["grade", "purpose"]).collect()}
    a = table["grade", "A"]
    assert (a.total, a.events, a.non_events, a.bad_rate_pct) == (100, 10, 90, 10.0)
    assert a.woe == round(math.log((10 / 45) / (90 / 168)), 4)
    assert a.iv_component == round((10 / 45 - 90 / 168) * a.woe, 6)
    # Bins of one class weigh nothing, NULL is a bin, a single bin is neutral.
    assert table["grade", "C"].woe == 0 and table["grade", None].woe == 0
    assert table["purpose", "car"].woe == 0
    iv = {r.feature: r.iv for r in W.iv_summary(W.woe_table(frame(spark, rows()), ["grade", "purpose"])).collect()}
    assert iv["purpose"] == 0 and iv["grade"] > 0


def test_encoding_ways_agree(spark):
    df = frame(spark, rows() + [(0, "oot", "Z", "boat")])
    table = W.fit_woe(df, ["grade", "purpose"])
    by_map = W.apply_woe(df, table, ["grade", "purpose"])
    by_join = W.join_woe(df, table, ["grade", "purpose"])
    assert by_map.exceptAll(by_join).count() == 0 and by_join.exceptAll(by_map).count() == 0
    unknown = by_map.where("grade = 'Z' OR grade IS NULL")
    assert unknown.where("grade_woe IS NOT NULL").count() == 0
    filled = W.lookup_woe(df, table, features=["grade", "purpose"])
    assert filled.where("grade_woe IS NULL OR purpose_woe IS NULL").count() == 0


def test_many_bins(spark, monkeypatch):
    """Thousands of bins are found by hash, and by joins where the table is too large to send."""
    many = spark.range(3000).select(
        F.lit("grade").alias("feature"), F.col("id").cast("string").alias("bin"),
        (F.col("id") / 1000.0).alias("woe")).unionByName(spark.createDataFrame(
            [("grade", None, 9.0), ("purpose", "7", 5.0)], "feature string, bin string, woe double"))
    df = spark.createDataFrame([("7",), ("2999",), ("x",), (None,)], "grade string").withColumn("purpose", F.lit("7"))
    want = {"7": (0.007, 5.0), "2999": (2.999, 5.0), "x": (None, 5.0), None: (None, 5.0)}
    for fits in (True, False):
        monkeypatch.setattr(W, "fits_broadcast", lambda _, fits=fits: fits)
        encoded = W.apply_woe(df, many, ["grade", "purpose"])
        assert {r.grade: (r.grade_woe, r.purpose_woe) for r in encoded.collect()} == want
        assert ("Join LeftOuter, (grade" in encoded._jdf.queryExecution().optimizedPlan().toString()) == (not fits)


def test_repeated_bins_raise(spark):
    """However large the table is and whichever way it would be used."""
    for extra in (0, 3000):
        table = spark.createDataFrame([("grade", "A", 1.0), ("grade", "A", 2.0)]
                                      + [("grade", str(i), 0.5) for i in range(extra)],
                                      "feature string, bin string, woe double")
        df = spark.createDataFrame([("A",)], "grade string")
        for encode in (W.apply_woe, W.join_woe, W.lookup_woe):
            with pytest.raises(ValueError, match="several WoE"):
                encode(df, table, features=["grade"])


def test_facts_are_not_shuffled(spark):
    df = frame(spark, rows())
    table = W.fit_woe(df, ["grade", "purpose"])
    for encode in (W.apply_woe, W.lookup_woe):
        plan = encode(df, table, features=["grade", "purpose"])._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and "Exchange hashpartitioning" not in plan.split("Subquery")[0]
