"""Exact quantiles, the profile, and capped histograms."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskloom.operators import distributions as D, profile as P
from riskloom.operators.quantiles import exact_quantiles, value_counts

SHAPES = {
    "heavy": lambda rng: np.round(np.exp(rng.normal(10, 3, 4000)), 2),
    "signed": lambda rng: rng.normal(0, 5, 4001),
    "hot": lambda rng: np.concatenate([np.full(1500, 51.77), rng.random(1000), np.zeros(800)]),
    "narrow": lambda rng: 1000 + rng.random(2000) * 1e-7,
    "powers": lambda rng: np.array([10.0 ** k for k in range(-8, 12)] + [-(10.0 ** k) for k in range(-8, 12)]),
    "single": lambda rng: np.array([3.25]),
    "two": lambda rng: np.array([-1.0, 1.0]),
}
PROBABILITIES = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]


def test_exact_quantiles(spark):
    data = {name: make(np.random.default_rng(5)) for name, make in SHAPES.items()}
    long = pd.DataFrame([(n, float(v)) for n, vs in data.items() for v in vs], columns=["column", "value"])
    counts = value_counts(spark.createDataFrame(long), ["column"])
    got = {(r.column, r.probability): r.quantile
           for r in exact_quantiles(counts, ["column"], PROBABILITIES).collect()}
    assert len(got) == len(data) * len(PROBABILITIES)
    for (name, p), value in got.items():
        assert value == pytest.approx(np.quantile(data[name], p), rel=1e-12, abs=1e-12), (name, p)


def test_profile_against_pandas(spark):
    rng = np.random.default_rng(9)
    pdf = pd.DataFrame({"a": np.round(rng.gamma(2, 1000, 500), 1), "b": rng.integers(0, 5, 500).astype(float)})
    pdf.loc[::7, "a"] = np.nan
    df = spark.createDataFrame(pdf).replace(float("nan"), None)
    rows = {r.column: r for r in P.profile_columns(df, ["a", "b"]).collect()}
    for name in ("a", "b"):
        s, r = pdf[name], rows[name]
        assert (r.total_rows, r.null_count, r.distinct_count) == (500, s.isna().sum(), s.nunique())
        assert r.null_pct == pytest.approx(round(s.isna().mean() * 100, 2))
        want = [s.mean(), s.std(), s.min(), s.max(), *s.quantile([0.25, 0.5, 0.75])]
        assert [r["mean"], r.std_dev, r["min"], r["max"], r.p25, r.p50, r.p75] == pytest.approx(want, abs=1e-4)
    rough = {r.column: r for r in P.profile_columns(df, ["a", "b"], approximate=True).collect()}
    assert rough["a"].p50 == pytest.approx(rows["a"].p50, rel=0.02)
    assert P.top_null_columns(P.profile_columns(df, ["a", "b"]), 1).first().column == "a"


def test_profile_of_an_empty_column(spark):
    df = spark.range(5).select(F.lit(None).cast("double").alias("a"), F.col("id").cast("double").alias("b"))
    row = P.profile_columns(df, ["a", "b"]).where("column = 'a'").first()
    assert (row.null_pct, row.distinct_count, row["mean"], row.p50) == (100.0, 0, None, None)


def test_class_histogram_against_numpy(spark):
    rng = np.random.default_rng(3)
    good, bad = rng.gamma(2, 10, 2000), rng.gamma(3, 10, 700)
    pdf = pd.DataFrame({"is_bad": [0] * 2000 + [1] * 700, "x": np.concatenate([good, bad]), "flat": 4.0})
    cap = np.quantile(good, 0.99)
    rows = D.class_histogram(spark.createDataFrame(pdf), ["x", "flat"]).collect()
    for label, part in ((0, good), (1, bad)):
        counts, edges = np.histogram(np.minimum(part, cap), bins=50)
        got = sorted((r for r in rows if r.column == "x" and r.is_bad == label), key=lambda r: r.bin)
        assert [r.total for r in got] == list(counts)
        assert [r.left_edge for r in got] == pytest.approx(list(edges[:-1]))
        assert sum(r.density for r in got) * (edges[1] - edges[0]) == pytest.approx(1)
    flat = [r for r in rows if r.column == "flat" and r.is_bad == 0]
    assert len(flat) == 50 and sum(r.total for r in flat) == 2000 and min(r.left_edge for r in flat) == 3.5


def test_correlations_against_pandas(spark):
    rng = np.random.default_rng(4)
    pdf = pd.DataFrame(rng.normal(1e6, 1, (400, 3)), columns=["a", "b", "is_bad"])
    pdf["b"] += pdf["a"]
    pdf.loc[3, "a"] = np.nan
    df = spark.createDataFrame(pdf).replace(float("nan"), None)
    want = pdf.dropna().corr()
    matrix = D.correlation_matrix(df, ["a", "b", "is_bad"])
    got = {(r.feature_a, r.feature_b): r.corr for r in matrix.collect()}
    assert len(got) == 9
    for (a, b), value in got.items():
        assert value == pytest.approx(want.loc[a, b], abs=1e-9)
    order = [abs(r.corr) for r in D.target_correlation_rank(matrix).collect()]
    assert order == sorted(order, reverse=True) and len(order) == 2


def test_correlations_far_from_zero(spark):
    """Means 10^8 times the deviation, one constant column, and the loans scanned once."""
    rng = np.random.default_rng(8)
    x = rng.normal(size=4000)
    a, b = 1e8 + x, -1e8 + 0.5 * x + rng.normal(size=4000)
    rows = [(float(p), float(q), 7.0) for p, q in zip(a, b)] + [(None, 1.0, 7.0)]
    df = spark.createDataFrame(rows, "a double, b double, flat double")
    matrix = D.correlation_matrix(df, ["a", "b", "flat"], pilot_rows=10)
    found = {(r.feature_a, r.feature_b): r.corr for r in matrix.collect()}
    assert found["a", "b"] == pytest.approx(np.corrcoef(a, b)[0, 1], abs=1e-7)
    assert found["a", "flat"] is None and found["flat", "flat"] == 1.0
    assert matrix._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 1


def test_merged_sketches(spark):
    """Parts stored one by one merge to the profile of all rows, within the stated bounds."""
    rng = np.random.default_rng(5)
    n = 30_000
    pdf = pd.DataFrame({"part": rng.integers(0, 4, n), "a": 1e6 + np.round(rng.gamma(2, 1000, n), 1),
                        "b": rng.integers(0, 3, n).astype(float)})
    df = spark.createDataFrame(pdf).withColumns({
        "a": F.when((F.col("part") != 3) & (F.col("a") < 1e6 + 9000), F.col("a")),   # a part without any value
        "none": F.lit(None).cast("double")})
    columns = ["a", "b", "none"]
    parts = [P.profile_parts(df.where(F.col("part") == i), columns=columns) for i in range(4)]
    stored = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])
    merged = {r.column: r for r in P.merged_profile(stored).collect()}
    grouped = {r.column: r for r in P.merged_profile(P.profile_parts(df, ["part"], columns)).collect()}
    exact = {r.column: r for r in P.profile_columns(df, columns).collect()}
    for name in columns:
        for rough in (merged[name], grouped[name]):
            for field in ("total_rows", "null_count", "null_pct", "mean", "std_dev", "min", "max"):
                want = exact[name][field]
                assert rough[field] == (want if want is None else pytest.approx(want, rel=1e-9, abs=1e-4))
            assert rough.distinct_count == pytest.approx(exact[name].distinct_count, rel=0.03)
            if name != "none":
                values = np.sort([r[0] for r in df.where(f"{name} is not null").select(name).collect()])
                for field, p in P.QUARTILES.items():
                    low, high = (np.searchsorted(values, rough[field], side) / len(values) for side in ("left", "right"))
                    assert low - 0.01 <= p <= high + 0.01
    assert merged["none"].p50 is None and merged["none"]["mean"] is None
