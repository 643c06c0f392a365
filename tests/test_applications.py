"""Validation and scoring of applications, models, and the whole warehouse."""

import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from __spark_entry__ import queries
from checks import loan_view as L, registry as Q
from riskloom import fixed_values as V
from riskloom.operators import applications as A, cleaning, models as M, woe as W
from riskloom.plans import warehouse
from riskloom.sources.storage import materialize, scratch_path
from riskloom.streaming import scoring as stream

GOOD = {"id": 1, "loan_amnt": 10000.0, "term_months": 36, "int_rate": 7.5, "grade": "a", "emp_length_yrs": 8.0,
        "annual_inc": 85000.0, "home_ownership": "Mortgage", "dti": 12.5, "fico_avg": 740.0,
        "inq_last_6mths": 0, "open_acc": 8, "pub_rec": 0, "revol_util": 15.0, "total_acc": 20,
        "delinq_2yrs": 0, "verification_status": "Verified", "purpose": "debt_consolidation",
        "application_type": None}
BAD = GOOD | {"id": 2, "loan_amnt": 35000.0, "term_months": 60, "int_rate": 28.0, "grade": "G",
              "emp_length_yrs": 0.0, "annual_inc": 22000.0, "home_ownership": "RENT", "dti": 45.0,
              "fico_avg": 592.0, "inq_last_6mths": 6, "open_acc": 2, "pub_rec": 2, "revol_util": 92.0,
              "total_acc": 4, "delinq_2yrs": 4, "verification_status": "Not Verified",
              "purpose": "small_business", "application_type": "Individual"}
SCHEMA = ("id long, loan_amnt double, term_months int, int_rate double, grade string, emp_length_yrs double, "
          "annual_inc double, home_ownership string, dti double, fico_avg double, inq_last_6mths int, "
          "open_acc int, pub_rec int, revol_util double, total_acc int, delinq_2yrs int, "
          "verification_status string, purpose string, application_type string")


def apps(spark, *rows):
    names = [part.split()[0] for part in SCHEMA.split(", ")]
    return spark.createDataFrame([tuple(r[n] for n in names) for r in rows], SCHEMA)


@pytest.fixture(scope="module")
def woe(spark, sf):
    return Q.fitted_woe(spark, sf)


def test_valid_and_normalized(spark):
    valid, rejects = A.validate_applications(apps(spark, GOOD, BAD))
    rows = {r.id: r for r in valid.collect()}
    assert rejects.count() == 0 and len(rows) == 2
    assert (rows[1].grade, rows[1].home_ownership, rows[1].application_type) == ("A", "MORTGAGE", "Individual")


BREAKS = [("loan_amnt", 0.0), ("loan_amnt", 40000.01), ("term_months", 48), ("int_rate", 0.0), ("int_rate", 35.1),
          ("grade", "Z"), ("grade", None), ("emp_length_yrs", 11.0), ("annual_inc", 0.0), ("home_ownership", "ANY"),
          ("dti", None), ("dti", 60.5), ("fico_avg", 579.0), ("fico_avg", 851.0), ("revol_util", 101.0),
          ("open_acc", -1), ("verification_status", None), ("purpose", None)]


def test_each_rule(spark):
    broken = [GOOD | {"id": i, field: value} for i, (field, value) in enumerate(BREAKS)]
    valid, rejects = A.validate_applications(apps(spark, *broken))
    assert valid.count() == 0
    for row in rejects.collect():
        assert [e.split(":")[0] for e in row.errors] == [BREAKS[row.id][0]]
    _, twice = A.validate_applications(apps(spark, GOOD | {"grade": "Z", "dti": -1.0}))
    assert len(twice.first().errors) == 2


def test_good_and_bad_borrower(spark, woe):
    steep = {f: 3 * w for f, w in L.CHAMPION_COEFFICIENTS.items()}
    scored = A.score_applications(apps(spark, GOOD, BAD), woe, Q.points_table(spark), steep, L.CHAMPION_INTERCEPT)
    good, bad = scored.orderBy("id").collect()
    assert good.decision == "APPROVED" and 300 <= good.credit_score <= 850
    assert bad.probability_of_default > 0.35 and bad.credit_score < 700
    assert set(good.scorecard_points) == set(L.CHAMPION_COEFFICIENTS) - {"purpose_woe", "application_type_woe"}
    summary = A.batch_decision_summary(scored).first()
    assert summary.total_applications == 2 and summary.declined == 2 - summary.approved


def test_review_counts_as_declined(spark):
    df = spark.createDataFrame([("APPROVED",), ("REVIEW",), ("DECLINED",)], "decision string")
    assert tuple(A.batch_decision_summary(df).first()) == (3, 1, 2)


def test_stream_equals_batch(spark, sf):
    batch = materialize(queries()["score_applications"](spark, sf))
    streamed = materialize(queries()["score_stream"](spark, sf))
    scores = streamed.where("errors IS NULL").drop("errors")
    assert batch.exceptAll(scores).count() == 0 and scores.exceptAll(batch).count() == 0
    _, rejects = A.validate_applications(Q.applications(Q.derived(spark, sf)))
    errors = materialize(rejects.select("id", F.concat_ws("; ", "errors").alias("errors")))
    rejected = streamed.where("errors IS NOT NULL").select("id", "errors")
    assert errors.exceptAll(rejected).count() == 0 and rejected.exceptAll(errors).count() == 0 < errors.count()


def test_stream_after_a_crash(spark, sf, woe, monkeypatch):
    """The second batch dies between its scores and its rejects; a restart repeats and loses nothing."""
    inbox, output, state = (scratch_path(spark, n) for n in ("inbox", "scored", "state"))
    made = Q.applications(Q.derived(spark, sf)).limit(300)
    made.repartition(4).write.parquet(inbox)
    given = (woe, Q.points_table(spark), L.CHAMPION_COEFFICIENTS, L.CHAMPION_INTERCEPT)

    def run():
        source = stream.read_application_stream(spark, inbox, made.schema, files_per_batch=2)
        return stream.score_stream(source, *given, output, state)

    def broken(df):
        checked = A.check_applications(df)
        if df.sparkSession.conf.get("riskloom.batches", "0") != "1":
            df.sparkSession.conf.set("riskloom.batches", "1")
            return checked
        return checked.withColumn("errors", F.when(F.size("errors") > 0, F.raise_error(F.lit("crash")).cast("array<string>"))
                                  .otherwise(F.col("errors")))

    monkeypatch.setattr(stream, "check_applications", broken)
    with pytest.raises(Exception, match="crash"):
        run().awaitTermination()
    monkeypatch.undo()
    first = stream.read_scores(spark, output).where("batch = 0").count()
    run().awaitTermination()
    run().awaitTermination()   # nothing is left to do
    stored = spark.read.parquet(inbox)
    scores, rejects = A.score_or_reject(stored, *given)
    got = stream.read_scores(spark, output)
    assert 0 < first < got.count() == scores.count()
    assert got.drop("batch", "scorecard_points").exceptAll(scores.drop("scorecard_points")).count() == 0
    left = stream.read_rejects(spark, output).drop("batch")
    assert left.exceptAll(rejects.select(left.columns)).count() == 0 < left.count() == rejects.count()


def test_contributions_are_sorted(spark):
    long = spark.createDataFrame([(1, "grade_woe", 0.5), (1, "dti_band_woe", -0.5), (1, "other", 1.0)],
                                 "id long, feature string, woe double")
    sorted_ = A.sort_contributions(A.join_points(long, Q.points_table(spark)))
    assert "rangepartitioning" not in sorted_._jdf.queryExecution().executedPlan().toString()
    rows = sorted_.orderBy("id", "place").collect()
    assert [r.factor for r in rows] == ["Loan Grade", "DTI Ratio"]
    assert rows[0].contribution == pytest.approx(-14.43)


def test_scorecard_fit(spark, sf, woe):
    ready = W.model_input(Q.derived(spark, sf), woe).cache()
    train = ready.where("split = 'train'")
    model = M.fit_scorecard(train)
    coefficients, intercept = M.coefficients_of(model)
    ready_made = M._vectors(train.withColumns({"weight": M.balanced_weight(train), "label": F.col("is_bad").cast("double")}),
                            V.WOE_FEATURES)
    library = LogisticRegression(featuresCol="inputs", labelCol="label", weightCol="weight", tol=1e-12,
                                 maxIter=500).fit(ready_made)
    by_hand = M.score_champion(M.score_with(library, train, V.WOE_FEATURES, "pd"), coefficients, intercept)
    assert by_hand.where(F.abs(F.col("pd") - F.col("champ_pd")) > 2e-6).count() == 0
    assert model.steps < 15 and model.change < 1e-10
    for row in M.score_equations(train, model).collect():
        assert row.observed == pytest.approx(row.predicted, abs=1e-10)
    # Balanced classes: the mean prediction is about a half.
    assert by_hand.agg(F.avg("pd")).first()[0] == pytest.approx(0.5, abs=0.05)
    points = {r.feature: r.points_per_unit_woe for r in M.scorecard_points(ready, coefficients).collect()}
    assert points["grade_woe"] == pytest.approx(-28.8539 * coefficients["grade_woe"], rel=1e-4)


def test_scorecard_fit_on_odd_inputs(spark):
    """An input without spread, one that repeats another, gaps, one outcome only, separated outcomes."""
    rows = [(i % 3 == 0 and 1 or i % 2, float(i % 5) if i % 7 else None, 0.0) for i in range(200)]
    df = spark.createDataFrame(rows, "is_bad int, a double, flat double").withColumn("twin", F.col("a"))
    model = M.fit_scorecard(df, ["a", "flat", "twin"], balanced=False)
    alone = M.fit_scorecard(df, ["a"], balanced=False)
    assert model.coefficients["flat"] == pytest.approx(0, abs=1e-9)
    assert model.coefficients["a"] == pytest.approx(model.coefficients["twin"], abs=1e-8)
    assert 2 * model.coefficients["a"] == pytest.approx(alone.coefficients["a"], abs=1e-8)
    with pytest.raises(ValueError, match="outcomes"):
        M.fit_scorecard(df.where("is_bad = 1"), ["a"], balanced=False)
    apart = df.withColumn("a", F.col("is_bad").cast("double"))
    with pytest.raises(ValueError, match="no fit"):
        M.fit_scorecard(apart, ["a"], balanced=False)


def test_scoring_rejects_foreign_inputs(spark, sf):
    with pytest.raises(ValueError):
        M.score_champion(Q.derived(spark, sf), {"loan_status": 1.0}, 0.0)


def test_missing_inputs_count_as_zero(spark):
    df = spark.createDataFrame([(None, 700.0, 10.0)], "dti double, fico_avg double, int_rate double")
    full = df.fillna(0.0)
    args = ({name: L.CHALLENGER_COEFFICIENTS[name] for name in df.columns}, L.CHALLENGER_INTERCEPT)
    assert M.score_challenger(df, *args).first().chall_pd == M.score_challenger(full, *args).first().chall_pd
    assert cleaning.fill_missing(df, ["dti"]).first().dti == 0


def test_extreme_applicants(spark, woe):
    rows = {r.applicant: r for r in M.extreme_applicants(woe, L.CHAMPION_COEFFICIENTS, L.CHAMPION_INTERCEPT).collect()}
    assert rows["best"].pd < rows["worst"].pd and rows["best"].score_minmax >= rows["worst"].score_minmax


def test_high_dti_survives_as_null(spark, sf):
    clean = Q.clean(spark, sf)
    gone = clean.where("dti IS NULL").count()
    assert gone == Q.staged(spark, sf).where(
        "dti > 60 AND annual_inc > 0 AND loan_amnt > 0 AND fico_avg BETWEEN 580 AND 850").count() > 0


def test_warehouse_from_csv(spark, sf):
    path, root = scratch_path(spark, "accepted"), scratch_path(spark, "warehouse")
    L.loans_full(spark, sf).write.options(header=True, escape='"', ignoreLeadingWhiteSpace=False).csv(path)
    built = warehouse.build_warehouse(spark, path, root, L.TRAIN_LAST, L.VALIDATION)
    assert len(built.staged.columns) == 35 and len(built.features.columns) == 42
    assert len(built.model_input.columns) == 33 and built.profile.count() == 20 and built.iv.count() == 10
    assert built.model_input.count() == built.features.count() == Q.derived(spark, sf).count()
    direct, _ = warehouse.model_table(L.loans_raw(spark, sf), L.TRAIN_LAST, L.VALIDATION)
    names = ["id", "is_bad", "split", *V.WOE_FEATURES]
    assert direct.select(names).exceptAll(built.model_input.select(names)).count() == 0
    for row in built.iv.collect():
        assert row.iv >= -1e-6
