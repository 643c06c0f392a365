"""Queries over WoE, portfolio views, scoring, ranking, drift and the A/B test."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from checks import loan_sql as S, loan_view as L, registry as R
from checks.registry import query
from riskloom import fixed_values as V
from riskloom.functions import bands as B, scoring as Sc
from riskloom.functions.numeric import half_even
from riskloom.operators import (applications as A, bootstrap, champion, distributions, models,
                                monitoring, portfolio, ranking, woe as W)
from riskloom.plans import evaluation, warehouse
from riskloom.sources import csv
from riskloom.sources.storage import materialize, scratch_path
from riskloom.streaming import scoring as stream

c = F.col
REPLICATES = V.BOOTSTRAP_ITERATIONS  # of the per-loan bootstrap, which SQL can follow


def re(x: str, digits: int) -> str:
    return f"round_even({x}, {digits})"


# ------------------------------------------------------------ WoE and encoding
_WOE_OUT = ("SELECT feature, bin, total, events, non_events, bad_rate_pct, "
            f"{re('dist_events', 6)} AS dist_events, {re('dist_non_events', 6)} AS dist_non_events, "
            "woe, iv_component FROM woe")


@query("woe_table", S.sql("woe", _WOE_OUT))
def woe_table(spark, sf):
    return R.rounded(W.woe_table(R.derived(spark, sf)), 6, "dist_events", "dist_non_events")


@query("union_feature_bins", S.sql("bins", "SELECT * FROM bins"))
def union_feature_bins(spark, sf):
    train = R.derived(spark, sf).where(c("split") == "train")
    return W.union_feature_bins(train, V.BINNED_FEATURES)


_IV = f"SELECT feature, {S.dr('sum(iv_component)', 4)} AS iv FROM woe GROUP BY feature"


@query("iv_summary", S.sql("woe", _IV))
def iv_summary(spark, sf):
    return W.iv_summary(W.woe_table(R.derived(spark, sf)))


@query("read_points", S.sql("woe", f"SELECT feature || '_woe' AS feature, {re(f'(-({S.FACTOR!r}e0) * iv)', 4)} "
                            f"AS points_per_unit_woe FROM ({_IV})"))
def read_points(spark, sf):
    """Points from the information values, written as a report and read as points."""
    factor, _ = Sc.odds_scale()
    iv = W.iv_summary(W.woe_table(R.derived(spark, sf)))
    path = scratch_path(spark, "points")
    csv.write_csv_report(iv.select(F.concat("feature", F.lit("_woe")).alias("feature"), "iv",
                                   (-F.lit(factor) * c("iv")).alias("points_per_unit_woe")), path)
    return R.rounded(csv.read_points(spark, path), 4, "points_per_unit_woe")


@query("iv_strength", S.sql("woe", "SELECT feature, CASE WHEN iv > 0.3 THEN 'strong' WHEN iv > 0.1 THEN 'medium' "
                            f"WHEN iv >= 0.02 THEN 'weak' ELSE 'useless' END AS strength FROM ({_IV})"))
def iv_strength(spark, sf):
    iv = W.iv_summary(W.woe_table(R.derived(spark, sf)))
    return iv.select("feature", B.iv_strength(c("iv")).alias("strength"))


@query("apply_woe", S.sql("encoded", "SELECT " + ", ".join(S.MODEL_INPUT_COLUMNS) + " FROM encoded"))
def apply_woe(spark, sf):
    model_input, _ = warehouse.model_table(R.raw(spark, sf), L.TRAIN_LAST, L.VALIDATION)
    return model_input


@query("lookup_woe", S.sql("encoded", "SELECT id, grade_woe, dti_band_woe, CASE WHEN application_type = 'Joint App' "
                           "THEN 0e0 ELSE application_type_woe END AS application_type_woe FROM encoded"))
def lookup_woe(spark, sf):
    made, woe = R.with_woe(spark, sf)
    return W.lookup_woe(made, woe.where(c("bin") != "Joint App")).select(
        "id", "grade_woe", "dti_band_woe", "application_type_woe")


@query("woe_extremes", S.sql("woe", "SELECT feature, min(woe) AS min_woe, max(woe) AS max_woe, "
                             "arg_max(bin, woe) AS max_bin FROM woe GROUP BY feature"))
def woe_extremes(spark, sf):
    return W.woe_extremes(W.woe_table(R.derived(spark, sf)))


def _champion_at(which: str) -> str:
    parts = "".join(
        f" + ({w!r}e0) * (SELECT {which}(woe) FROM woe WHERE feature = '{f.removesuffix('_woe')}')"
        for f, w in L.CHAMPION_COEFFICIENTS.items())
    return f"(1e0 / (1e0 + exp(-(({L.CHAMPION_INTERCEPT!r}e0){parts}))))"


@query("extreme_applicants", S.sql(
    "woe", f"SELECT applicant, {re('pd', 6)} AS pd, {S.minmax_score('pd')} AS score_minmax, "
    f"CAST({re(S.odds_score('pd'), 0)} AS INTEGER) AS score_odds FROM ("
    f"SELECT 'best' AS applicant, {_champion_at('min')} AS pd UNION ALL "
    f"SELECT 'worst', {_champion_at('max')})"))
def extreme_applicants(spark, sf):
    woe = W.woe_table(R.derived(spark, sf))
    rows = models.extreme_applicants(woe, L.CHAMPION_COEFFICIENTS, L.CHAMPION_INTERCEPT)
    return R.rounded(rows, 6, "pd")


# -------------------------------------------------------------- portfolio views
_BAD_PCT = S.dr("(avg(is_bad) * 100)", 2)


@query("bad_rate_by_grade", S.sql("staged", f"SELECT grade, count(*) AS total_loans, CAST(sum(is_bad) AS BIGINT) AS bad_loans, "
       f"{_BAD_PCT} AS bad_rate_pct, {S.dr('avg(int_rate)', 2)} AS avg_int_rate, "
       f"{S.dr('avg(loan_amnt)', 0)} AS avg_loan_amnt FROM staged GROUP BY grade"))
def bad_rate_by_grade(spark, sf):
    return portfolio.bad_rate_by_grade(R.staged(spark, sf))


@query("bad_rate_by_vintage_year", S.sql("staged", f"SELECT vintage_year, count(*) AS total_loans, {_BAD_PCT} AS bad_rate_pct, "
       f"{S.dr('avg(loan_amnt)', 0)} AS avg_loan_amnt FROM staged GROUP BY vintage_year"))
def bad_rate_by_vintage_year(spark, sf):
    return portfolio.bad_rate_by_vintage_year(R.staged(spark, sf))


@query("bad_rate_by_vintage_quarter", S.sql("staged", f"SELECT vintage_year, vintage_quarter, {S.VINTAGE} AS vintage, "
       f"count(*) AS total_loans, {_BAD_PCT} AS bad_rate_pct FROM staged GROUP BY ALL"))
def bad_rate_by_vintage_quarter(spark, sf):
    return portfolio.bad_rate_by_vintage_quarter(R.staged(spark, sf))


def _share(key: str) -> str:
    return (f"SELECT {key}, count(*) AS n, {S.dr('(count(*) * 100e0 / (SELECT count(*) FROM staged))', 2)} AS pct "
            f"FROM staged GROUP BY {key}")


@query("target_distribution", S.sql("staged", _share("is_bad")))
def target_distribution(spark, sf):
    return portfolio.target_distribution(R.staged(spark, sf))


@query("share_of_total", S.sql("staged", _share("purpose")))
def share_of_total(spark, sf):
    counts = R.staged(spark, sf).groupBy("purpose").agg(F.count("*").alias("n"))
    return portfolio.share_of_total(counts)


@query("order_groups", S.sql("staged", "SELECT emp_length_yrs, count(*) AS n FROM staged GROUP BY 1 ORDER BY 1 NULLS LAST"))
def order_groups(spark, sf):
    counts = R.staged(spark, sf).groupBy("emp_length_yrs").agg(F.count("*").alias("n"))
    return portfolio.order_groups(counts, "emp_length_yrs")


@query("portfolio_summary", S.sql("staged", f"SELECT count(*) AS total_loans, {_BAD_PCT} AS overall_bad_rate_pct, "
       + ", ".join(f"{S.dr(f'avg({n})', d)} AS {a}" for n, d, a in [
           ("loan_amnt", 0, "avg_loan_amount"), ("int_rate", 2, "avg_interest_rate"),
           ("fico_avg", 0, "avg_fico_score"), ("annual_inc", 0, "avg_annual_income"),
           ("dti", 2, "avg_dti")])
       + ", min(vintage_year) AS first_vintage, max(vintage_year) AS last_vintage FROM staged"))
def portfolio_summary(spark, sf):
    return portfolio.portfolio_summary(R.staged(spark, sf))


@query("split_summary", S.sql("features", f"SELECT split, count(*) AS n, {_BAD_PCT} AS bad_rate_pct FROM features GROUP BY split"))
def split_summary(spark, sf):
    return portfolio.split_summary(R.derived(spark, sf))


@query("categorical_bad_rates", S.sql("staged", "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{f}' AS feature, {f} AS category, {re('avg(is_bad)', 6)} AS bad_rate, count(*) AS total "
    f"FROM staged WHERE {f} IS NOT NULL GROUP BY {f}" for f in V.CATEGORICAL_COLUMNS) + ") WHERE total > 500"))
def categorical_bad_rates(spark, sf):
    return R.rounded(portfolio.categorical_bad_rates(R.staged(spark, sf)), 6, "bad_rate")


@query("fico_bin_stats", S.sql("staged", f"SELECT {S.case_cut('fico_avg', V.FICO_CUT[0], [1, 2, 3, 4, 5, 6])} AS bin_ord, "
       f"{S.case_cut('fico_avg', *V.FICO_CUT)} AS fico_bin, {re('avg(is_bad)', 6)} AS bad_rate, count(*) AS total "
       "FROM staged WHERE fico_avg > 580 AND fico_avg <= 850 GROUP BY 1, 2"))
def fico_bin_stats(spark, sf):
    return R.rounded(portfolio.fico_bin_stats(R.staged(spark, sf)), 6, "bad_rate")


_COMPLETE = "complete AS (SELECT " + ", ".join(
    f"CAST({n} AS DOUBLE) AS {n}" for n in V.CORRELATION_COLUMNS) + " FROM staged WHERE " + " AND ".join(
    f"{n} IS NOT NULL" for n in V.CORRELATION_COLUMNS) + ")"
_PAIRS = list(combinations(V.CORRELATION_COLUMNS, 2))
_CORRELATIONS = "SELECT unnest([" + ", ".join(
    f"{{'a': '{x}', 'b': '{y}', 'v': corr({x}, {y})}}" for x, y in _PAIRS) + "]) AS p FROM complete"
_MATRIX = ("SELECT p.a AS feature_a, p.b AS feature_b, p.v AS corr FROM pairs UNION ALL "
           "SELECT p.b, p.a, p.v FROM pairs UNION ALL SELECT n, n, 1e0 FROM (SELECT unnest(["
           + ", ".join(f"'{n}'" for n in V.CORRELATION_COLUMNS) + "]) AS n)")


@query("correlation_matrix", S.sql("staged", f"SELECT feature_a, feature_b, {re('corr', 6)} AS corr FROM ({_MATRIX})",
                                   _COMPLETE, f"pairs AS ({_CORRELATIONS})"))
def correlation_matrix(spark, sf):
    return R.rounded(distributions.correlation_matrix(R.staged(spark, sf)), 6, "corr")


@query("target_correlation_rank", S.sql("staged", f"SELECT feature_a AS feature, {re('corr', 4)} AS corr FROM ({_MATRIX}) "
       "WHERE feature_b = 'is_bad' AND feature_a <> 'is_bad'", _COMPLETE, f"pairs AS ({_CORRELATIONS})"))
def target_correlation_rank(spark, sf):
    return distributions.target_correlation_rank(distributions.correlation_matrix(R.staged(spark, sf)))


_LONG = "long AS (" + " UNION ALL ".join(
    f"SELECT '{n}' AS \"column\", is_bad, least(CAST({n} AS DOUBLE), (SELECT quantile_cont(CAST({n} AS DOUBLE), 0.99) "
    f"FROM staged WHERE is_bad = 0)) AS v FROM staged WHERE {n} IS NOT NULL" for n in V.HISTOGRAM_COLUMNS) + ")"
_RANGES = ('ranges AS (SELECT "column", is_bad, min(v) AS lo, max(v) AS hi, count(*) AS n, (max(v) - min(v)) / 50 AS w '
           "FROM long GROUP BY ALL)")
_PLACED = ('placed AS (SELECT "column", is_bad, CAST(least(floor((v - lo) / (hi - lo) * 50), 49) AS INTEGER) AS bin, '
           'count(*) AS total FROM long JOIN ranges USING ("column", is_bad) GROUP BY ALL)')


@query("class_histogram", S.sql(
    "staged", 'SELECT r."column", r.is_bad, CAST(b.bin AS INTEGER) AS bin, '
    f"{re('(lo + b.bin * w)', 6)} AS left_edge, coalesce(total, 0) AS total, "
    f"{re('(coalesce(total, 0) / (n * w))', 6)} AS density FROM ranges r, (SELECT unnest(range(50)) AS bin) b "
    'LEFT JOIN placed p ON p."column" = r."column" AND p.is_bad = r.is_bad AND p.bin = b.bin',
    _LONG, _RANGES, _PLACED))
def class_histogram(spark, sf):
    return R.rounded(distributions.class_histogram(R.staged(spark, sf)), 6, "left_edge", "density")


# ------------------------------------------------------------------- scoring
@query("score_minmax", S.sql("scored", f"SELECT id, {S.minmax_score('chall_pd')} AS score, "
       f"{re('least(greatest(' + S.minmax_raw('chall_pd') + ', 300e0), 850e0)', 6)} AS raw_score FROM scored"))
def score_minmax(spark, sf):
    pd = c("chall_pd")
    return R.scored(spark, sf).select("id", Sc.score_minmax(pd).alias("score"),
                                      half_even(Sc.score_minmax(pd, rounded=False), 6).alias("raw_score"))


@query("score_odds", S.sql("staged", f"SELECT id, {re(S.odds_score('pd'), 0)} AS score, "
                           f"{re(S.odds_score('pd'), 4)} AS raw_score FROM spread", S.SPREAD))
def score_odds(spark, sf):
    return R.spread(spark, sf).select("id", Sc.score_odds(c("pd")).alias("score"),
                                      half_even(Sc.score_odds(c("pd"), rounded=False), 4).alias("raw_score"))


@query("risk_tier", S.sql("scored", f"SELECT id, score, {S.tier_case('score', 1)} AS risk_tier, {S.tier_case('score', 2)} AS decision, "
       f"{S.tier_case('score', 3)} AS decision_reason FROM (SELECT id, {S.minmax_score('chall_pd')} AS score FROM scored)"))
def risk_tier(spark, sf):
    score = c("score")
    return R.scored(spark, sf).select("id", Sc.score_minmax(c("chall_pd")).alias("score")).select(
        "id", "score", Sc.risk_tier(score).alias("risk_tier"), Sc.decision(score).alias("decision"),
        Sc.decision_reason(score).alias("decision_reason"))


@query("predict_linear", S.sql("encoded", f"SELECT id, {re(S.CHALLENGER_PD, 6)} AS pd FROM encoded"))
def predict_linear(spark, sf):
    filled = R.derived(spark, sf).fillna(0, list(L.CHALLENGER_COEFFICIENTS))
    pd = Sc.predict_linear(L.CHALLENGER_COEFFICIENTS, L.CHALLENGER_INTERCEPT)
    return filled.select("id", half_even(pd, 6).alias("pd"))


@query("score_champion", S.sql("scored", "SELECT id, champ_pd FROM scored"))
def score_champion(spark, sf):
    return models.score_champion(R.encoded(spark, sf), L.CHAMPION_COEFFICIENTS,
                                 L.CHAMPION_INTERCEPT).select("id", "champ_pd")


@query("score_challenger", S.sql("scored", "SELECT id, chall_pd FROM scored"))
def score_challenger(spark, sf):
    return models.score_challenger(R.derived(spark, sf), L.CHALLENGER_COEFFICIENTS,
                                   L.CHALLENGER_INTERCEPT).select("id", "chall_pd")


_POINTED = {f: -S.FACTOR * w for f, w in L.CHAMPION_COEFFICIENTS.items()
            if f not in ("purpose_woe", "application_type_woe")}


def _points(f: str) -> str:
    return re(f"(coalesce({f}, 0e0) * ({_POINTED[f]!r}e0))", 2) if f in _POINTED else "CAST(NULL AS DOUBLE)"


_ALL_POINTS = ", ".join(f"{_points(f)} AS points_{f}" for f in V.WOE_FEATURES)


def _stored_points(spark):
    path = scratch_path(spark, "points")
    csv.write_csv_report(R.points_table(spark), path)
    return csv.read_points(spark, path)


def _spread_points(df):
    return df.select("*", *[F.try_element_at("scorecard_points", F.lit(f)).alias(f"points_{f}")
                            for f in V.WOE_FEATURES]).drop("scorecard_points")


@query("score_points", S.sql("encoded", f"SELECT id, {_ALL_POINTS} FROM encoded"))
def score_points(spark, sf):
    inputs = W.lookup_woe(*R.with_woe(spark, sf))
    pointed = A.score_points(inputs, _stored_points(spark))
    return _spread_points(pointed.select("id", "scorecard_points"))


_LONG_POINTS = " UNION ALL ".join(
    f"SELECT id, '{f}' AS feature, {f} AS woe, {_points(f)} AS points FROM encoded" for f in _POINTED)


def _long_woe(spark, sf):
    return R.encoded(spark, sf).select("id", *V.WOE_FEATURES).unpivot("id", V.WOE_FEATURES, "feature", "woe")


@query("join_points", S.sql("encoded", _LONG_POINTS))
def join_points(spark, sf):
    return A.join_points(_long_woe(spark, sf), R.points_table(spark)).select("id", "feature", "woe", "points")


@query("sort_contributions", S.sql("encoded", "SELECT *, CAST(row_number() OVER (PARTITION BY id ORDER BY contribution NULLS FIRST, factor) "
    "AS INTEGER) AS place FROM (SELECT id, CASE feature " + " ".join(
    f"WHEN '{f}' THEN '{n}'" for f, n in V.FACTOR_NAMES.items()) + " END AS factor, points AS contribution "
    f"FROM ({_LONG_POINTS}))"))
def sort_contributions(spark, sf):
    return A.sort_contributions(A.join_points(_long_woe(spark, sf), R.points_table(spark)))


# -------------------------------------------------------------- applications
_APPS = ("apps AS (SELECT " + ", ".join(L.APPLICATION_COLUMNS)
         + ", fico_band, dti_band, loan_amnt_band, emp_stability, int_rate_band, "
         + ", ".join(f"coalesce({f}, 0e0) AS {f}" for f in V.WOE_FEATURES)
         + " FROM encoded)")
_FIELD_CHECKS = [
    ("loan_amnt", "above 0, at most 40000", "loan_amnt > 0 AND loan_amnt <= 40000"),
    ("term_months", "36 or 60", "term_months IN (36, 60)"),
    ("int_rate", "above 0, at most 35", "int_rate > 0 AND int_rate <= 35"),
    ("grade", "A to G", "upper(grade) BETWEEN 'A' AND 'G' AND length(grade) = 1"),
    ("emp_length_yrs", "0 to 10", "emp_length_yrs >= 0 AND emp_length_yrs <= 10"),
    ("annual_inc", "above 0", "annual_inc > 0"),
    ("home_ownership", "one of RENT OWN MORTGAGE OTHER NONE",
     "upper(home_ownership) IN ('RENT', 'OWN', 'MORTGAGE', 'OTHER', 'NONE')"),
    ("dti", "0 to 60", "dti >= 0 AND dti <= 60"),
    ("fico_avg", "580 to 850", "fico_avg >= 580 AND fico_avg <= 850"),
    ("revol_util", "0 to 100", "revol_util >= 0 AND revol_util <= 100"),
    ("verification_status", "present", "verification_status IS NOT NULL"),
    ("purpose", "present", "purpose IS NOT NULL"),
    ("inq_last_6mths", "0 or more", "inq_last_6mths >= 0"),
    ("open_acc", "0 or more", "open_acc >= 0"),
    ("pub_rec", "0 or more", "pub_rec >= 0"),
    ("total_acc", "0 or more", "total_acc >= 0"),
    ("delinq_2yrs", "0 or more", "delinq_2yrs >= 0"),
]
_ERRORS = "concat_ws('; ', " + ", ".join(
    f"CASE WHEN coalesce({rule}, false) THEN NULL ELSE '{f}: {text}' END" for f, text, rule in _FIELD_CHECKS) + ")"


@query("validate_applications", S.sql("encoded", f"SELECT id, {_ERRORS} = '' AS is_valid, {_ERRORS} AS errors FROM apps", _APPS))
def validate_applications(spark, sf):
    valid, rejects = A.validate_applications(R.applications(R.derived(spark, sf)))
    return valid.select("id", F.lit(True).alias("is_valid"), F.lit("").alias("errors")).unionByName(
        rejects.select("id", F.lit(False).alias("is_valid"), F.concat_ws("; ", "errors").alias("errors")))


_RAW_PD = S.logistic(L.CHAMPION_COEFFICIENTS, L.CHAMPION_INTERCEPT)
_APP_SCORES = (f"SELECT id, score AS credit_score, {re('pd', 6)} AS probability_of_default, {S.tier_case('score', 1)} AS risk_tier, "
               f"{S.tier_case('score', 2)} AS decision, {S.tier_case('score', 3)} AS decision_reason, {_ALL_POINTS} "
               f"FROM (SELECT *, {S.minmax_score('pd')} AS score FROM (SELECT *, {_RAW_PD} AS pd FROM apps WHERE {_ERRORS} = ''))")


@query("score_applications", S.sql("encoded", _APP_SCORES, _APPS))
def score_applications(spark, sf):
    made, woe = R.with_woe(spark, sf)
    return _spread_points(A.score_applications(
        R.applications(made), woe, R.points_table(spark), L.CHAMPION_COEFFICIENTS, L.CHAMPION_INTERCEPT))


@query("score_stream", S.sql("encoded", f"SELECT *, NULL::VARCHAR AS errors FROM ({_APP_SCORES}) UNION ALL BY NAME "
                             f"SELECT id, {_ERRORS} AS errors FROM apps WHERE {_ERRORS} <> ''", _APPS))
def score_stream(spark, sf):
    """Two runs over a growing folder, the second from the checkpoint of the first; scores and rejects."""
    inbox, output, state = (scratch_path(spark, n) for n in ("inbox", "scored", "stream-state"))
    made, woe = R.with_woe(spark, sf)
    apps = R.applications(made)
    for half in (0, 1):
        apps.where(c("id") % 2 == half).repartition(4).write.mode("append").parquet(inbox)
        source = stream.read_application_stream(spark, inbox, apps.schema, files_per_batch=2)
        stream.score_stream(source, woe, R.points_table(spark), L.CHAMPION_COEFFICIENTS,
                            L.CHAMPION_INTERCEPT, output, state).awaitTermination()
    rejects = stream.read_rejects(spark, output).select("id", F.concat_ws("; ", "errors").alias("errors"))
    return _spread_points(stream.read_scores(spark, output).drop("batch")).unionByName(
        rejects, allowMissingColumns=True)


@query("batch_decision_summary", S.sql(
    "scored", "SELECT count(*) AS total_applications, count(*) FILTER (decision = 'APPROVED') AS approved, "
    "count(*) FILTER (decision <> 'APPROVED') AS declined FROM "
    f"(SELECT {S.tier_case(S.minmax_score('chall_pd'), 2)} AS decision FROM scored)"))
def batch_decision_summary(spark, sf):
    score = Sc.score_minmax(c("chall_pd"))
    return A.batch_decision_summary(R.scored(spark, sf).select(Sc.decision(score).alias("decision")))


@query("score_histogram", S.sql(
    "scored", "SELECT is_bad, bin, count(*) AS total, 300e0 + bin * 11e0 AS left_edge FROM (SELECT is_bad, CAST(least(floor("
    f"(least(greatest({S.minmax_raw('chall_pd')}, 300e0), 850e0) - 300e0) / 550e0 * 50), 49) AS INTEGER) AS bin "
    "FROM scored WHERE split = 'validation') GROUP BY ALL"))
def score_histogram(spark, sf):
    part = R.scored(spark, sf).where(c("split") == "validation")
    return distributions.score_histogram(part, "chall_pd")


# ------------------------------------------------------------ bands and drift
@query("score_band_stats", S.sql(
    "staged", "SELECT band_ord, score_band, count(*) AS total, CAST(sum(is_bad) AS BIGINT) AS bad, "
    f"{re('(sum(is_bad) * 100e0 / count(*))', 6)} AS bad_rate FROM (SELECT is_bad, "
    f"{S.case_cut('s', V.SCORE_BAND_CUT[0], list(range(1, 9)))} AS band_ord, {S.case_cut('s', *V.SCORE_BAND_CUT)} AS score_band "
    f"FROM (SELECT is_bad, {re(S.odds_score('pd'), 0)} AS s FROM spread)) GROUP BY 1, 2", S.SPREAD))
def score_band_stats(spark, sf):
    return R.rounded(monitoring.score_band_stats(R.spread(spark, sf), "pd"), 6, "bad_rate")


_PSI_BANDS = ", ".join(f"{{'i': {i}, 'b': '{b}'}}" for i, b in enumerate(V.PSI_CUT[1], start=1))


def _placed(pd: str) -> str:
    return (f"(SELECT {S.case_cut('s', V.PSI_CUT[0], list(range(1, 10)))} AS i FROM "
            f"(SELECT {S.odds_score(pd)} AS s FROM spread))")


_ALIGNED = (f"aligned AS (SELECT d.i AS band_ord, d.b AS band, "
            f"(SELECT count(*) FROM {_placed('pd')} e WHERE e.i = d.i) AS exp_count, "
            f"(SELECT count(*) FROM {_placed('pd_later')} a WHERE a.i = d.i) AS act_count "
            f"FROM (SELECT unnest([{_PSI_BANDS}], recursive := true)) d)")
_SHARED = ("shared AS (SELECT band_ord, band, exp_count / sum(exp_count) OVER () AS exp_pct, "
           "act_count / sum(act_count) OVER () AS act_pct FROM aligned)")
_COMPONENT = "((act_pct - exp_pct) * ln((act_pct + 1e-10) / (exp_pct + 1e-10)))"


def _two_populations(spark, sf):
    both = R.spread(spark, sf)
    return [both.select(Sc.score_odds(c(p), rounded=False).alias("score")) for p in ("pd", "pd_later")]


@query("align_bands", S.sql("staged", "SELECT band_ord, band, exp_count, act_count FROM aligned", S.SPREAD, _ALIGNED))
def align_bands(spark, sf):
    return monitoring.align_bands(*_two_populations(spark, sf)).select("band_ord", "band", "exp_count", "act_count")


@query("psi", S.sql("staged", f"SELECT band_ord, band, {re('exp_pct', 6)} AS exp_pct, {re('act_pct', 6)} AS act_pct, "
                    f"{re(_COMPONENT, 6)} AS psi_component FROM shared", S.SPREAD, _ALIGNED, _SHARED))
def psi(spark, sf):
    return R.rounded(monitoring.psi(*_two_populations(spark, sf)), 6, "exp_pct", "act_pct", "psi_component")


@query("psi_status", S.sql(
    "staged", f"SELECT {re('p', 6)} AS psi, CASE WHEN p >= 0.25 THEN 'Retrain' WHEN p >= 0.1 THEN 'Monitor' ELSE 'Stable' END "
    f"AS status FROM (SELECT sum({_COMPONENT}) AS p FROM shared)", S.SPREAD, _ALIGNED, _SHARED))
def psi_status(spark, sf):
    return R.rounded(monitoring.psi_total(monitoring.psi(*_two_populations(spark, sf))), 6, "psi")


@query("calibration_curve", S.sql(
    "oot", "SELECT bin, " + ", ".join(f"{re(f'avg({v})', 6)} AS {a}" for v, a in [
        ("chall_pd", "mean_predicted"), ("is_bad", "bad_share")]) + ", count(*) AS total FROM (SELECT *, "
    f"{S.case_cut('chall_pd', [-1] + [i / 10 for i in range(1, 11)], list(range(1, 11)))} AS bin FROM oot) GROUP BY bin"))
def calibration_curve(spark, sf):
    return R.rounded(monitoring.calibration_curve(R.challenger_oot(spark, sf)), 6, "mean_predicted", "bad_share")


# ------------------------------------------------------------------- ranking
def _ticks(pd: str, source: str = "oot") -> str:
    return (f"SELECT {pd} AS prob, sum(is_bad) AS pos, count(*) - sum(is_bad) AS neg FROM {source} GROUP BY 1")


def _curve(pd: str, name: str) -> str:
    return (f"{name} AS (SELECT prob, pos, neg, sum(pos) OVER w / sum(pos) OVER () AS tpr, "
            f"sum(neg) OVER w / sum(neg) OVER () AS fpr, sum(pos + neg) OVER w AS seen, sum(pos + neg) OVER () AS n, "
            f"sum(neg) OVER () - sum(neg) OVER w AS below, sum(pos) OVER () AS p_all, sum(neg) OVER () AS n_all "
            f"FROM ({_ticks(pd)}) WINDOW w AS (ORDER BY prob DESC))")


_CHALL, _CHAMP = _curve("chall_pd", "chall"), _curve("champ_pd", "champ")
_AUC = "(sum(pos * (below + neg / 2e0)) / (max(p_all) * max(n_all)))"


def _table(spark, sf):
    return ranking.threshold_table(R.challenger_oot(spark, sf))


@query("roc_curve", S.sql("oot", f"SELECT prob AS threshold, {re('tpr', 6)} AS tpr, {re('fpr', 6)} AS fpr FROM chall "
                          "UNION ALL SELECT NULL, 0e0, 0e0", _CHALL))
def roc_curve(spark, sf):
    return R.rounded(ranking.roc_curve(_table(spark, sf)), 6, "tpr", "fpr")


@query("auc_gini", S.sql("oot", f"SELECT {re(_AUC, 6)} AS auc, {re(f'(2 * {_AUC} - 1)', 6)} AS gini FROM chall", _CHALL))
def auc_gini(spark, sf):
    return R.rounded(ranking.auc_gini(_table(spark, sf)), 6, "auc", "gini")


@query("ks_statistic", S.sql("oot", f"SELECT {re('max(tpr - fpr)', 6)} AS ks FROM chall", _CHALL))
def ks_statistic(spark, sf):
    return R.rounded(ranking.ks_statistic(_table(spark, sf)), 6, "ks")


_KS_OUT = ", ".join(f"{re(e, 6)} AS {a}" for e, a in [
    ("(seen * 100e0 / n)", "pct_pop"), ("tpr", "cum_bad"), ("fpr", "cum_good"), ("(tpr - fpr)", "ks")])


@query("ks_curve", S.sql("oot", f"SELECT prob, {_KS_OUT} FROM chall", _CHALL))
def ks_curve(spark, sf):
    return R.rounded(ranking.ks_curve(_table(spark, sf)), 6, "pct_pop", "cum_bad", "cum_good", "ks")


@query("argmax_row", S.sql("oot", f"SELECT prob, {_KS_OUT} FROM chall ORDER BY round(tpr - fpr, 12) DESC, prob DESC LIMIT 1", _CHALL))
def argmax_row(spark, sf):
    best = ranking.argmax_row(ranking.ks_curve(_table(spark, sf)))
    return R.rounded(best, 6, "pct_pop", "cum_bad", "cum_good", "ks")


@query("compare_ks", S.sql(
    "oot", f"SELECT {re('a', 4)} AS champion_ks, {re('b', 4)} AS challenger_ks, {re('(b - a)', 4)} AS ks_diff, b > a AS challenger_wins "
    "FROM (SELECT (SELECT max(tpr - fpr) FROM champ) AS a, (SELECT max(tpr - fpr) FROM chall) AS b)", _CHAMP, _CHALL))
def compare_ks(spark, sf):
    return ranking.compare_ks(R.stored_oot(spark, sf), digits=models.PD_DIGITS)


_RANKED = ("ranked AS (SELECT id, is_bad, row_number() OVER (ORDER BY chall_pd DESC, md5(CAST(id AS VARCHAR)), id) AS place FROM oot)")
_TOP = ("tops AS (SELECT id, place, sum(is_bad) OVER (ORDER BY place) AS bads, sum(is_bad) OVER () AS all_bads, "
        "count(*) OVER () AS n FROM ranked)")


@query("gains_lift", S.sql(
    "oot", f"SELECT CAST(k AS INTEGER) AS percentile, place AS n_top, {re('(place * 100e0 / n)', 6)} AS pct_pop, "
    f"{re('(bads * 100e0 / all_bads)', 6)} AS gains, {re('((bads * 100e0 / all_bads) / (place * 100e0 / n))', 6)} AS lift "
    "FROM tops, (SELECT unnest(range(1, 101)) AS k) WHERE place = CAST(ceil(n * k / 100e0) AS BIGINT)", _RANKED, _TOP))
def gains_lift(spark, sf):
    return R.rounded(ranking.gains_lift(materialize(R.challenger_oot(spark, sf))), 6, "pct_pop", "gains", "lift")


@query("gains_by_loan", S.sql(
    "oot", f"SELECT id, place, {re('(place * 100e0 / n)', 6)} AS pct_pop, {re('(bads * 100e0 / all_bads)', 6)} AS gains, "
    f"{re('((bads * 100e0 / all_bads) / (place * 100e0 / n))', 6)} AS lift FROM tops", _RANKED, _TOP))
def gains_by_loan(spark, sf):
    return R.rounded(ranking.gains_by_loan(materialize(R.challenger_oot(spark, sf)), digits=models.PD_DIGITS), 6, "pct_pop", "gains", "lift")


@query("capture_at", S.sql(
    "oot", f"SELECT share, place AS n_top, {re('(bads * 100e0 / all_bads)', 6)} AS captured_pct "
    "FROM tops, (SELECT unnest([0.1e0, 0.3e0]) AS share) WHERE place = CAST(floor(n * share) AS BIGINT) + 1", _RANKED, _TOP))
def capture_at(spark, sf):
    return R.rounded(ranking.capture_at(materialize(R.challenger_oot(spark, sf))), 6, "captured_pct")


def _measured() -> str:
    """AUC by rank sums and KS by running shares, per model and split."""
    long = " UNION ALL ".join(f"SELECT '{m}' AS model, split, {p} AS prob, is_bad FROM scored WHERE split <> 'train'"
                              for m, p in (("champion", "champ_pd"), ("challenger", "chall_pd")))
    return ("measured AS (SELECT model, split, (sum(mid) FILTER (is_bad = 1) - p * (p + 1) / 2e0) / (p * q) AS auc, "
            "max(gap) AS ks FROM (SELECT model, split, is_bad, rank() OVER up + (count(*) OVER tie - 1) / 2e0 AS mid, "
            "sum(is_bad) OVER grp AS p, sum(1 - is_bad) OVER grp AS q, "
            "sum(is_bad) OVER down / sum(is_bad) OVER grp - sum(1 - is_bad) OVER down / sum(1 - is_bad) OVER grp AS gap "
            f"FROM ({long}) WINDOW grp AS (PARTITION BY model, split), tie AS (PARTITION BY model, split, prob), "
            "up AS (PARTITION BY model, split ORDER BY prob), down AS (PARTITION BY model, split ORDER BY prob DESC)) "
            "GROUP BY model, split, p, q)")


@query("model_comparison", S.sql("scored", "SELECT model, " + ", ".join(
    f"{re(f'max(CASE WHEN split = {chr(39)}{s}{chr(39)} THEN {e} END)', 6)} AS {s}_{m}"
    for s in ("validation", "oot") for m, e in (("auc", "auc"), ("ks", "ks"), ("gini", "2 * auc - 1")))
    + " FROM measured GROUP BY model", _measured()))
def model_comparison(spark, sf):
    long = ranking.long_scores(R.scored(spark, sf), evaluation.MODELS, ["split"])
    table = ranking.model_comparison(long, digits=models.PD_DIGITS)
    return R.rounded(table, 6, *[n for n in table.columns if n != "model"])


# ------------------------------------------------------- champion and challenger
_IMPACT = f"""impact AS (SELECT count(*) AS n_loans, avg(CAST(champ_pd < 0.25 AS INTEGER)) AS ra, avg(CAST(chall_pd < 0.25 AS INTEGER)) AS rb,
  coalesce(sum(champ_pd * 0.6e0 * loan_amnt) FILTER (champ_pd < 0.25), 0e0) AS ea,
  coalesce(sum(chall_pd * 0.6e0 * loan_amnt) FILTER (chall_pd < 0.25), 0e0) AS eb,
  CAST(coalesce(sum(is_bad) FILTER (champ_pd < 0.25), 0) AS BIGINT) AS fa,
  CAST(coalesce(sum(is_bad) FILTER (chall_pd < 0.25), 0) AS BIGINT) AS fb FROM oot)"""
_IMPACT_OUT = (f"n_loans, 0.25e0 AS threshold, 0.6e0 AS lgd, {re('ra', 4)} AS champ_approval_rate, {re('rb', 4)} AS chall_approval_rate, "
               f"{re('ea', 0)} AS champ_expected_loss, {re('eb', 0)} AS chall_expected_loss, {re('(ea - eb)', 0)} AS el_reduction, "
               f"{re('((ea - eb) / nullif(ea, 0) * 100)', 2)} AS el_reduction_pct, fa AS champ_false_negatives, "
               "fb AS chall_false_negatives, fa - fb AS fn_reduction")


@query("business_impact", S.sql("oot", f"SELECT {_IMPACT_OUT} FROM impact", _IMPACT))
def business_impact(spark, sf):
    return champion.business_impact(R.oot(spark, sf))


def _poisson_sql(u: str) -> str:
    """Number of k whose distribution function is at or below ``u``."""
    import math
    steps, total, term = [], 0.0, math.exp(-1)
    for k in range(12):
        total += term
        steps.append(f"CAST({u} >= {total!r}e0 AS INTEGER)")
        term /= k + 1
    return "(" + " + ".join(steps) + ")"


def _uniform_sql(text: str, part: str) -> str:
    return f"(CAST(('0x' || substr(md5({text}), {part} * 8 + 1, 8)) AS BIGINT) / 4294967296e0)"


_DRAWN = ("drawn AS MATERIALIZED (SELECT o.*, CAST(r AS INTEGER) AS replicate, "
          + _poisson_sql("u") + " AS weight FROM (SELECT o.*, r, "
          + _uniform_sql("CAST(id AS VARCHAR) || '-' || CAST(r // 4 AS VARCHAR)", "(r % 4)")
          + f" AS u FROM oot o, (SELECT unnest(range({REPLICATES})) AS r)) o)")
_WEIGHTED = "weighted AS (" + " UNION ALL ".join(
    f"SELECT '{m}' AS model, replicate, {p} AS prob, sum(weight * is_bad) AS pos, sum(weight * (1 - is_bad)) AS neg "
    "FROM drawn WHERE weight > 0 GROUP BY ALL" for m, p in evaluation.MODELS.items()) + ")"
_REPLICATES = ("replicates AS MATERIALIZED (SELECT model, replicate, round(sum(pos * (below + neg / 2e0)) / (sum(pos) * sum(neg)), 12) AS auc "
               "FROM (SELECT *, coalesce(sum(neg) OVER (PARTITION BY model, replicate ORDER BY prob "
               "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM weighted) GROUP BY ALL "
               "HAVING sum(pos) > 0 AND sum(neg) > 0)")
_SUMMARY = ("summary AS (SELECT model, count(*) AS n_replicates, avg(auc) AS mean, stddev_pop(auc) AS std, "
            "quantile_cont(auc, 0.025) AS lower, quantile_cont(auc, 0.975) AS upper FROM replicates GROUP BY model)")
_BOOT = (_DRAWN, _WEIGHTED, _REPLICATES, _SUMMARY)


def _replicates(loans):
    return materialize(bootstrap.hashed_replicates(loans, evaluation.MODELS, REPLICATES))


def _hashed(spark, sf):
    return _replicates(R.stored_oot(spark, sf))


@query("bootstrap_auc", S.sql("oot", "SELECT model, n_replicates, " + ", ".join(
    f"{re(m, 6)} AS {m}" for m in ("mean", "std", "lower", "upper")) + " FROM summary", *_BOOT))
def bootstrap_auc(spark, sf):
    return R.rounded(bootstrap.summarize_replicates(_hashed(spark, sf)), 6, "mean", "std", "lower", "upper")


@query("bootstrap_auc_ticks")
def bootstrap_auc_ticks(spark, sf):
    return bootstrap.bootstrap_auc(R.oot(spark, sf), evaluation.MODELS)


def _tail_sql(z: str) -> str:
    """Upper normal tail: a series near zero, a continued fraction further out."""
    terms, coefficient = [], 1.0
    for k in range(0, 60):
        terms.append(f"({coefficient!r}e0)" if "e" not in repr(coefficient) else f"({coefficient!r})")
        coefficient /= 2 * k + 3
    series = terms[-1]
    for t in reversed(terms[:-1]):
        series = f"({t} + ({z}) * ({z}) * {series})"
    bell = f"(exp(-({z}) * ({z}) / 2e0) / sqrt(2e0 * pi()))"
    near = f"(0.5e0 - {bell} * ({z}) * {series})"
    fraction = f"({z})"
    for k in range(40, 0, -1):
        fraction = f"(({z}) + {k}e0 / {fraction})"
    return f"(CASE WHEN abs({z}) < 5 THEN {near} WHEN ({z}) >= 5 THEN {bell} / {fraction} ELSE 1e0 END)"


_SIDES = ("sides AS (SELECT *, d / se AS z FROM (SELECT b.mean - a.mean AS d, sqrt(a.std * a.std + b.std * b.std) AS se "
          "FROM summary a, summary b WHERE a.model = 'champion' AND b.model = 'challenger'))")
_TESTED = f"tested AS (SELECT d, z, {_tail_sql('z')} AS p FROM sides)"
_TEST_OUT = (f"{re('d', 6)} AS auc_diff, {re('z', 4)} AS z_score, {re('p', 6)} AS p_value, p < 0.05 AS significant, 0.05e0 AS alpha")


@query("ztest_auc", S.sql("oot", f"SELECT {_TEST_OUT} FROM tested", *_BOOT, _SIDES, _TESTED))
def ztest_auc(spark, sf):
    return champion.ztest_auc(bootstrap.summarize_replicates(_hashed(spark, sf)))


_POSTERIOR = ("gaps AS (SELECT b.auc - a.auc AS uplift FROM replicates a, replicates b "
              "WHERE a.model = 'champion' AND b.model = 'challenger')",
              f"posterior AS (SELECT {re('avg(CAST(uplift > 0 AS INTEGER))', 4)} AS prob_challenger_wins, {re('avg(uplift)', 6)} AS expected_uplift, "
              f"{re('quantile_cont(uplift, 0.025)', 6)} AS uplift_ci_lower, {re('quantile_cont(uplift, 0.975)', 6)} AS uplift_ci_upper FROM gaps)")


@query("bayesian_ab", S.sql("oot", "SELECT * FROM posterior", *_BOOT, *_POSTERIOR))
def bayesian_ab(spark, sf):
    return champion.bayesian_ab(_hashed(spark, sf))


_KS_BOTH = ("ks_both AS (SELECT a AS raw_a, b AS raw_b, b > a AS challenger_wins FROM (SELECT (SELECT max(tpr - fpr) FROM champ) AS a, "
            "(SELECT max(tpr - fpr) FROM chall) AS b))")
_VERDICT = ("CASE WHEN significant AND prob_challenger_wins > 0.8 AND challenger_wins THEN 'DEPLOY CHALLENGER' "
            "ELSE 'RETAIN CHAMPION' END AS decision")
_EVERYTHING = (*_BOOT, _SIDES, _TESTED, *_POSTERIOR, _CHAMP, _CHALL, _KS_BOTH)


@query("decide", S.sql("oot", f"SELECT significant, prob_challenger_wins, challenger_wins, {_VERDICT} FROM "
                       f"(SELECT {_TEST_OUT} FROM tested), posterior, ks_both", *_EVERYTHING))
def decide(spark, sf):
    loans = R.stored_oot(spark, sf)
    replicates = _replicates(loans)
    return champion.decide(champion.ztest_auc(bootstrap.summarize_replicates(replicates)),
                           champion.bayesian_ab(replicates), ranking.compare_ks(loans, digits=models.PD_DIGITS))


_AUC_OUT = ", ".join(f"{re(f'{m}.{v}', 6)} AS {m}_auc_{v}" for m in evaluation.MODELS for v in ("mean", "std", "lower", "upper"))
_RECORD = (f"SELECT *, {re('(chall_approval_rate - champ_approval_rate)', 4)} AS approval_rate_diff, "
           "significant AS rationale_significant, prob_challenger_wins > 0.8 AS rationale_likely_win, "
           f"el_reduction > 0 AS rationale_less_loss, {_VERDICT} FROM (SELECT {_AUC_OUT}, "
           + ", ".join(f"{re(f'(2 * {m}.mean - 1)', 6)} AS {m}_gini" for m in evaluation.MODELS)
           + ", CASE WHEN challenger.mean > champion.mean THEN 'challenger' ELSE 'champion' END AS auc_winner, "
           "CASE WHEN challenger_wins THEN 'challenger' ELSE 'champion' END AS ks_winner, "
           f"{_TEST_OUT}, posterior.*, {re('raw_a', 4)} AS champion_ks, {re('raw_b', 4)} AS challenger_ks, "
           f"{re('(raw_b - raw_a)', 4)} AS ks_diff, challenger_wins, {_IMPACT_OUT} "
           "FROM summary champion, summary challenger, tested, posterior, ks_both, impact "
           "WHERE champion.model = 'champion' AND challenger.model = 'challenger')")


@query("decision_record", S.sql("oot", _RECORD, *_EVERYTHING, _IMPACT))
def decision_record(spark, sf):
    record = evaluation.compare_models(R.stored_oot(spark, sf), REPLICATES, hashed=True)
    names = [n for n in record.columns if "_auc_" in n or n.endswith("_gini")]
    return R.rounded(R.rounded(record, 6, *names), 4, "approval_rate_diff")


# --------------------------------------------------------------------- models
def _split_metrics(spark, sf, fit, names):
    ready = materialize(W.model_input(*R.with_woe(spark, sf)))
    model = fit(ready.where(c("split") == "train"))
    result = models.score_with(model, ready.where(c("split") != "train"), names, "prob")
    table = ranking.threshold_table(result, ["split"], digits=models.PD_DIGITS)
    return ranking.model_metrics(table, ["split"])


# At the fitted weights the predicted and the observed defaults agree, in all and weighted by every input.
_BALANCED = "CASE WHEN is_bad = 1 THEN 0.5e0 / rate ELSE 0.5e0 / (1 - rate) END"
_MOMENTS = "SELECT feature, v AS observed, v AS predicted FROM (" + " UNION ALL ".join(
    f"SELECT '{f}' AS feature, {re(f'(sum(w * is_bad * {x}) / sum(w))', 8)} AS v FROM weighted_loans"
    for f, x in [("intercept", "1e0"), *[(f, f"coalesce({f}, 0e0)") for f in V.WOE_FEATURES]]) + ")"


@query("fit_scorecard", S.sql(
    "encoded", _MOMENTS, f"weighted_loans AS (SELECT *, {_BALANCED} AS w FROM encoded, "
    "(SELECT avg(is_bad) AS rate FROM encoded WHERE split = 'train') WHERE split = 'train')"))
def fit_scorecard(spark, sf):
    train = materialize(W.model_input(*R.with_woe(spark, sf)).where(c("split") == "train"))
    return R.rounded(models.score_equations(train, models.fit_scorecard(train)), 8, "observed", "predicted")


@query("scorecard_points")
def scorecard_points(spark, sf):
    train = materialize(W.model_input(*R.with_woe(spark, sf)).where(c("split") == "train"))
    coefficients, _ = models.coefficients_of(models.fit_scorecard(train))
    return models.scorecard_points(train, coefficients)


@query("fit_forest")
def fit_forest(spark, sf):
    return _split_metrics(spark, sf, models.fit_forest, V.RAW_FEATURES)


@query("fit_boosted")
def fit_boosted(spark, sf):
    return _split_metrics(spark, sf, models.fit_boosted, V.RAW_FEATURES)
