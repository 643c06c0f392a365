"""Queries over sources, staging, cleaning, features and column functions."""

from __future__ import annotations

from pyspark.sql import Observation, functions as F

from checks import loan_sql as S, loan_view as L, registry as R
from checks.registry import query
from riskloom import fixed_values as V
from riskloom.functions import bands as B, cleaning as C, parsing as P
from riskloom.operators import (applications as A, cleaning, distributions, features, portfolio,
                                profile, staging, woe as W)
from riskloom.sources import csv, layers
from riskloom.sources.storage import scratch_path

c = F.col

# ------------------------------------------------------------- 2.1 sources
_TEXT = set(V.ACCEPTED_TEXT_COLUMNS) | {"id"}
_ACCEPTED = ", ".join(n if n in _TEXT else f"CAST({n} AS DOUBLE) AS {n}" for n in V.ACCEPTED_COLUMNS)


@query("read_accepted", f"WITH {S.FULL} SELECT {_ACCEPTED} FROM loans_full")
def read_accepted(spark, sf):
    path = scratch_path(spark, "accepted-csv")
    L.write_loan_files(spark, sf, path)
    return csv.read_accepted(spark, path)


def _broken(kind: str, reason: str) -> str:
    condition, text = L.broken_lines(L.DUCK_WORDS, kind)
    return f"SELECT '{reason}' AS reason, {text} AS record FROM orders WHERE {condition}"


@query("malformed_records", f"{_broken('cut', 'number of fields')} UNION ALL {_broken('ill_typed', 'type')}")
def malformed_records(spark, sf):
    path = scratch_path(spark, "accepted-csv")
    L.write_loan_files(spark, sf, path)
    return csv.malformed_records(spark, path, csv.accepted_types())


@query("count_malformed", f"WITH {S.FULL} SELECT (SELECT count(*) FROM loans_full) + n_cut + n_ill_typed AS n_records, n_cut, n_ill_typed "
       "FROM (SELECT " + ", ".join(f"count(*) FILTER ({L.BROKEN[k][0]}) AS n_{k}" for k in L.BROKEN) + " FROM orders)")
def count_malformed(spark, sf):
    """What a reader counts while its rows are being written."""
    path, out = (scratch_path(spark, name) for name in ("accepted-csv", "accepted"))
    L.write_loan_files(spark, sf, path)
    seen = Observation()
    csv.read_accepted(spark, path, seen).write.parquet(out)
    return spark.createDataFrame([seen.get], "n_records bigint, n_cut bigint, n_ill_typed bigint")


@query("read_rejected", "WITH r AS (SELECT " + L.duck_select(L.REJECTED_VIEW) + " FROM orders) SELECT "
       + ", ".join(f'"{a}" AS {b}' for a, b in V.REJECTED_COLUMNS.items())
       + ' FROM r WHERE "Amount Requested" IS NOT NULL')
def read_rejected(spark, sf):
    path = scratch_path(spark, "rejected-csv")
    L.write_rejected_files(spark, sf, path)
    return csv.read_rejected(spark, path)


@query("create_layers", S.sql("staged", "SELECT grade, is_bad, count(*) AS n FROM staged GROUP BY ALL"))
def create_layers(spark, sf):
    root = scratch_path(spark, "layers")
    names = tuple(f"{layer}_{root[-12:]}" for layer in layers.LAYERS)
    for _ in range(2):   # a second time changes nothing
        layers.create_layers(spark, names, root)
    stored = layers.write_layer(R.staged(spark, sf), f"{names[1]}.loans")
    return stored.groupBy("grade", "is_bad").agg(F.count("*").alias("n"))


@query("write_layer", S.sql("features", "SELECT split, grade, count(*) AS n FROM features GROUP BY ALL"))
def write_layer(spark, sf):
    path = scratch_path(spark, "features")
    stored = layers.write_layer(R.derived(spark, sf), path, "split")
    return stored.groupBy("split", "grade").agg(F.count("*").alias("n"))


@query("read_split", S.sql("encoded", "SELECT id, loan_amnt, grade_woe, is_bad FROM encoded WHERE split = 'oot'"))
def read_split(spark, sf):
    path = scratch_path(spark, "model-input")
    layers.write_layer(W.model_input(*R.with_woe(spark, sf)), path, "split")
    return layers.read_split(spark, path, "oot", ["id", "loan_amnt", "grade_woe", "is_bad", "loan_amnt"])


@query("sample_split", S.sql("features", "SELECT id, is_bad, fico_avg FROM features WHERE split = 'validation' "
                             "ORDER BY md5(CAST(id AS VARCHAR)), id LIMIT 1000"))
def sample_split(spark, sf):
    return layers.sample_split(R.derived(spark, sf), 1000, "validation").select("id", "is_bad", "fico_avg")


@query("register_view", S.sql("staged", "SELECT purpose, count(*) AS n FROM staged GROUP BY purpose"))
def register_view(spark, sf):
    layers.register_view(R.staged(spark, sf), "staged_loans")
    found = spark.sql("SELECT purpose, count(*) AS n FROM staged_loans GROUP BY purpose")
    spark.catalog.dropTempView("staged_loans")   # resolved above; a session's list of tables stays as it was
    return found


def _profile_sql() -> str:
    one = [f"SELECT '{n}' AS \"column\", CAST({n} AS DOUBLE) AS v FROM staged" for n in V.PROFILE_COLUMNS]
    q = {f"p{p}": f"quantile_cont(v, {p / 100})" for p in (25, 50, 75)}
    return ("SELECT \"column\", count(*) AS total_rows, count(*) - count(v) AS null_count, "
            + "round_even((count(*) - count(v)) * 100e0 / count(*), 2) AS null_pct, "
            "count(DISTINCT v) AS distinct_count, " + S.dr("avg(v)", 4) + " AS mean, "
            + S.dr("stddev_samp(v)", 4) + " AS std_dev, " + S.dr("min(v)", 4) + " AS min, "
            + S.dr("max(v)", 4) + " AS max, "
            + ", ".join(f"{S.dr(e, 4)} AS {n}" for n, e in q.items())
            + " FROM (" + " UNION ALL ".join(one) + ") GROUP BY 1")


_PROFILE = _profile_sql()


@query("profile_columns", S.sql("staged", _PROFILE))
def profile_columns(spark, sf):
    return profile.profile_columns(R.staged(spark, sf))


@query("profile_by_split")
def profile_by_split(spark, sf):
    """Sketches of each split, merged."""
    return profile.merged_profile(profile.profile_parts(R.derived(spark, sf), ["split"], _FEATURE_NUMBERS))


_FEATURE_NUMBERS = [n for n in V.PROFILE_COLUMNS if n in S.CLEAN_COLUMNS]
_MERGED = " UNION ALL ".join(
    f"SELECT '{n}' AS \"column\", count(*) AS total_rows, count(*) - count(v) AS null_count, {S.dr('avg(v)', 4)} AS mean, "
    f"{S.dr('stddev_samp(v)', 4)} AS std_dev, {S.dr('min(v)', 4)} AS min, {S.dr('max(v)', 4)} AS max, count(DISTINCT v) > 0 AS distinct_close, "
    f"count(v) > 0 AS quartiles_close FROM (SELECT CAST({n} AS DOUBLE) AS v FROM features)" for n in _FEATURE_NUMBERS)


@query("merged_profile", S.sql("features", _MERGED))
def merged_profile(spark, sf):
    """The merged sketches, held against exact distinct counts and the true ranks of their quartiles."""
    made = R.derived(spark, sf)
    merged = profile.merged_profile(profile.profile_parts(made, ["split"], _FEATURE_NUMBERS))
    long = profile.unpivot_numeric(made, _FEATURE_NUMBERS).where("value is not null")
    ranks = [(F.avg((c("value") < c(q)).cast("int")) <= p + 0.01) & (F.avg((c("value") <= c(q)).cast("int")) >= p - 0.01)
             for q, p in profile.QUARTILES.items()]
    truth = long.join(F.broadcast(merged), "column").groupBy("column").agg(
        (F.abs(F.count_distinct("value") - F.max("distinct_count")) <= 0.04 * F.count_distinct("value")).alias("distinct_close"),
        (ranks[0] & ranks[1] & ranks[2]).alias("quartiles_close"))
    return merged.join(truth, "column").select(
        "column", "total_rows", "null_count", "mean", "std_dev", "min", "max", "distinct_close", "quartiles_close")


@query("write_csv_report", S.sql("staged", _PROFILE))
def write_csv_report(spark, sf):
    path = scratch_path(spark, "profile-csv")
    csv.write_csv_report(profile.profile_columns(R.staged(spark, sf)), path)
    schema = ("column string, total_rows long, null_count long, null_pct double, distinct_count long, "
              "mean double, std_dev double, min double, max double, p25 double, p50 double, p75 double")
    return spark.read.schema(schema).option("header", True).csv(path)


@query("top_null_columns", S.sql("staged", f"SELECT * FROM ({_PROFILE}) ORDER BY null_pct DESC, \"column\" LIMIT 10"))
def top_null_columns(spark, sf):
    return profile.top_null_columns(profile.profile_columns(R.staged(spark, sf)))


@query("layer_summary", S.sql("features", " UNION ALL ".join(
    f"SELECT '{n}' AS layer, count(*) AS n_rows, {S.dr('avg(is_bad)', 4)} AS bad_rate FROM {n}"
    for n in ("staged", "clean", "features"))))
def layer_summary(spark, sf):
    made = {"staged": R.staged, "clean": R.clean, "features": R.derived}
    parts = [profile.layer_summary(make(spark, sf)).select(F.lit(n).alias("layer"), "n_rows", "bad_rate")
             for n, make in made.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


_STAGED_TYPES = {
    "id": "bigint", "loan_amnt": "double", "funded_amnt": "double", "term_months": "int", "int_rate": "float",
    "installment": "double", "grade": "string", "sub_grade": "string", "emp_length_yrs": "int",
    "home_ownership": "string", "annual_inc": "double", "verification_status": "string", "purpose": "string",
    "addr_state": "string", "dti": "double", "delinq_2yrs": "bigint", "fico_range_low": "bigint",
    "fico_range_high": "bigint", "fico_avg": "double", "inq_last_6mths": "bigint", "open_acc": "bigint",
    "pub_rec": "int", "revol_bal": "bigint", "revol_util": "float", "total_acc": "bigint",
    "collections_12_mths_ex_med": "int", "acc_now_delinq": "int", "tot_coll_amt": "bigint", "tot_cur_bal": "bigint",
    "issue_date": "timestamp_ntz", "vintage_year": "bigint", "vintage_quarter": "bigint",
    "application_type": "string", "loan_status": "string", "is_bad": "int",
}


@query("describe_layer", S.sql("staged", "SELECT CAST(n AS INTEGER) AS position, name AS \"column\", dtype, s.* FROM (SELECT "
       f"unnest({list(_STAGED_TYPES)}) AS name, unnest({list(_STAGED_TYPES.values())}) AS dtype, unnest(range(1, 36)) AS n), "
       f"(SELECT count(*) AS n_rows, CAST(35 AS INTEGER) AS n_columns, {S.dr('avg(is_bad)', 4)} AS bad_rate "
       "FROM staged) s"))
def describe_layer(spark, sf):
    return profile.describe_layer(R.staged(spark, sf))


# ------------------------------------------- 2.2 projections and predicates
_STAGED_COLUMNS = "SELECT * FROM staged"


@query("stage_loans", S.sql("staged", _STAGED_COLUMNS))
def stage_loans(spark, sf):
    return R.staged(spark, sf)


@query("filter_decided", S.sql("loans_raw", "SELECT id, loan_status FROM loans_raw WHERE "
                               f"{S.IS_BAD} IS NOT NULL"))
def filter_decided(spark, sf):
    return staging.filter_decided(R.raw(spark, sf)).select("id", "loan_status")


@query("clean_loans", S.sql("clean", "SELECT * FROM clean"))
def clean_loans(spark, sf):
    return R.clean(spark, sf)


@query("filter_valid", S.sql("staged", f"SELECT id, annual_inc, dti, fico_avg FROM staged WHERE {S.VALID}"))
def filter_valid(spark, sf):
    return cleaning.filter_valid(R.staged(spark, sf)).select("id", "annual_inc", "dti", "fico_avg")


@query("drop_leakage", f"WITH {S.FULL} SELECT * EXCLUDE ({', '.join(V.LEAKAGE_COLUMNS)}) FROM loans_full")
def drop_leakage(spark, sf):
    return cleaning.drop_leakage(L.loans_full(spark, sf))


@query("filter_split", S.sql("features", "SELECT id, split, vintage FROM features WHERE split = 'validation'"))
def filter_split(spark, sf):
    return layers.filter_split(R.derived(spark, sf), "validation").select("id", "split", "vintage")


@query("fill_missing", S.sql("features", "SELECT id, coalesce(dti, 0) AS dti, coalesce(open_to_total_acc_ratio, 0) "
                             "AS open_to_total_acc_ratio FROM features"))
def fill_missing(spark, sf):
    names = ["dti", "open_to_total_acc_ratio"]
    return cleaning.fill_missing(R.derived(spark, sf), names).select("id", *names)


_GROUPS = "SELECT addr_state, count(*) AS total FROM staged GROUP BY addr_state"


@query("filter_small_groups", S.sql("staged", f"SELECT * FROM ({_GROUPS}) WHERE total > 500"))
def filter_small_groups(spark, sf):
    groups = R.staged(spark, sf).groupBy("addr_state").agg(F.count("*").alias("total"))
    return portfolio.filter_small_groups(groups)


# -------------------------------------------------------- 2.3 column functions
@query("parse_term", S.sql("loans_raw", "SELECT id, CASE WHEN term LIKE '%60%' THEN 60 ELSE 36 END AS term_months FROM loans_raw"))
def parse_term(spark, sf):
    return R.raw(spark, sf).select("id", P.parse_term(c("term")).alias("term_months"))


@query("parse_percent", S.sql("loans_raw", f"SELECT id, {S.PERCENT.format('int_rate')} AS int_rate, "
                              f"{S.PERCENT.format('revol_util')} AS revol_util FROM loans_raw"))
def parse_percent(spark, sf):
    return R.raw(spark, sf).select("id", *[P.parse_percent(c(n)).alias(n) for n in ("int_rate", "revol_util")])


@query("emp_length_years", S.sql("loans_raw", f"SELECT id, {S.EMP_YEARS} AS emp_length_yrs FROM loans_raw"))
def emp_length_years(spark, sf):
    return R.raw(spark, sf).select("id", P.emp_length_years(c("emp_length")).alias("emp_length_yrs"))


@query("fico_midpoint", S.sql("loans_raw", f"SELECT id, {S.FICO_MID} AS fico_avg FROM loans_raw"))
def fico_midpoint(spark, sf):
    return R.raw(spark, sf).select(
        "id", P.fico_midpoint(c("fico_range_low"), c("fico_range_high")).alias("fico_avg"))


_MONTH = "strptime(issue_d, '%b-%Y')"


@query("parse_issue_month", S.sql("loans_raw", f"SELECT id, {_MONTH} AS issue_date FROM loans_raw"))
def parse_issue_month(spark, sf):
    return R.raw(spark, sf).select("id", P.parse_issue_month(c("issue_d")).alias("issue_date"))


@query("vintage_parts", S.sql("loans_raw", f"SELECT id, year({_MONTH}) AS vintage_year, "
                              f"quarter({_MONTH}) AS vintage_quarter FROM loans_raw"))
def vintage_parts(spark, sf):
    month = P.parse_issue_month(c("issue_d"))
    return R.raw(spark, sf).select("id", P.vintage_year(month).alias("vintage_year"),
                                   P.vintage_quarter(month).alias("vintage_quarter"))


@query("vintage_label", S.sql("staged", f"SELECT id, {S.VINTAGE} AS vintage FROM staged"))
def vintage_label(spark, sf):
    return R.staged(spark, sf).select(
        "id", P.vintage_label(c("vintage_year"), c("vintage_quarter")).alias("vintage"))


@query("label_default", S.sql("loans_raw", f"SELECT id, {S.IS_BAD} AS is_bad FROM loans_raw"))
def label_default(spark, sf):
    return R.raw(spark, sf).select("id", P.label_default(c("loan_status")).alias("is_bad"))


_IMPUTED = list(V.IMPUTED_VALUES)


@query("impute_constants", S.sql("staged", "SELECT id, coalesce(emp_length_yrs, 5) AS emp_length_yrs, "
       "coalesce(CAST(revol_util AS DOUBLE), 51.77e0) AS revol_util, "
       + ", ".join(f"coalesce({n}, 0) AS {n}" for n in _IMPUTED[2:]) + " FROM staged"))
def impute_constants(spark, sf):
    return cleaning.impute_constants(R.staged(spark, sf)).select("id", *_IMPUTED)


@query("cap_upper", S.sql("staged", "SELECT id, least(annual_inc, 300000) AS annual_inc, "
                          "least(coalesce(CAST(revol_util AS DOUBLE), 51.77e0), 100e0) AS revol_util FROM staged"))
def cap_upper(spark, sf):
    return cleaning.cap_upper(cleaning.impute_constants(R.staged(spark, sf))).select(
        "id", "annual_inc", "revol_util")


@query("null_out_of_range", S.sql("staged", f"SELECT id, {S.CLEAN_RULES['dti']} AS dti FROM staged"))
def null_out_of_range(spark, sf):
    return R.staged(spark, sf).select("id", C.null_out_of_range(c("dti"), *V.DTI_RANGE).alias("dti"))


@query("round_rate", S.sql("staged", "SELECT id, round(int_rate, 2) AS int_rate FROM staged"))
def round_rate(spark, sf):
    return R.staged(spark, sf).select("id", C.round_rate(c("int_rate")).alias("int_rate"))


@query("safe_ratio", S.sql("clean", "SELECT id, " + ", ".join(
    f"{S.ratio(a, b)} AS {n}" for n, (a, b) in S.RATIOS.items()) + " FROM clean"))
def safe_ratio(spark, sf):
    return features.add_ratios(R.clean(spark, sf)).select("id", *S.RATIOS)


@query("derogatory_flag", S.sql("staged", f"SELECT id, {S.DEROGATORY} AS has_derogatory FROM staged"))
def derogatory_flag(spark, sf):
    return R.staged(spark, sf).select("id", C.derogatory_flag(
        c("pub_rec"), c("delinq_2yrs"), c("collections_12_mths_ex_med")).alias("has_derogatory"))


def _band_query(name, function, column, spec):
    @query(name, S.sql("staged", f"SELECT id, {S.case_bands(column, *spec)} AS band FROM staged"))
    def run(spark, sf):
        return R.staged(spark, sf).select("id", function(c(column)).alias("band"))


_band_query("band_fico", B.band_fico, "fico_avg", V.FICO_BANDS)
_band_query("band_dti", B.band_dti, "dti", V.DTI_BANDS)
_band_query("band_loan_amnt", B.band_loan_amnt, "loan_amnt", V.LOAN_AMNT_BANDS)
_band_query("band_emp", B.band_emp, "emp_length_yrs", V.EMP_BANDS)
_band_query("band_int_rate", B.band_int_rate, "int_rate", V.INT_RATE_BANDS)


@query("split_flag", S.sql("staged", f"SELECT id, {S.SPLIT} AS split FROM staged"))
def split_flag(spark, sf):
    return R.staged(spark, sf).select("id", B.split_flag(c("vintage_year"), L.TRAIN_LAST, L.VALIDATION).alias("split"))


@query("derive_features", S.sql("features", "SELECT * FROM features"))
def derive_features(spark, sf):
    return R.derived(spark, sf)


@query("cut_right", S.sql("staged", f"SELECT id, {S.case_cut('fico_avg', *V.FICO_CUT)} AS fico_bin FROM staged"))
def cut_right(spark, sf):
    return R.staged(spark, sf).select("id", B.cut_right(c("fico_avg"), *V.FICO_CUT).alias("fico_bin"))


_CAPPED = ["loan_amnt", "annual_inc", "revol_util", "dti"]


@query("winsorize_at", S.sql("staged", "SELECT id, is_bad, \"column\", round_even(least(value, cap), 6) AS value, round_even(cap, 6) AS cap FROM (" + " UNION ALL ".join(
    f"SELECT id, is_bad, '{n}' AS \"column\", CAST({n} AS DOUBLE) AS value, "
    f"(SELECT quantile_cont(CAST({n} AS DOUBLE), 0.99) FROM staged WHERE is_bad = 0) AS cap FROM staged"
    for n in _CAPPED) + ") WHERE value IS NOT NULL"))
def winsorize_at(spark, sf):
    capped = distributions.winsorize_at(R.staged(spark, sf), _CAPPED, ids=["id"])
    return R.rounded(capped, 6, "value", "cap")


@query("normalize_codes", S.sql("clean", "SELECT id, upper(grade) AS grade, upper(home_ownership) AS home_ownership FROM clean"))
def normalize_codes(spark, sf):
    lowered = R.clean(spark, sf).withColumns({n: F.lower(n) for n in ("grade", "home_ownership")})
    return A.normalize_codes(lowered).select("id", "grade", "home_ownership")
