"""The same stages in SQL, written for DuckDB and independent of the operators."""

from __future__ import annotations

import math

from checks import loan_view as L
from riskloom import fixed_values as V

FACTOR = 20 / math.log(2)
OFFSET = 600 - FACTOR * math.log(50)


def dr(x: str, digits: int) -> str:
    scale = f"1e{digits}"
    return f"(sign({x}) * floor(abs({x}) * {scale} + 0.5e0) / {scale})"


def case_bands(x: str, edges: list, labels: list[str]) -> str:
    """Left-closed bands written from the top: NULL compares false and is last."""
    parts = " ".join(f"WHEN {x} < {e} THEN '{b}'" for e, b in zip(edges, labels))
    return f"(CASE {parts} ELSE '{labels[-1]}' END)"


def case_cut(x: str, edges: list, labels: list) -> str:
    quote = (lambda v: str(v)) if isinstance(labels[0], int) else (lambda v: f"'{v}'")
    parts = " ".join(f"WHEN {x} > {lo} AND {x} <= {hi} THEN {quote(b)}"
                     for lo, hi, b in zip(edges, edges[1:], labels))
    return f"(CASE {parts} END)"


def words(items: list[str]) -> str:
    return "(" + ", ".join(f"'{w}'" for w in items) + ")"


STATUS_BAD, STATUS_GOOD = words(V.BAD_STATUSES), words(V.GOOD_STATUSES)
IS_BAD = (f"(CASE WHEN loan_status IN {STATUS_BAD} THEN 1 "
          f"WHEN loan_status IN {STATUS_GOOD} THEN 0 END)")
EMP_YEARS = ("(CASE emp_length WHEN '10+ years' THEN 10 WHEN '< 1 year' THEN 0 "
             "ELSE TRY_CAST(split_part(emp_length, ' ', 1) AS INTEGER) END)")
PERCENT = "CAST(replace({0}, '%', '') AS FLOAT)"
FICO_MID = dr("((fico_range_low + fico_range_high) / 2e0)", 0)

# ------------------------------------------------------------------ stages
RAW = f"""loans_raw AS (SELECT {L.duck_select(L.LOAN_COLUMNS)}
  FROM orders JOIN customer ON o_custkey = c_custkey)"""
FULL = f"""loans_full AS (SELECT {L.duck_select({**L.LOAN_COLUMNS, **L.LATER_COLUMNS})}
  FROM orders JOIN customer ON o_custkey = c_custkey)"""
STAGED = f"""staged AS (SELECT id, loan_amnt, funded_amnt,
  CAST(trim(split_part(trim(term), ' ', 1)) AS INTEGER) AS term_months,
  {PERCENT.format('int_rate')} AS int_rate, installment, grade, sub_grade,
  {EMP_YEARS} AS emp_length_yrs, home_ownership, annual_inc, verification_status, purpose,
  addr_state, dti, delinq_2yrs, fico_range_low, fico_range_high, {FICO_MID} AS fico_avg,
  inq_last_6mths, open_acc, pub_rec, revol_bal, {PERCENT.format('revol_util')} AS revol_util,
  total_acc, collections_12_mths_ex_med, acc_now_delinq, tot_coll_amt, tot_cur_bal,
  strptime(issue_d, '%b-%Y') AS issue_date,
  year(strptime(issue_d, '%b-%Y')) AS vintage_year,
  quarter(strptime(issue_d, '%b-%Y')) AS vintage_quarter,
  application_type, loan_status, {IS_BAD} AS is_bad
  FROM loans_raw WHERE loan_status IN {STATUS_BAD} OR loan_status IN {STATUS_GOOD})"""
VALID = ("annual_inc > 0 AND loan_amnt > 0 AND dti IS NOT NULL "
         "AND fico_avg >= 580 AND fico_avg <= 850")
CLEAN_RULES = {
    "int_rate": "round(int_rate, 2)",
    "emp_length_yrs": "coalesce(emp_length_yrs, 5)",
    "annual_inc": "least(annual_inc, 300000)",
    "dti": "(CASE WHEN dti BETWEEN 0 AND 60 THEN round(dti, 2) END)",
    "revol_util": "least(coalesce(CAST(revol_util AS DOUBLE), 51.77e0), 100e0)",
    "collections_12_mths_ex_med": "coalesce(collections_12_mths_ex_med, 0)",
    "acc_now_delinq": "coalesce(acc_now_delinq, 0)",
    "tot_coll_amt": "coalesce(tot_coll_amt, 0)",
    "tot_cur_bal": "coalesce(tot_cur_bal, 0)",
}
CLEAN_COLUMNS = [
    "id", "is_bad", "vintage_year", "vintage_quarter", "issue_date", "grade", "sub_grade",
    "loan_amnt", "term_months", "int_rate", "installment", "emp_length_yrs", "home_ownership",
    "annual_inc", "verification_status", "purpose", "application_type", "dti", "delinq_2yrs",
    "fico_avg", "inq_last_6mths", "open_acc", "pub_rec", "revol_util", "total_acc",
    "collections_12_mths_ex_med", "acc_now_delinq", "revol_bal", "tot_coll_amt", "tot_cur_bal",
]
CLEAN = ("clean AS (SELECT "
         + ", ".join(f"{CLEAN_RULES[c]} AS {c}" if c in CLEAN_RULES else c for c in CLEAN_COLUMNS)
         + f" FROM staged WHERE {VALID})")
RATIOS = {
    "installment_to_income": ("installment", "(annual_inc / 12e0)"),
    "loan_to_income": ("loan_amnt", "annual_inc"),
    "revol_bal_to_income": ("revol_bal", "annual_inc"),
    "open_to_total_acc_ratio": ("open_acc", "total_acc"),
}


def ratio(a: str, b: str) -> str:
    return dr(f"(CAST({a} AS DOUBLE) / nullif({b}, 0))", 4)


DEROGATORY = ("(CASE WHEN coalesce(pub_rec, 0) > 0 OR coalesce(delinq_2yrs, 0) > 0 "
              "OR coalesce(collections_12_mths_ex_med, 0) > 0 THEN 1 ELSE 0 END)")
BANDS = {
    "fico_band": case_bands("fico_avg", *V.FICO_BANDS),
    "dti_band": case_bands("dti", *V.DTI_BANDS),
    "loan_amnt_band": case_bands("loan_amnt", *V.LOAN_AMNT_BANDS),
    "emp_stability": case_bands("emp_length_yrs", *V.EMP_BANDS),
    "int_rate_band": case_bands("int_rate", *V.INT_RATE_BANDS),
}
VINTAGE = "(vintage_year || '-Q' || vintage_quarter)"
SPLIT = (f"(CASE WHEN vintage_year > {L.VALIDATION} THEN 'oot' "
         f"WHEN vintage_year = {L.VALIDATION} THEN 'validation' ELSE 'train' END)")
FEATURES = ("features AS (SELECT *, "
            + ", ".join(f"{ratio(a, b)} AS {n}" for n, (a, b) in RATIOS.items())
            + f", {DEROGATORY} AS has_derogatory, "
            + ", ".join(f"{text} AS {n}" for n, text in BANDS.items())
            + f", {VINTAGE} AS vintage, {SPLIT} AS split FROM clean)")


def bins_sql(source: str = "features WHERE split = 'train'") -> str:
    return " UNION ALL ".join(
        f"SELECT '{f}' AS feature, {f} AS bin, count(*) AS total, CAST(sum(is_bad) AS BIGINT) AS events, "
        f"CAST(count(*) - sum(is_bad) AS BIGINT) AS non_events FROM {source} GROUP BY {f}"
        for f in V.BINNED_FEATURES)


BINS = f"bins AS ({bins_sql()})"
SHARES = """shares AS (SELECT b.*, events / e AS dist_events, non_events / g AS dist_non_events FROM bins b,
  (SELECT CAST(sum(is_bad) AS DOUBLE) AS e, CAST(count(*) - sum(is_bad) AS DOUBLE) AS g
   FROM features WHERE split = 'train'))"""
WEIGHTS = f"""weights AS (SELECT *, CASE WHEN events = 0 OR non_events = 0 THEN 0e0
  ELSE {dr('ln(dist_events / dist_non_events)', 4)} END AS woe FROM shares)"""
WOE = f"""woe AS (SELECT feature, bin, total, events, non_events,
  {dr('(events * 100e0 / total)', 2)} AS bad_rate_pct, dist_events, dist_non_events, woe,
  {dr('((dist_events - dist_non_events) * woe)', 6)} AS iv_component FROM weights)"""


def woe_of(feature: str, value: str) -> str:
    return f"(SELECT w.woe FROM woe w WHERE w.feature = '{feature}' AND w.bin = {value})"


ENCODED = ("encoded AS (SELECT f.*, "
           + ", ".join(f"{woe_of(f, 'f.' + f)} AS {f}_woe" for f in V.BINNED_FEATURES)
           + " FROM features f)")
MODEL_INPUT_COLUMNS = ["id", "is_bad", "split", "vintage_year", "vintage",
                       *V.RAW_FEATURES, *V.WOE_FEATURES]


def logistic(coefficients: dict[str, float], intercept: float) -> str:
    terms = "".join(f" + CAST('{w!r}' AS DOUBLE) * coalesce(CAST({c} AS DOUBLE), 0e0)" for c, w in coefficients.items())
    return f"(1e0 / (1e0 + exp(-(({intercept!r}e0){terms}))))"


CHAMPION_PD = logistic(L.CHAMPION_COEFFICIENTS, L.CHAMPION_INTERCEPT)
CHALLENGER_PD = logistic(L.CHALLENGER_COEFFICIENTS, L.CHALLENGER_INTERCEPT)
SCORED = f"""scored AS (SELECT id, is_bad, split, loan_amnt, round_even({CHAMPION_PD}, 6) AS champ_pd,
  round_even({CHALLENGER_PD}, 6) AS chall_pd FROM encoded)"""
OOT = "oot AS (SELECT * FROM scored WHERE split = 'oot')"

SPREAD_PD = (f"(1e0 / (1e0 + exp((400e0 + 420e0 * (((id * 7919) % 9973 + 1) / 9974e0)"
             f" - {{shift}} - ({OFFSET!r}e0)) / {FACTOR!r}e0)))")
SPREAD = f"""spread AS (SELECT id, is_bad, {SPREAD_PD.format(shift='0e0')} AS pd,
  {SPREAD_PD.format(shift='15e0')} AS pd_later FROM staged)"""

ORDER = [("loans_raw", RAW), ("staged", STAGED), ("clean", CLEAN), ("features", FEATURES),
         ("bins", BINS), ("shares", SHARES), ("weights", WEIGHTS), ("woe", WOE),
         ("encoded", ENCODED), ("scored", SCORED), ("oot", OOT)]


def sql(last: str, body: str, *extra: str) -> str:
    """``body`` over all stages up to ``last``, with further named stages."""
    stages = []
    for name, text in ORDER:
        stages.append(text)
        if name == last:
            break
    # Correlated lookups need the small table computed once.
    parts = [t.replace("woe AS (", "woe AS MATERIALIZED (", 1) if t is WOE else t for t in stages]
    return "WITH " + ", ".join([*parts, *extra]) + " " + body


def odds_score(pd: str) -> str:
    return (f"least(greatest({OFFSET!r}e0 + {FACTOR!r}e0 * ln(greatest((1e0 - {pd}) / {pd}, 1e-10)),"
            " 300e0), 850e0)")


def minmax_raw(pd: str) -> str:
    return f"(850e0 - ({pd} - 0.09e0) / (0.9e0 - 0.09e0) * 550e0)"


def minmax_score(pd: str) -> str:
    return f"CAST(least(greatest(round_even({minmax_raw(pd)}, 0), 300), 850) AS INTEGER)"


def tier_case(score: str, part: int) -> str:
    parts = " ".join(f"WHEN {score} >= {row[0]} THEN '{row[part]}'" for row in V.RISK_TIERS[:-1])
    return f"(CASE {parts} ELSE '{V.RISK_TIERS[-1][part]}' END)"
