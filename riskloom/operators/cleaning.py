"""Staged loans to valid loans with capped and imputed columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from riskloom import fixed_values as V
from riskloom.functions.cleaning import cap, impute, null_out_of_range, round_rate


def filter_valid(staged: DataFrame) -> DataFrame:
    """Rows fit for modelling, judged on the values before any capping.

    A ``dti`` above its range passes here and turns NULL in cleaning.
    """
    return staged.where(
        (F.col("annual_inc") > 0) & (F.col("loan_amnt") > 0)
        & F.col("dti").isNotNull() & F.col("fico_avg").between(*V.FICO_RANGE))


def drop_leakage(df: DataFrame) -> DataFrame:
    return df.drop(*V.LEAKAGE_COLUMNS)


def impute_constants(df: DataFrame) -> DataFrame:
    return df.withColumns({name: impute(name) for name in V.IMPUTED_VALUES
                           if name in df.columns})


def cap_upper(df: DataFrame) -> DataFrame:
    return df.withColumns({name: cap(F.col(name), name) for name in V.UPPER_CAPS
                           if name in df.columns})


def clean_loans(staged: DataFrame) -> DataFrame:
    """Thirty columns of the valid loans, one narrow pass."""
    rules = {
        "int_rate": round_rate(F.col("int_rate")),
        "dti": null_out_of_range(F.col("dti"), *V.DTI_RANGE),
        "annual_inc": cap(F.col("annual_inc"), "annual_inc"),
        "revol_util": cap(impute("revol_util"), "revol_util"),
    }
    for name in V.IMPUTED_VALUES:
        rules.setdefault(name, impute(name))
    kept = [
        "id", "is_bad", "vintage_year", "vintage_quarter", "issue_date", "grade",
        "sub_grade", "loan_amnt", "term_months", "int_rate", "installment",
        "emp_length_yrs", "home_ownership", "annual_inc", "verification_status",
        "purpose", "application_type", "dti", "delinq_2yrs", "fico_avg",
        "inq_last_6mths", "open_acc", "pub_rec", "revol_util", "total_acc",
        "collections_12_mths_ex_med", "acc_now_delinq", "revol_bal",
        "tot_coll_amt", "tot_cur_bal",
    ]
    return filter_valid(staged).select(
        *[rules[name].alias(name) if name in rules else F.col(name) for name in kept])


def fill_missing(df: DataFrame, columns: list[str], value: float = 0) -> DataFrame:
    """NULL to ``value`` in the model inputs."""
    return df.fillna(value, subset=columns)
