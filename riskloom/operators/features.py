"""Ratios, flags, bands and the split of each loan."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from riskloom import fixed_values as V
from riskloom.functions import bands as B
from riskloom.functions.cleaning import derogatory_flag
from riskloom.functions.numeric import safe_ratio
from riskloom.functions.parsing import vintage_label


def add_ratios(df: DataFrame) -> DataFrame:
    c = F.col
    return df.withColumns({
        "installment_to_income": safe_ratio(c("installment"), c("annual_inc") / 12),
        "loan_to_income": safe_ratio(c("loan_amnt"), c("annual_inc")),
        "revol_bal_to_income": safe_ratio(c("revol_bal"), c("annual_inc")),
        "open_to_total_acc_ratio": safe_ratio(c("open_acc"), c("total_acc")),
    })


def add_bands(df: DataFrame) -> DataFrame:
    c = F.col
    return df.withColumns({
        "fico_band": B.band_fico(c("fico_avg")),
        "dti_band": B.band_dti(c("dti")),
        "loan_amnt_band": B.band_loan_amnt(c("loan_amnt")),
        "emp_stability": B.band_emp(c("emp_length_yrs")),
        "int_rate_band": B.band_int_rate(c("int_rate")),
    })


def derive_features(clean: DataFrame, train_last: int = V.TRAIN_LAST_YEAR,
                    validation: int = V.VALIDATION_YEAR) -> DataFrame:
    """The clean columns with eleven derived ones and the split, one narrow pass."""
    c = F.col
    flagged = add_ratios(clean).withColumn(
        "has_derogatory",
        derogatory_flag(c("pub_rec"), c("delinq_2yrs"), c("collections_12_mths_ex_med")))
    return add_bands(flagged).withColumns({
        "vintage": vintage_label(c("vintage_year"), c("vintage_quarter")),
        "split": B.split_flag(c("vintage_year"), train_last, validation),
    })
