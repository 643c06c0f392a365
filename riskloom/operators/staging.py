"""Raw loans to typed and labelled loans."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from riskloom.functions import parsing as P


def filter_decided(loans: DataFrame) -> DataFrame:
    """Loans with a final outcome."""
    return loans.where(P.is_decided(F.col("loan_status")))


def stage_loans(raw: DataFrame) -> DataFrame:
    """Thirty-five typed columns of the decided loans, one narrow pass."""
    c = F.col
    issued = c("issue_date")
    dated = filter_decided(raw).withColumn("issue_date", P.parse_issue_month(c("issue_d")))
    return dated.select(
        "id", "loan_amnt", "funded_amnt",
        P.parse_term(c("term")).alias("term_months"),
        P.parse_percent(c("int_rate")).alias("int_rate"),
        "installment", "grade", "sub_grade",
        P.emp_length_years(c("emp_length")).alias("emp_length_yrs"),
        "home_ownership", "annual_inc", "verification_status", "purpose",
        "addr_state", "dti", "delinq_2yrs", "fico_range_low", "fico_range_high",
        P.fico_midpoint(c("fico_range_low"), c("fico_range_high")).alias("fico_avg"),
        "inq_last_6mths", "open_acc", "pub_rec", "revol_bal",
        P.parse_percent(c("revol_util")).alias("revol_util"),
        "total_acc", "collections_12_mths_ex_med", "acc_now_delinq",
        "tot_coll_amt", "tot_cur_bal",
        issued,
        P.vintage_year(issued).alias("vintage_year"),
        P.vintage_quarter(issued).alias("vintage_quarter"),
        "application_type", "loan_status",
        P.label_default(c("loan_status")).alias("is_bad"),
    )
