"""Deterministic loans over ``orders`` and ``customer``, for both engines.

``{S}`` stands for the text type and ``{Y}`` for the month text of the order
date; everything else reads the same in Spark SQL and in DuckDB.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

_RATE = "(5 + (o_orderkey * 31) % 27)"
_LETTER = "substr('ABCDEFG', CAST(least(floor(((o_orderkey * 31) % 27) / 4e0), 6) AS INT) + 1, 1)"

LOAN_COLUMNS = {
    "id": "o_orderkey",
    "loan_amnt": "o_totalprice / 12.5e0",
    "funded_amnt": "o_totalprice / 12.5e0",
    "term": "CASE WHEN o_orderkey % 3 = 0 THEN ' 60 months' ELSE ' 36 months' END",
    "int_rate": f"concat(CAST({_RATE} AS {{S}}), '.', "
                "substr('00255075', CAST((o_custkey % 4) * 2 + 1 AS INT), 2), '%')",
    "installment": "o_totalprice / 12.5e0 * 1.15e0 / CASE WHEN o_orderkey % 3 = 0 THEN 60 ELSE 36 END",
    "grade": _LETTER,
    "sub_grade": f"concat({_LETTER}, CAST(o_orderkey % 5 + 1 AS {{S}}))",
    "emp_length": "CASE WHEN o_custkey % 13 = 0 THEN NULL WHEN o_custkey % 13 = 1 THEN '< 1 year' "
                  "WHEN o_custkey % 13 = 2 THEN '1 year' WHEN o_custkey % 13 <= 10 "
                  "THEN concat(CAST(o_custkey % 13 - 1 AS {S}), ' years') ELSE '10+ years' END",
    "home_ownership": "CASE c_nationkey % 4 WHEN 0 THEN 'RENT' WHEN 1 THEN 'OWN' "
                      "WHEN 2 THEN 'MORTGAGE' ELSE 'ANY' END",
    "annual_inc": "(c_acctbal + 1000) * 40",
    "verification_status": "CASE o_custkey % 3 WHEN 0 THEN 'Verified' "
                           "WHEN 1 THEN 'Source Verified' ELSE 'Not Verified' END",
    "issue_d": "{Y}",
    "loan_status": "CASE WHEN o_orderkey % 10 = 0 THEN CASE WHEN o_orderkey % 20 = 0 "
                   "THEN 'Current' ELSE 'In Grace Period' END "
                   f"WHEN (o_orderkey * 7919) % 100 < {_RATE} * 1.2e0 THEN CASE o_orderkey % 4 "
                   "WHEN 0 THEN 'Default' WHEN 1 THEN 'Late (31-120 days)' "
                   "WHEN 2 THEN 'Does not meet the credit policy. Status:Charged Off' "
                   "ELSE 'Charged Off' END WHEN o_orderkey % 40 = 7 "
                   "THEN 'Does not meet the credit policy. Status:Fully Paid' ELSE 'Fully Paid' END",
    "purpose": "lower(c_mktsegment)",
    "addr_state": "concat('N', CAST(c_nationkey AS {S}))",
    "dti": "CASE WHEN o_orderkey % 49 = 0 THEN NULL ELSE ((o_orderkey * 13) % 700) / 10e0 END",
    "delinq_2yrs": "CASE WHEN o_orderkey % 11 = 0 THEN o_orderkey % 4 ELSE 0 END",
    "fico_range_low": "560 + ((o_orderkey * 17) % 58) * 5",
    "fico_range_high": "564 + ((o_orderkey * 17) % 58) * 5",
    "inq_last_6mths": "o_orderkey % 6",
    "open_acc": "1 + o_orderkey % 20",
    "pub_rec": "CASE WHEN o_orderkey % 13 = 0 THEN 1 ELSE 0 END",
    "revol_bal": "(o_orderkey * 101) % 30000",
    "revol_util": "CASE WHEN o_orderkey % 53 = 0 THEN NULL "
                  "ELSE concat(CAST((o_orderkey * 37) % 120 AS {S}), '.5%') END",
    "total_acc": "CASE WHEN o_orderkey % 97 = 0 THEN 0 "
                 "ELSE 1 + o_orderkey % 20 + o_custkey % 30 END",
    "collections_12_mths_ex_med": "CASE WHEN o_orderkey % 17 = 0 THEN NULL "
                                  "WHEN o_orderkey % 29 = 0 THEN 1 ELSE 0 END",
    "acc_now_delinq": "CASE WHEN o_orderkey % 19 = 0 THEN NULL ELSE 0 END",
    "tot_coll_amt": "CASE WHEN o_orderkey % 23 = 0 THEN NULL ELSE o_orderkey % 500 END",
    "tot_cur_bal": "CASE WHEN o_orderkey % 31 = 0 THEN NULL ELSE (o_orderkey * 7) % 250000 END",
    "application_type": "CASE WHEN o_custkey % 10 = 0 THEN 'Joint App' ELSE 'Individual' END",
}

# The rest of the accepted-loans file: free text and what is known only later.
LATER_COLUMNS = {
    "title": "concat('Loan \"', c_name, '\",', CASE WHEN o_orderkey % 40 = 3 THEN chr(10) ELSE ' ' END, o_orderpriority)",
    "initial_list_status": "CASE WHEN o_orderkey % 2 = 0 THEN 'w' ELSE 'f' END",
    "out_prncp": "CASE WHEN o_orderkey % 10 = 0 THEN o_totalprice / 25e0 ELSE 0e0 END",
    "total_pymnt": "o_totalprice / 10e0",
    "total_rec_prncp": "o_totalprice / 12.5e0",
    "total_rec_int": "o_totalprice / 50e0",
    "last_pymnt_d": "{Y}",
    "last_fico_range_high": "CAST(504 + ((o_orderkey * 19) % 60) * 5 AS DOUBLE)",
    "last_fico_range_low": "CAST(500 + ((o_orderkey * 19) % 60) * 5 AS DOUBLE)",
}

# Rejected applications, one per order, under the header of their file.
REJECTED_VIEW = {
    "Amount Requested": "CASE WHEN o_orderkey % 31 = 0 THEN NULL ELSE o_totalprice / 10e0 END",
    "Application Date": "{Y}",
    "Loan Title": "CASE WHEN o_orderkey % 50 = 3 THEN concat('two,', chr(10), chr(10), '\"lines\"') "
                  "ELSE lower(o_orderpriority) END",
    "Risk_Score": "CASE WHEN o_orderkey % 7 = 0 THEN NULL "
                  "ELSE CAST(500 + (o_orderkey * 17) % 300 AS DOUBLE) END",
    "Debt-To-Income Ratio": "concat(CAST((o_orderkey * 13) % 90 AS {S}), '%')",
    "Zip Code": "concat(CAST(100 + o_custkey % 900 AS {S}), 'xx')",
    "State": "concat('S', CAST(o_custkey % 50 AS {S}))",
    "Employment Length": "CASE WHEN o_orderkey % 3 = 0 THEN '< 1 year' ELSE '5 years' END",
    "Policy Code": "CAST(o_orderkey % 3 AS {S})",
}

SPARK_WORDS = {"S": "STRING", "Y": "date_format(o_orderdate, 'MMM-yyyy')"}
DUCK_WORDS = {"S": "VARCHAR", "Y": "strftime(o_orderdate, '%b-%Y')"}


def _spark_select(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.selectExpr(*[f"{text.format(**SPARK_WORDS)} AS `{name}`"
                           for name, text in columns.items()])


def orders_with_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet")
    return orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))


def loans_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _spark_select(orders_with_customer(spark, sf_dir), LOAN_COLUMNS)


def loans_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _spark_select(orders_with_customer(spark, sf_dir), {**LOAN_COLUMNS, **LATER_COLUMNS})


def rejected_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _spark_select(spark.read.parquet(f"{sf_dir}/orders.parquet"), REJECTED_VIEW)


def write_rejected_files(spark: SparkSession, sf_dir: str, path: str) -> None:
    """The rejected-applications files, some with line breaks in the title."""
    rejected_raw(spark, sf_dir).write.options(header=True, escape='"').csv(path)


# Lines that are no loans, under the header of the accepted-loans file: some end
# after two fields, some have a word for the amount.
BROKEN = {
    "cut": ("o_orderkey % 100 = 1", "concat(CAST(o_orderkey AS {S}), ',cut off')"),
    "ill_typed": ("o_orderkey % 100 = 2", "concat(CAST(o_orderkey AS {S}), ',much', repeat(',', {n}))"),
}


def broken_lines(words: dict[str, str], kind: str) -> tuple[str, str]:
    """Condition on orders and text of the broken lines of one kind."""
    condition, text = BROKEN[kind]
    return condition, text.format(n=len(LOAN_COLUMNS) + len(LATER_COLUMNS) - 2, **words)


def write_loan_files(spark: SparkSession, sf_dir: str, path: str) -> None:
    """The accepted-loans files: loans, some with line breaks in the title, and a file with broken lines."""
    loans = loans_full(spark, sf_dir)
    loans.write.options(header=True, escape='"', ignoreLeadingWhiteSpace=False).csv(path)
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    parts = [orders.where(condition).selectExpr(f"{text} AS `{','.join(loans.columns)}`")
             for condition, text in (broken_lines(SPARK_WORDS, kind) for kind in BROKEN)]
    parts[0].unionByName(parts[1]).write.mode("append").options(header=True, sep="\u0001").csv(path)


def duck_select(columns: dict[str, str]) -> str:
    return ", ".join(f'{text.format(**DUCK_WORDS)} AS "{name}"' for name, text in columns.items())


# Fixed stand-ins for the fitted models, which are inputs here.
CHAMPION_INTERCEPT = -1.29
CHAMPION_COEFFICIENTS = {
    "grade_woe": 1.0, "fico_band_woe": 0.5, "dti_band_woe": 0.1, "loan_amnt_band_woe": 0.1,
    "emp_stability_woe": 0.1, "int_rate_band_woe": 0.3, "home_ownership_woe": 0.1,
    "verification_status_woe": 0.1, "purpose_woe": 0.1, "application_type_woe": 0.1,
}
CHALLENGER_INTERCEPT = -2.5
CHALLENGER_COEFFICIENTS = {
    "loan_amnt": 1e-05, "term_months": 0.005, "int_rate": 0.1, "annual_inc": -1e-06, "dti": 0.01,
    "fico_avg": -0.001, "revol_util": 0.002, "open_acc": 0.005, "total_acc": -0.004, "delinq_2yrs": 0.02,
    "inq_last_6mths": 0.03, "pub_rec": 0.05, "emp_length_yrs": -0.01, "installment_to_income": 0.2,
    "loan_to_income": 0.1, "revol_bal_to_income": 0.05, "open_to_total_acc_ratio": 0.1, "has_derogatory": 0.04,
}

# Split years of this view: its dates run from 1995 to 2001.
TRAIN_LAST, VALIDATION = 1998, 1999

APPLICATION_COLUMNS = [
    "id", "loan_amnt", "term_months", "int_rate", "grade", "emp_length_yrs", "annual_inc",
    "home_ownership", "dti", "fico_avg", "inq_last_6mths", "open_acc", "pub_rec", "revol_util",
    "total_acc", "delinq_2yrs", "verification_status", "purpose", "application_type",
]
