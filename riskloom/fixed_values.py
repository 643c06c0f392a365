"""Fixed values of the loan-risk domain.

Everything here has to equal the published values for results to be right:
column names, status words, band edges and labels, score constants, model
feature lists.  They are data, kept together and in natural order.
"""

# ---------------------------------------------------------------- fixed values
# Columns kept from the accepted-loans file.
ACCEPTED_COLUMNS = [
    "id", "loan_amnt", "funded_amnt", "term", "int_rate", "installment",
    "grade", "sub_grade", "emp_length", "home_ownership", "annual_inc",
    "verification_status", "issue_d", "loan_status", "purpose", "title",
    "addr_state", "dti", "delinq_2yrs", "fico_range_low", "fico_range_high",
    "inq_last_6mths", "open_acc", "pub_rec", "revol_bal", "revol_util",
    "total_acc", "initial_list_status", "out_prncp", "total_pymnt",
    "total_rec_prncp", "total_rec_int", "last_pymnt_d", "last_fico_range_high",
    "last_fico_range_low", "collections_12_mths_ex_med", "acc_now_delinq",
    "tot_coll_amt", "tot_cur_bal", "application_type",
]

# Accepted columns that are text in the file; id is a bigint, the rest double.
ACCEPTED_TEXT_COLUMNS = [
    "term", "int_rate", "grade", "sub_grade", "emp_length", "home_ownership",
    "verification_status", "issue_d", "loan_status", "purpose", "title",
    "addr_state", "revol_util", "initial_list_status", "last_pymnt_d",
    "application_type",
]

# Header names of the rejected-applications file and our names for them.
REJECTED_COLUMNS = {
    "Amount Requested": "amount_requested",
    "Application Date": "application_date",
    "Loan Title": "loan_title",
    "Risk_Score": "risk_score",
    "Debt-To-Income Ratio": "debt_to_income_ratio",
    "Zip Code": "zip_code",
    "State": "state",
    "Employment Length": "employment_length",
    "Policy Code": "policy_code",
}

# Columns known only after the loan has run; never inputs of a model.
LEAKAGE_COLUMNS = [
    "out_prncp", "total_pymnt", "total_rec_prncp", "total_rec_int",
    "last_pymnt_d", "last_fico_range_high", "last_fico_range_low",
]

# Final outcomes.  Other statuses are undecided and leave the population.
BAD_STATUSES = [
    "Charged Off",
    "Default",
    "Does not meet the credit policy. Status:Charged Off",
    "Late (31-120 days)",
]
GOOD_STATUSES = [
    "Fully Paid",
    "Does not meet the credit policy. Status:Fully Paid",
]

# Employment length text and the years it stands for.
EMP_LENGTH_YEARS = {
    "< 1 year": 0, "1 year": 1, "2 years": 2, "3 years": 3, "4 years": 4,
    "5 years": 5, "6 years": 6, "7 years": 7, "8 years": 8, "9 years": 9,
    "10+ years": 10,
}

# Numeric columns described by the data profile.
PROFILE_COLUMNS = [
    "loan_amnt", "funded_amnt", "term_months", "int_rate", "installment",
    "emp_length_yrs", "annual_inc", "dti", "delinq_2yrs", "fico_avg",
    "inq_last_6mths", "open_acc", "pub_rec", "revol_bal", "revol_util",
    "total_acc", "collections_12_mths_ex_med", "acc_now_delinq",
    "tot_coll_amt", "tot_cur_bal",
]

# Cleaning rules: replacements for NULL, upper caps, valid ranges.
IMPUTED_VALUES = {
    "emp_length_yrs": 5,
    "revol_util": 51.77,
    "collections_12_mths_ex_med": 0,
    "acc_now_delinq": 0,
    "tot_coll_amt": 0,
    "tot_cur_bal": 0,
}
UPPER_CAPS = {"annual_inc": 300000, "revol_util": 100}
DTI_RANGE = (0, 60)
FICO_RANGE = (580, 850)

# Left-closed bands: a value below the first edge gets the first label, and so
# on; values at or above the last edge, and NULL, get the last label.
FICO_BANDS = ([620, 660, 700, 740, 780],
              ["1_below_620", "2_620_659", "3_660_699", "4_700_739",
               "5_740_779", "6_780_plus"])
DTI_BANDS = ([10, 20, 30], ["1_low", "2_medium", "3_high", "4_very_high"])
LOAN_AMNT_BANDS = ([5000, 10000, 20000, 30000],
                   ["1_micro", "2_small", "3_medium", "4_large", "5_xlarge"])
EMP_BANDS = ([2, 5, 8], ["1_junior", "2_mid", "3_senior", "4_veteran"])
INT_RATE_BANDS = ([8, 12, 16, 22],
                  ["1_prime", "2_near_prime", "3_subprime", "4_deep_subprime",
                   "5_distressed"])

# Last training vintage and the validation vintage; later ones are out of time.
TRAIN_LAST_YEAR = 2015
VALIDATION_YEAR = 2016

# Right-closed cuts: one more edge than labels, outside values get NULL.
FICO_CUT = ([580, 620, 660, 700, 740, 780, 850],
            ["580-620", "620-660", "660-700", "700-740", "740-780", "780-850"])
SCORE_BAND_CUT = ([299, 550, 600, 620, 650, 680, 720, 760, 851],
                  ["<550", "550-600", "600-620", "620-650", "650-680",
                   "680-720", "720-760", "760+"])
PSI_CUT = ([299, 550, 580, 610, 640, 670, 700, 730, 760, 851],
           ["<550", "550-580", "580-610", "610-640", "640-670", "670-700",
            "700-730", "730-760", "760+"])
PSI_EPSILON = 1e-10

# Binned features that are WoE-encoded.
BINNED_FEATURES = [
    "grade", "fico_band", "dti_band", "loan_amnt_band", "emp_stability",
    "int_rate_band", "home_ownership", "verification_status", "purpose",
    "application_type",
]
# Inputs of the champion (scorecard) and of the challenger (raw features).
WOE_FEATURES = [f"{name}_woe" for name in BINNED_FEATURES]
RAW_FEATURES = [
    "loan_amnt", "term_months", "int_rate", "annual_inc", "dti", "fico_avg",
    "revol_util", "open_acc", "total_acc", "delinq_2yrs", "inq_last_6mths",
    "pub_rec", "emp_length_yrs", "installment_to_income", "loan_to_income",
    "revol_bal_to_income", "open_to_total_acc_ratio", "has_derogatory",
]

# Names of the champion's inputs in a breakdown of a score.
FACTOR_NAMES = {
    "grade_woe": "Loan Grade",
    "fico_band_woe": "FICO Score",
    "dti_band_woe": "DTI Ratio",
    "loan_amnt_band_woe": "Loan Amount",
    "emp_stability_woe": "Employment",
    "int_rate_band_woe": "Interest Rate",
    "home_ownership_woe": "Home Ownership",
    "verification_status_woe": "Verification",
    "purpose_woe": "Loan Purpose",
    "application_type_woe": "App Type",
}

# Exploration lists.
CORRELATION_COLUMNS = [
    "loan_amnt", "int_rate", "annual_inc", "dti", "fico_avg", "revol_util",
    "open_acc", "delinq_2yrs", "inq_last_6mths", "pub_rec", "total_acc",
    "emp_length_yrs", "is_bad",
]
HISTOGRAM_COLUMNS = [
    "loan_amnt", "int_rate", "annual_inc", "dti", "fico_avg", "revol_util",
    "open_acc", "delinq_2yrs",
]
CATEGORICAL_COLUMNS = [
    "home_ownership", "verification_status", "purpose", "application_type",
]
SMALL_GROUP_LIMIT = 500

# Score scales.
SCORE_MIN, SCORE_MAX = 300, 850
MINMAX_PD = (0.09, 0.90)
POINTS_TO_DOUBLE = 20
BASE_SCORE = 600
BASE_ODDS = 50
ODDS_FLOOR = 1e-10

# Score floor, tier, decision, reason; the last entry has no floor.
RISK_TIERS = [
    (720, "Prime", "APPROVED", "Strong credit profile — low default risk"),
    (640, "Near-Prime", "APPROVED", "Acceptable credit profile — moderate risk"),
    (560, "Sub-Prime", "APPROVED", "Elevated risk — approve with higher rate"),
    (490, "Deep Sub-Prime", "REVIEW",
     "High default risk — manual underwriting required"),
    (None, "High Risk", "DECLINED",
     "Credit profile does not meet minimum threshold"),
]

# Upper limits and words for PSI and IV readings; the last word has no limit.
PSI_STATUS = ([0.10, 0.25], ["Stable", "Monitor", "Retrain"])
IV_STRENGTH = ([0.02, 0.1, 0.3], ["useless", "weak", "medium", "strong"])

# Rules for a scoring request.
APPLICATION_TERMS = [36, 60]
APPLICATION_GRADES = ["A", "B", "C", "D", "E", "F", "G"]
APPLICATION_OWNERSHIP = ["RENT", "OWN", "MORTGAGE", "OTHER", "NONE"]
DEFAULT_APPLICATION_TYPE = "Individual"

# Champion against challenger.
APPROVAL_THRESHOLD = 0.25
LOSS_GIVEN_DEFAULT = 0.60
SIGNIFICANCE_LEVEL = 0.05
WIN_PROBABILITY = 0.80
BOOTSTRAP_ITERATIONS = 1000
# ------------------------------------------------------------ end fixed values
