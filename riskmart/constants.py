"""Fixed values of the credit data model: names, thresholds and defaults that results depend on."""

# --- fixed values: sentinels and code lists -------------------------------------------------------
UNEMPLOYED_DAYS = 365243
DAYS_PER_YEAR = 365.25
LOAN_TYPES = ("Cash loans", "Revolving loans")
GENDERS = ("M", "F", "XNA")
BUREAU_STATUSES = ("0", "1", "2", "3", "4", "5", "C", "X")
DELINQUENT_LEVELS = ("1", "2", "3", "4", "5")
NOT_DELINQUENT = ("0", "X", "C")
PREVIOUS_STATUSES = ("Approved", "Refused", "Canceled", "Unused offer")
SEGMENTS = ("LOW", "MEDIUM", "HIGH", "VERY_HIGH")
HIGH_SEGMENTS = ("HIGH", "VERY_HIGH")
NULL_TOKENS = ("", "NULL", "null")

# --- fixed values: credit-to-income cuts (strictly above) -----------------------------------------
SEGMENT_CUTS = ((5.0, "VERY_HIGH"), (3.0, "HIGH"), (1.5, "MEDIUM"))
SEGMENT_FLOOR = "LOW"

# --- fixed values: probability tiers (strictly below) and their decisions -------------------------
TIER_CUTS = ((0.05, "LOW", "APPROVE"), (0.15, "MEDIUM", "APPROVE_WITH_CONDITIONS"), (0.30, "HIGH", "MANUAL_REVIEW"))
TIER_CEILING = ("VERY_HIGH", "DECLINE")
MODEL_VERSION = "xgb_v1"

# --- fixed values: composite score weights --------------------------------------------------------
SCORE_WEIGHTS = {"delinquency": 0.30, "late": 0.25, "ratio": 0.20, "utilization": 0.15, "refusal": 0.10}

# --- fixed values: band labels --------------------------------------------------------------------
INCOME_BANDS = ((90000, "1_Low (<90K)"), (180000, "2_Mid (90–180K)"), (360000, "3_High (180–360K)"))
INCOME_TOP = "4_VeryHigh (360K+)"
INCOME_BANDS_REPORT = ((90000, "1_Low (<$90K)"), (180000, "2_Mid ($90–$180K)"), (360000, "3_High ($180–$360K)"))
INCOME_TOP_REPORT = "4_Very High ($360K+)"
AGE_BANDS = ((30, "Under 30"), (45, "30–44"), (60, "45–59"))
AGE_TOP = "60+"
RATE_ERAS = ((1.0, "Low Rate Era"), (3.0, "Rising Rate Era"))
RATE_ERA_TOP = "High Rate Era"
TRAFFIC_LIGHTS = ((6.0, "green"), (12.0, "yellow"))  # yellow includes 12
TRAFFIC_TOP = "red"

# --- fixed values: macro series code -> column ----------------------------------------------------
MACRO_SERIES = {
    "CAOVERAGE": "overnight_rate",
    "BD.CDN.2YR.DQ.YLD": "bond_2yr",
    "BD.CDN.10YR.DQ.YLD": "bond_10yr",
    "FXCADUSD": "cadusd",
    "STATIC_TOTALCPICHANGE": "cpi_total",
}

# --- fixed values: model inputs, with bounds and defaults of a scoring record ----------------------
FEATURES = (
    "ext_source_1", "ext_source_2", "ext_source_3",
    "credit_to_income_ratio", "annuity_to_income_ratio",
    "bureau_delinquency_rate", "bureau_worst_delinquency", "bureau_total_overdue",
    "inst_late_rate", "inst_max_days_late", "inst_avg_payment_ratio",
    "cc_avg_utilization", "cc_months_overdue",
    "prev_refusal_rate", "prev_num_applications",
    "age_years", "years_employed", "composite_risk_score",
)
# feature: (default or None when required, lowest, highest or None when open)
RECORD_BOUNDS = {
    "ext_source_1": (0.5, 0, 1), "ext_source_2": (0.5, 0, 1), "ext_source_3": (0.5, 0, 1),
    "credit_to_income_ratio": (None, 0, 100), "annuity_to_income_ratio": (None, 0, 10),
    "bureau_delinquency_rate": (0.0, 0, 1), "bureau_worst_delinquency": (0.0, 0, 5),
    "bureau_total_overdue": (0.0, 0, None), "inst_late_rate": (0.0, 0, 1),
    "inst_max_days_late": (0.0, 0, None), "inst_avg_payment_ratio": (1.0, 0, 5),
    "cc_avg_utilization": (0.0, 0, 3), "cc_months_overdue": (0.0, 0, None),
    "prev_refusal_rate": (0.0, 0, 1), "prev_num_applications": (0.0, 0, None),
    "age_years": (None, 18, 100), "years_employed": (0.0, 0, None), "composite_risk_score": (0.0, 0, 1),
}

# --- fixed values: boosted-tree and logistic settings, metric gates -------------------------------
TREE_PARAMS = {"n_trees": 500, "depth": 6, "step": 0.05, "row_share": 0.8, "column_share": 0.8, "positive_weight": 11.0}
LOGIT_PARAMS = {"c": 1.0, "max_iter": 1000}
SMOTE_SHARE = 0.3
METRIC_GATES = {"auc": 0.70, "gini": 0.35, "ks": 0.30}
PSI_RETRAIN = 0.25

# --- fixed values: segment dimension (order, description, range text, report colour, capital weight) -
SEGMENT_DIM = (
    ("LOW", 1, "Credit-to-income ≤ 1.5", "≤ 1.5×", "Lowest probability of default", "#00B050", 35),
    ("MEDIUM", 2, "Credit-to-income 1.5–3.0", "1.5–3.0×", "Acceptable risk, monitor", "#FFC000", 75),
    ("HIGH", 3, "Credit-to-income 3.0–5.0", "3.0–5.0×", "High risk, manual review", "#FF0000", 100),
    ("VERY_HIGH", 4, "Credit-to-income > 5.0", "> 5.0×", "Outside risk appetite", "#C00000", 150),
)
SEGMENT_DECISION = {"LOW": "Approved", "MEDIUM": "Conditional", "HIGH": "Review", "VERY_HIGH": "Declined"}
LOAN_TYPE_DIM = (("Cash loans", "Cash"), ("Revolving loans", "Revolving"))
