"""Fixed values.

FIXED VALUES: these names, tags, thresholds and lists must equal the studied
behaviour for results to match. They are stated plainly, in their natural order.
Everything that consumes them turns them into small reference DataFrames (a few
hundred rows at most, so broadcasting them is size-bounded by construction).
"""

# ---- FIXED VALUES: study window and valuation constants ---------------------------
STUDY_START = 2019
STUDY_END = 2025
EXPECTED_RECORDS = 7
PER = 20
ANNUAL_FORM_PATTERN = r"^(10-K|20-F)(/A)?$"
MIN_ANNUAL_DAYS = 300
TRAIN_LAST_FY = 2023
TEST_FIRST_FY = 2024

# ---- FIXED VALUES: line-item tags (primary tag -> panel column), in order -------
ANCHOR_TAG = "Assets"
ANCHOR_NAME = "asset"

REVENUE_ITEMS = [
    ("RevenueFromContractWithCustomerExcludingAssessedTax", "gross_revenue"),
    ("CostOfGoodsAndServicesSold", "cost"),
    ("SellingGeneralAndAdministrativeExpense", "expense_general/admin"),
    ("OperatingIncomeLoss", "operating_income"),
    ("IncomeLossFromContinuingOperationsBeforeIncomeTaxesExtraordinaryItemsNoncontrollingInterest",
     "recurrent_profit"),
    ("IncomeTaxExpenseBenefit", "tax"),
    ("NetIncomeLoss", "net_income"),
    ("WeightedAverageNumberOfSharesOutstandingBasic", "shares#"),
    ("EarningsPerShareBasic", "eps"),
]
ASSET_ITEMS = [
    ("StockholdersEquity", "equity"),
    ("AssetsCurrent", "currasset"),
    ("InventoryNet", "inventory"),
    ("OtherAssetsCurrent", "other_currasset"),
    ("LiabilitiesCurrent", "curr_liabilities"),
]
CASHFLOW_ITEMS = [
    ("NetCashProvidedByUsedInOperatingActivities", "operating_cash"),
    ("NetCashProvidedByUsedInInvestingActivities", "investing_cash"),
    ("PaymentsToAcquirePropertyPlantAndEquipment", "payment_cap"),
    ("PaymentsToAcquireIntangibleAssets", "payment_intangible"),
    ("NetCashProvidedByUsedInFinancingActivities", "financing_cash"),
    ("CashCashEquivalentsRestrictedCashAndRestrictedCashEquivalents", "cash_end"),
    ("IncreaseDecreaseInInventories", "inventory_delta"),
    ("PaymentsOfDividendsCommonStock", "dividend"),
]
LINE_ITEMS = REVENUE_ITEMS + ASSET_ITEMS + CASHFLOW_ITEMS

# ---- FIXED VALUES: alternative tags per concept, in preference order --------------
FALLBACKS = {
    "RevenueFromContractWithCustomerExcludingAssessedTax": [
        "Revenues", "RevenueFromContractWithCustomerExcludingAssessedTax",
        "SalesRevenueNet", "SalesRevenueGoodsNet"],
    "CostOfGoodsAndServicesSold": [
        "CostOfGoodsAndServicesSold", "CostOfRevenue", "CostOfGoodsSold", "CostsAndExpenses"],
    "ga_fallbacks": ["GeneralAndAdministrativeExpense", "AdministrativeExpenses"],
    "sm_fallbacks": [
        "MarketingAndAdvertisingExpense", "SellingAndMarketingExpense",
        "SellingAndAdvertisingExpense", "AdvertisingExpense"],
    "NetIncomeLoss": [
        "NetIncomeLoss", "NetIncomeLossAvailableToCommonStockholdersBasic", "ProfitLoss"],
    "OperatingIncomeLoss": [
        "OperatingIncomeLoss", "OperatingProfitLoss", "IncomeLossFromContinuingOperations",
        "IncomeLossFromContinuingOperationsIncludingPortionAttributableToNoncontrollingInterest",
        "NetInterestIncome", "ProfitLoss"],
    "IncomeLossFromContinuingOperationsBeforeIncomeTaxesExtraordinaryItemsNoncontrollingInterest": [
        "IncomeLossFromContinuingOperationsBeforeIncomeTaxesExtraordinaryItemsNoncontrollingInterest",
        "IncomeLossFromContinuingOperationsBeforeIncomeTaxesMinorityInterestAndIncomeLossFromEquityMethodInvestments",
        "IncomeBeforeTax"],
    "OtherAssetsCurrent": ["OtherAssetsCurrent", "PrepaidExpenseAndOtherAssetsCurrent"],
    "StockholdersEquity": [
        "StockholdersEquity", "StockholdersEquityIncludingPortionAttributableToNoncontrollingInterest"],
    "PaymentsToAcquirePropertyPlantAndEquipment": [
        "PaymentsToAcquirePropertyPlantAndEquipment", "PaymentsToAcquireProductiveAssets"],
    "CashCashEquivalentsRestrictedCashAndRestrictedCashEquivalents": [
        "CashCashEquivalentsRestrictedCashAndRestrictedCashEquivalents",
        "CashCashEquivalentsRestrictedCashAndRestrictedCashEquivalentsIncludingDisposalGroupAndDiscontinuedOperations",
        "CashAndCashEquivalentsAtCarryingValue"],
}
# Added (not filled) when the list contains NetInterestIncome.
ADDITIVE_TAG = "NoninterestIncome"
ADDITIVE_TRIGGER = "NetInterestIncome"

# Share counts: (namespace, tag) in preference order.
SHARE_FALLBACKS = [
    ("us-gaap", "WeightedAverageNumberOfSharesOutstandingBasic"),
    ("us-gaap", "CommonStockSharesIssued"),
    ("us-gaap", "CommonStockSharesOutstanding"),
    ("dei", "EntityCommonStockSharesOutstanding"),
    ("us-gaap", "WeightedAverageNumberOfSharesOutstandingBasicAndDiluted"),
]

# Concepts whose absence yields an empty column instead of a company error.
ALLOW_MISSING = [
    "CostOfGoodsAndServicesSold",
    "SellingGeneralAndAdministrativeExpense",
    "InventoryNet",
    "OtherAssetsCurrent",
    "LiabilitiesCurrent",
    "PaymentsToAcquirePropertyPlantAndEquipment",
    "PaymentsToAcquireIntangibleAssets",
    "IncreaseDecreaseInInventories",
    "PaymentsOfDividendsCommonStock",
]

# Components summed into current liabilities for two industries (listed once each).
CURR_LIABILITY_TAGS = [
    "InterestBearingDepositLiabilities",
    "NoninterestBearingDepositLiabilities",
    "TradingLiabilities",
    "DerivativeLiabilities",
    "OtherAccruedLiabilities",
    "LiabilityForUnpaidClaimsAndClaimsAdjustmentExpenseIncurredClaimsCurrentYear",
    "LiabilityForUnpaidClaimsAndClaimsAdjustmentExpenseClaimsPaidCurrentYear",
    "OperatingLeasesFutureMinimumPaymentsDueCurrent",
    "IncreaseDecreaseInOtherOperatingLiabilities",
    "AccruedIncomeTaxesCurrent",
]
CURR_LIABILITY_INDUSTRIES = [
    "6021 National Commercial Banks",
    "6331 Fire, Marine & Casualty Insurance",
]
# Companies allowed to have no SG&A at all.
SGA_EXEMPT_TICKERS = ["BRK-A", "BRK-B"]

# Components used to back-calculate current assets and pre-tax profit.
CURRASSET_SUBTRACT_TAGS = ["PropertyPlantAndEquipmentNet", "Goodwill", "EquityMethodInvestments"]
NONOPERATING_TAGS = ["NonoperatingIncomeExpense", "OtherNonoperatingIncomeExpense"]

# Words skipped when suggesting alternative tags.
SUGGEST_IGNORE_WORDS = [
    "And", "At", "Including", "Excluding", "Increase", "Decrease",
    "Than", "Of", "Before", "After", "In", "Or", "With", "By",
    "From", "To", "During", "Period", "Effect",
]

# ---- FIXED VALUES: panel column order ------------------------------------------
PANEL_BASE_COLUMNS = [
    "ticker", "name", "industry", "fy", "fp", "filed", "gross_revenue",
    "cost", "gross_profit", "expense_general/admin",
    "expense_others", "operating_income",
    "nonoperating_income", "recurrent_profit", "tax", "profit",
    "noncontrolling_interest", "net_income", "shares#", "eps",
    "asset", "equity", "liabilities", "currasset", "inventory",
    "other_currasset", "inven_other", "cash", "lt_asset",
    "curr_liabilities", "lt_liabilities",
    "operating_cash", "investing_cash", "payment_cap", "payment_intangible", "cap_ex",
    "financing_cash", "fcf", "cash_end",
    "inventory_delta", "dividend",
]
PRICE_COLUMNS = ["stock_price", "stock_price_unadjusted"]
VALUATION_V1_COLUMNS = [
    "per", "equity_ratio", "bps", "pbr", "cash_flow_ratio", "cash_reinvest_ratio",
    "cash_per_asset_ratio", "cashflowps_ratio", "ocfperprofit_ratio", "debt_assurance_ratio",
    "roa_discount", "roa", "financial_leverage_ratio", "leverage_factor", "risk_factor",
    "asset_value", "career_value", "theoretical_price", "current_ratio", "quick_ratio",
    "fixedasset_per_ltcapital_ratio", "fixedasset_per_equity_ratio", "roe",
    "theoretical_price_upper", "theoretical_roe", "theoretical_pbr", "asset_pershare",
    "market_cap",
]

# ---- FIXED VALUES: analysis lists --------------------------------------------------
# ratio -> three breakpoints; a decreasing list means "lower is better".
SCORE_BREAKPOINTS = {
    "equity_ratio": [0.1, 0.2, 0.5],
    "current_ratio": [0.7, 1, 2],
    "quick_ratio": [0.5, 0.7, 1.5],
    "fixedasset_per_ltcapital_ratio": [1.2, 1, 0.8],
    "fixedasset_per_equity_ratio": [1.5, 1.2, 1],
    "cash_flow_ratio": [0.5, 1.0, 1.5],
    "ocfperprofit_ratio": [0.5, 0.8, 1.0],
    "cash_reinvest_ratio": [0.05, 0.1, 0.15],
    "debt_assurance_ratio": [0.1, 0.25, 0.4],
}
SCORE_POINTS = [-5, 0, 5, 8]


# Items divided by the share count (in this order).
PER_SHARE_BASE = [
    "cap_ex", "cash_end", "cash", "cost", "curr_liabilities",
    "currasset", "dividend", "expense_general/admin", "expense_others",
    "fcf", "financing_cash", "gross_profit", "gross_revenue",
    "inven_other", "inventory_delta", "inventory", "investing_cash",
    "liabilities", "lt_asset", "lt_liabilities", "noncontrolling_interest",
    "nonoperating_income", "operating_cash", "operating_income",
    "other_currasset", "payment_cap", "payment_intangible", "profit",
    "recurrent_profit", "tax",
]
# Correlation factors = per-share items, then these.
CORRELATION_EXTRA = ["bps", "shares#", "eps", "asset_pershare", "ratio_score"]
# Not log-compressed.
NO_LOG = ["shares#", "ratio_score"]

# ---- FIXED VALUES: SIC code ranges -> broad industry (inclusive bounds) ---------------
SIC_GROUPS = [
    (100, 999, "Agriculture, Forestry and Fishing"),
    (1000, 1499, "Mining"),
    (1500, 1799, "Construction"),
    (2000, 3999, "Manufacturing"),
    (4000, 4999, "Transportation, Comm, Electric, Gas & Sanitary"),
    (5000, 5199, "Wholesale Trade"),
    (5200, 5999, "Retail Trade"),
    (6000, 6799, "Finance, Insurance and Real Estate"),
    (7000, 8999, "Services"),
    (9100, 9999, "Public Administration"),
]
OTHER_GROUP = "Other/Unclassified"

# ---- FIXED VALUES: statistics and model search -------------------------------------
TRIM_LOW, TRIM_HIGH = 0.01, 0.99
SMALL_SHARE_COUNT = 0.0035
SMALL_SHARE_CAP = 0.005
OTHER_FOLD_LABEL = "All other industries"
MIN_GROUP_ROWS_CORR = 5
MISSING_DROP_PCT = 10
PROTECTED_COLUMNS = ["ticker", "fy", "stock_price", "market_cap", "broad_industry"]
MIN_TRAIN_ROWS = 5
MIN_TEST_ROWS = 2
FEATURE_RATIOS = [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]
# The boosting family is named for what is fitted here.
MODEL_FAMILIES = [
    "Linear Regression", "Ridge Regression", "Decision Tree",
    "Random Forest", "Support Vector Regression", "Gradient-Boosted Trees",
]
RIDGE_ALPHA = 1.0
SVR_C = 100.0
SVR_EPSILON = 0.1
FOREST_TREES = 100
BOOST_ROUNDS = 100
BOOST_RATE = 0.05
SEED = 42
TOP_CAP_COMPANIES = 20
BIN_COUNT = 100
BAND_DRAWS = 1000
BAND_Z = 1.959963984540054   # 97.5 % point of the normal distribution

# ---- FIXED VALUES: log and provenance texts ------------------------------------------
MSG_DAMAGED_BOTH = 'Relocated to table "damaged_data" due to missing recurrent_profit and net_income.'
MSG_DAMAGED_NI = 'Relocated to table "damaged_data" due to missing net_income.'
MSG_DAMAGED_RP = 'Relocated to table "damaged_data" due to missing recurrent_profit.'
MSG_ZERO_SHARES = "Deleted due to missing shares#."
MSG_SHARES_FILLED = "year %s shares# is filled into %s"
MSG_EPS_RECOVERED = "year %s eps is recovered from nan into %.2f, "
MSG_TAG_MISSING = "No %s Tag Found"
MSG_SKIP = "Skip CIK %s (%s %s): Data incomplete or period not matched."
MSG_NONE_EMPTY = "'NoneType' object has no attribute 'empty'"
MSG_NONE_SUBSCRIPT = "'NoneType' object is not subscriptable"
EQUATION = ("Predicted Price = %.3f + \n    ", "(%.3f * %s)", " + \n    ")     # intercept, term, separator
EPS_CALCULATED = "calculated: net_income / shares#"
MSG_BAD_PAYLOAD = "Request Failure on filingMetadata"
MSG_BAD_FACTS = "Request Failure on companyFacts"
MSG_NO_USED_TAG = "cannot access local variable 'used_tag' where it is not associated with a value"
MSG_NO_DATA_COLS = "cannot access local variable 'data_cols' where it is not associated with a value"
MSG_NOT_JSON = "Expecting value: line 1 column 1 (char 0)"
MSG_ZERO_DIVISION = "float division by zero"
MSG_DUPLICATE_LABELS = "cannot reindex on an axis with duplicate labels"
MSG_MERGE_LEFT = "Merge keys are not unique in left dataset; not a one-to-one merge"
MSG_MERGE_RIGHT = "Merge keys are not unique in right dataset; not a one-to-one merge"
#: Patterns of the logged errors that a recovery run takes up again.
RECOVERY_PATTERNS = [
    "%line 1 column 1 (char 0)%",
    "%cannot access local variable 'used_tag'%",
    "%'NoneType' object has no attribute 'empty'%",
    "%division by zero%",
    "%cannot reindex on an axis with duplicate labels%",
]
