"""Column lists of the tables that the stages write."""

#: Raw market files (fixed names of the input contract).
RAW_REQUIRED = ("ORG_ID", "CLIENT_ID", "DRUGS_ID", "PERIOD_ID", "Q", "V", "INN", "INN_ID", "Full medication name", "NFC Code (1)", "NFC Code (2)", "ATC Code (4)", "ATC Code (5)")
RAW_USED = RAW_REQUIRED[:11]
RENAMES = {"ORG_ID": "PHARM_ID", "INN": "INN_NAME", "Full medication name": "DRUGS_NAME", "NFC Code (1)": "NFC1_ID", "NFC Code (2)": "NFC_ID"}

#: The columns of the tables that the method puts out, in their order.
AGGREGATED = ("CLIENT_ID", "PHARM_ID", "DRUGS_ID", "Date", "Q", "V", "DRUGS_NAME", "INN_NAME", "INN_ID", "NFC1_ID", "NFC_ID", "NOTSOLD_PERCENT", "MARKET_TOTAL_DRUGS_PACK", "MARKET_TOTAL_DRUGS_REVENUE")
STOCKOUT_EVENTS = ("EVENT_ID", "CLIENT_ID", "INN_ID", "INN_NAME", "DRUGS_ID", "DRUGS_NAME", "NFC1_ID", "STOCKOUT_START", "STOCKOUT_END", "STOCKOUT_WEEKS", "PRE_START", "PRE_END", "PRE_WEEKS", "PRE_AVG_Q")
DID_EVENTS = ("EVENT_ID", "CLIENT_ID", "INN_ID", "DRUGS_ID", "DRUGS_NAME", "NFC1_ID", "POST_START", "POST_END", "POST_WEEKS", "POST_STATUS", "MARKET_PRE", "MARKET_DURING", "MARKET_GROWTH", "INTERNAL_LIFT", "LOST_SALES", "TOTAL_EFFECT", "SHARE_INTERNAL", "SHARE_LOST", "SUBSTITUTES_COUNT", "SUBSTITUTES_WITH_LIFT")
SUBSTITUTE_PAIRS = ("EVENT_ID", "CLIENT_ID", "INN_ID", "TARGET_DRUGS_ID", "TARGET_DRUGS_NAME", "TARGET_NFC1_ID", "SUBSTITUTE_DRUGS_ID", "SUBSTITUTE_DRUGS_NAME", "SUBSTITUTE_NFC1_ID", "SAME_NFC1", "SALES_PRE", "SALES_DURING", "EXPECTED", "LIFT")
MARKET_SHARES = ("CLIENT_ID", "INN_ID", "INN_NAME", "STOCKOUT_DRUG_ID", "STOCKOUT_DRUG_NAME", "STOCKOUT_NFC1_ID", "SUBSTITUTE_DRUG_ID", "SUBSTITUTE_DRUG_NAME", "SUBSTITUTE_NFC1_ID", "SAME_NFC1", "TOTAL_LIFT", "INTERNAL_LIFT", "SUBSTITUTE_SHARE", "EVENTS_COUNT", "SUBSTITUTE_RANK")
DRUG_STATISTICS = ("DRUGS_ID", "DRUGS_NAME", "INN_ID", "INN_NAME", "NFC1_ID", "MARKET_COUNT_TOTAL", "MARKET_COUNT_CLEAN", "MEAN_SHARE_INTERNAL", "COVERAGE_PCT", "CONDITIONAL_RETENTION", "MARKETS_WITH_SUB", "DRUG_CLASS", "DIP_PVALUE", "STD_SHARE_INTERNAL", "VARIATION_COEF", "RELIABILITY_LABEL", "RELIABILITY_SCORE")
DRUG_COEFFICIENTS = ("DRUGS_ID", "DRUG_CLASS", "COEF_1", "UNIQUENESS_COEF", "COVERAGE_PCT", "CONDITIONAL_RETENTION", "MARKETS_WITH_SUB", "DRUGS_NAME", "INN_ID", "INN_NAME", "NFC1_ID", "MARKET_COUNT", "RELIABILITY_SCORE")
FINAL_SHARES = ("DRUGS_ID", "SUBSTITUTE_DRUG_ID", "SUBSTITUTE_SHARE", "DRUGS_NAME", "SUBSTITUTE_DRUG_NAME", "SAME_NFC1", "SUBSTITUTE_RANK", "MARKETS_COUNT")
STATUSES = ("READY", "OVERSIZED", "EMPTY", "MALFORMED")


def missing_columns(have: list[str], want: tuple[str, ...] = RAW_REQUIRED) -> list[str]:
    """Which of the wanted columns aren't there, in their order."""
    return [c for c in want if c not in have]
