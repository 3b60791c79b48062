"""Preset values of the two loan chains, the prompt registry and the price list.

The values under a FIXED VALUES heading must equal the ones the original
notebooks use so that results agree.  They are kept as plain data so callers
can pass their own lists and maps to every operator instead.
"""

from __future__ import annotations

# --- FIXED VALUES (consumer-loan chain) -------------------------------------

# Loan statuses kept by the silver step, in the original order.
LOAN_STATUSES = [
    "Fully Paid",
    "Charged Off",
    "Current",
    "Late (31-120 days)",
    "Late (16-30 days)",
    "In Grace Period",
    "Default",
]

# Risk tier by grade; anything else (and NULL) is "Unknown".
RISK_TIERS = [
    (["A", "B"], "Low Risk"),
    (["C", "D"], "Medium Risk"),
    (["E", "F", "G"], "High Risk"),
]
RISK_TIER_DEFAULT = "Unknown"

# Columns the loan silver step keeps from the raw file.
LOAN_SILVER_COLUMNS = [
    "id", "loan_amnt", "funded_amnt", "term", "int_rate", "grade", "sub_grade",
    "emp_length", "home_ownership", "annual_inc", "loan_status", "purpose",
    "addr_state", "dti", "issue_d",
]

# Reduced column list of the declarative variant (no emp_length).
DECLARATIVE_SILVER_COLUMNS = [
    "id", "loan_amnt", "funded_amnt", "term", "int_rate", "grade", "sub_grade",
    "home_ownership", "annual_inc", "loan_status", "purpose", "addr_state",
    "dti", "issue_d",
]

# Named expectations of the declarative silver table.
_STATUS_KNOWN = f"loan_status IN ({', '.join(repr(s) for s in LOAN_STATUSES)})"
LOAN_EXPECTATIONS = {
    "valid_loan_amount": "loan_amnt IS NOT NULL",
    "valid_loan_status": _STATUS_KNOWN,
}

# Statuses the narrative step and the rate report look at.
NARRATIVE_STATUSES = ["Fully Paid", "Charged Off"]

# Month-year pattern of the issue date text.
ISSUE_DATE_PATTERN = "MMM-yyyy"

# --- FIXED VALUES (mortgage chain) ------------------------------------------

ACTION_LABELS = {
    "1": "Originated",
    "2": "Approved Not Accepted",
    "3": "Denied",
    "4": "Withdrawn",
    "6": "Incomplete",
}
PURPOSE_LABELS = {
    "1": "Home Purchase",
    "2": "Home Improvement",
    "4": "Refinancing",
    "31": "Cash-out Refinancing",
    "32": "Other Refinancing",
}
LOAN_TYPE_LABELS = {
    "1": "Conventional",
    "2": "FHA",
    "3": "VA",
    "4": "USDA",
}
CODE_DEFAULT = "Other"

# Action codes kept by the mortgage silver step.
KEPT_ACTIONS = ["1", "2", "3"]

# Approval tier by action label, default "Other".
APPROVAL_TIERS = {
    "Originated": "Approved & Funded",
    "Approved Not Accepted": "Approved Not Taken",
    "Denied": "Denied",
}

# Mortgage silver projection; the dashed race column is renamed.
MORTGAGE_SILVER_COLUMNS = [
    "activity_year", "lei", "loan_type", "loan_purpose", "action_taken",
    "loan_amount", "interest_rate", "loan_term", "property_value", "income",
    "debt_to_income_ratio", "`applicant_race-1` AS applicant_race",
    "applicant_sex", "applicant_age", "county_code",
]

# --- FIXED VALUES (change feed) ---------------------------------------------

CHANGE_OPERATION = "UPDATE"
CHANGE_SOURCE_SYSTEM = "loan_servicing_feed"

# --- FIXED VALUES (prompt registry and prices) ------------------------------

DEFAULT_MODEL = "claude-sonnet-4-6"

PRICES = {
    "claude-sonnet-4-6": {"input_cost_per_1k": 0.003, "output_cost_per_1k": 0.015},
}

# Prompt of the per-segment narrative step.  Same text as registry v1.0 except
# that its blank line carries four spaces.
SEGMENT_NARRATIVE_TEMPLATE = """You are a credit risk analyst. Write a 2 sentence risk narrative for this loan segment:
    
Grade: {grade}
Risk Tier: {risk_tier}
Loan Status: {loan_status}
Loan Count: {loan_count}
Avg Loan Amount: ${avg_loan_amt:,.2f}
Avg Interest Rate: {avg_interest_rate}%
Avg DTI: {avg_dti}
Total Volume: ${total_loan_volume:,.2f}

Be specific, use the numbers, and focus on credit risk implications."""

# Output token limit of a narrative call.
NARRATIVE_MAX_TOKENS = 150

PROMPT_REGISTRY = {
    "risk_narrative_v1.0": {
        "version": "1.0",
        "model": "claude-sonnet-4-6",
        "description": "Initial risk narrative prompt — grade + status + metrics",
        "created_date": "2026-06-15",
        "template": """You are a credit risk analyst. Write a 2 sentence risk narrative for this loan segment:

Grade: {grade}
Risk Tier: {risk_tier}
Loan Status: {loan_status}
Loan Count: {loan_count}
Avg Loan Amount: ${avg_loan_amt:,.2f}
Avg Interest Rate: {avg_interest_rate}%
Avg DTI: {avg_dti}
Total Volume: ${total_loan_volume:,.2f}

Be specific, use the numbers, and focus on credit risk implications.""",
    },
    "risk_narrative_v1.1": {
        "version": "1.1",
        "model": "claude-sonnet-4-6",
        "description": "Enhanced prompt — adds default rate context and recommendation",
        "created_date": "2026-06-15",
        "template": """You are a senior credit risk officer at a bank. Write a 2 sentence risk narrative for this loan segment. Include a specific risk recommendation.

Grade: {grade}
Risk Tier: {risk_tier}
Loan Status: {loan_status}
Loan Count: {loan_count}
Avg Loan Amount: ${avg_loan_amt:,.2f}
Avg Interest Rate: {avg_interest_rate}%
Avg DTI: {avg_dti}
Total Volume: ${total_loan_volume:,.2f}

Focus on: portfolio exposure, borrower risk profile, and one actionable recommendation.""",
    },
}

# --- OWN VALUES (not in the original code) ------------------------------------

# Bronze validation of the raw loan text (reported, rows are not dropped).
BRONZE_LOAN_EXPECTATIONS = {
    "id_present": "id IS NOT NULL",
    "loan_amnt_numeric": "try_cast(loan_amnt AS DOUBLE) IS NOT NULL",
    "annual_inc_numeric": "try_cast(annual_inc AS DOUBLE) IS NOT NULL",
    "loan_status_known": _STATUS_KNOWN,
    "issue_d_month_year": "try_to_date(issue_d, 'MMM-yyyy') IS NOT NULL",
}

# Usability of mortgage silver fields (reported, rows are kept):
# makes the NULL share behind each average visible.
MORTGAGE_EXPECTATIONS = {
    "dti_numeric": "try_cast(replace(debt_to_income_ratio, '%', '') AS DOUBLE) IS NOT NULL",
    "interest_rate_present": "interest_rate IS NOT NULL",
    "income_present": "income IS NOT NULL",
    "loan_term_present": "loan_term IS NOT NULL",
}
