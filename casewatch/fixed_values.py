"""Lists, tables and text formats that results must agree with.

Nothing here is computed. Thresholds are the defaults of the functions that use them.
"""

from __future__ import annotations

# --- fixed values: domains -------------------------------------------------------------
CHANNELS = ["Online", "Branch", "Phone", "Email", "Ombudsman Portal"]
STATUSES = ["Resolved", "Pending", "Escalated"]
SEGMENTS = ["Retail", "MSME", "Corporate"]
SEVERITIES = ["Low", "Medium", "High", "Critical"]  # rising order

# --- fixed values: institution dimension -----------------------------------------------
# bank_name, bank_type, license_number, headquarters
INSTITUTIONS = [
    ("SBI", "Public Sector", "LIC-SBI-1001", "Mumbai"),
    ("PNB", "Public Sector", "LIC-PNB-1002", "New Delhi"),
    ("Canara Bank", "Public Sector", "LIC-CNB-1003", "Bengaluru"),
    ("Bank of Baroda", "Public Sector", "LIC-BOB-1004", "Vadodara"),
    ("Union Bank of India", "Public Sector", "LIC-UBI-1005", "Mumbai"),
    ("Bank of India", "Public Sector", "LIC-BOI-1006", "Mumbai"),
    ("UCO Bank", "Public Sector", "LIC-UCO-1007", "Kolkata"),
    ("Central Bank of India", "Public Sector", "LIC-CBI-1008", "Mumbai"),
    ("Indian Bank", "Public Sector", "LIC-IDB-1009", "Chennai"),
    ("HDFC Bank", "Private Sector", "LIC-HDF-2001", "Mumbai"),
    ("ICICI Bank", "Private Sector", "LIC-ICI-2002", "Mumbai"),
    ("Axis Bank", "Private Sector", "LIC-AXS-2003", "Mumbai"),
    ("Kotak Mahindra Bank", "Private Sector", "LIC-KOT-2004", "Mumbai"),
    ("IndusInd Bank", "Private Sector", "LIC-IND-2005", "Mumbai"),
    ("Yes Bank", "Private Sector", "LIC-YES-2006", "Mumbai"),
    ("IDFC First Bank", "Private Sector", "LIC-IDF-2007", "Mumbai"),
    ("Federal Bank", "Private Sector", "LIC-FED-2008", "Aluva"),
    ("South Indian Bank", "Private Sector", "LIC-SIB-2009", "Thrissur"),
    ("RBL Bank", "Private Sector", "LIC-RBL-2010", "Mumbai"),
    ("Bandhan Bank", "Small Finance Bank", "LIC-BDN-3001", "Kolkata"),
]

# --- fixed values: category dimension --------------------------------------------------
CATEGORY_TREE = {
    "Digital Banking Fraud": ["Unauthorized UPI Transaction", "Phishing / Vishing Link", "SIM Clone Fraud"],
    "ATM/Debit Card Issues": ["Cash Not Dispensed but Debited", "Card Trapped in Machine", "Unauthorized ATM Withdrawal"],
    "Credit Card Complaints": ["Excessive Annual Fees Charged", "Billing Discrepancies", "Unsolicited Card Issuance"],
    "Loan & EMI Disputes": ["Delay in Loan Sanction", "Incorrect Interest Rate Applied", "Non-closure of Loan Account"],
    "Account Operations": ["Delay in Account Activation", "Failure to Update KYC", "Unauthorized Account Freeze"],
    "Internet Banking": ["Login / OTP Failure", "Funds Transferred to Wrong Account", "Portal Unavailable / Slow"],
    "Mobile Banking": ["App Crash / Login Error", "Mobile Wallet Transfer Issue", "Biometric Authentication Failure"],
    "Mis-selling of Insurance": ["Insurance Bundled with Loan", "Premium Charged without Consent", "False Promises of High Returns"],
    "Pension Complaints": ["Non-disbursal of Pension", "Incorrect Pension Calculation", "Delay in Pension Account Transfer"],
    "Foreign Exchange": ["Delay in Inward Remittance", "Discrepancy in Exchange Rate Applied", "Forex Card Activation Issues"],
    "NRI Services": ["NRE/NRO Account Opening Delay", "Remittance Processing Issue", "NRI KYC Verification Delay"],
    "Other": ["Impolite Staff Behaviour", "Long Wait Times at Branch", "Inadequate Infrastructure at Branch"],
}

# --- fixed values: keyword rules, first match wins -------------------------------------
KEYWORD_RULES = [
    ("Digital Banking Fraud", ["upi", "fraud", "phishing"]),
    ("ATM/Debit Card Issues", ["atm", "cash"]),
    ("Credit Card Complaints", ["credit card", "annual fee"]),
    ("Loan & EMI Disputes", ["loan", "emi"]),
    ("Account Operations", ["kyc", "freeze"]),
]
KEYWORD_DEFAULT = "Other"

QUESTION_ROUTES = [
    ("growth", ["growth", "highest"]),
    ("fraud_states", ["fraud", "digital"]),
]
QUESTION_DEFAULT = "flags"

# --- fixed values: text formats --------------------------------------------------------
# ``{name}`` marks a column; see functions.columns.fill_template.
FLAG_TYPES = {
    "delay": "Supervisory Delay Alert",
    "escalation": "High Escalation Rate Alert",
    "spike": "Complaint Spike Warning",
}
FLAG_TEXTS = {
    "delay": "Average resolution days reached {avg_days} days, exceeding supervision SLA (60 days).",
    "escalation": "Complaint escalation rate is {escalation_pct}%, indicating inadequate internal grievance redressal.",
    "spike": "QoQ complaints volume spiked by {growth_pct}% ({total} total). Investigation recommended.",
}
SUMMARY_TEXT = (
    "In {month_name} {year}, {bank_name} ({bank_type}) received a total of "
    "{total_complaints} consumer complaints. Out of these, {resolved_count} were "
    "resolved (resolution rate of {res_rate}%), {pending_count} remain pending, and "
    "{escalated_count} were escalated. "
    "The average resolution time for resolved complaints was {avg_resolution_days} days. "
    "The month-over-month complaint volume growth for this bank was {complaint_growth_pct}%."
)
FLAG_NARRATIVE_TEXT = (
    "Regulatory Alert: In {year} Quarter {quarter}, {bank_name} was flagged for "
    "'{flag_type}' with {severity} severity. Description: {flag_description}"
)
MISSING_NUMBER = "nan"  # how a missing average reads inside a narrative

WELCH_TEXTS = {
    True: "Reject Null Hypothesis: {first} banks take significantly longer to resolve "
          "complaints than {second} banks (p-value < {alpha}).",
    False: "Fail to Reject Null Hypothesis: There is no statistically significant difference in "
           "resolution speed between {pair} banks (p-value >= {alpha}).",
}
TREND_LABELS = {
    "up": "Statistically Significant Upward Trend",
    "down": "Statistically Significant Downward Trend",
    "none": "No Statistically Significant Trend",
    "short": "Insufficient Data",
}
TREND_TEXT = (
    "The Mann-Kendall test confirms a {trend_lower} "
    "in {series} monthly counts (Tau = {tau_3}, p-value = {p_6})."
)
TREND_SHORT_TEXT = "Insufficient data to establish monthly trend."

# Lines of the answer routes, forecast status, label of the total row.
ROUTE_LINES = {
    "growth": "- In year {year} month {month}, {bank_name} had {total_complaints} complaints, "
              "growing by {complaint_growth_pct}% MoM.",
    "fraud_states": "- {state} recorded {complaint_count} digital fraud complaints.",
    "flags": "- {bank_name} flagged for '{flag_type}' ({severity} severity): {flag_description}",
}
FORECAST_STATUS = {"fitted": "Success", "fallback": "Fallback (Moving Average)"}
SUMMARY_ROW_LABEL = "Total / System Average"

# Own wording.
ANSWER_HEADER = "Answer assembled from stored narratives."
ANSWER_INTRO = "{header}\nThe {k} narratives nearest to '{question}':\n\n"
ANSWER_CLOSING = "\n\nCompare these with the monthly tables before acting on them."
