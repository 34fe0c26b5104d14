"""Value domains and thresholds.

FIXED VALUES — these must equal the source system's domains and the
business rules' thresholds for results to be right; they are stated here
once, in natural order, and used everywhere else by name.
"""

# ── fixed values: entity value domains ───────────────────────────────────────
SEGMENTS = ["Retail", "Premier", "Private", "SMB", "Corporate"]
PRODUCTS = ["Checking", "Savings", "Mortgage", "Auto Loan", "Credit Card",
            "Investment", "HELOC", "CD"]
ACCOUNT_STATUSES = ["Active", "Dormant", "Closed", "Suspended"]
DEBIT_TXN_TYPES = ["Purchase", "ATM Withdrawal", "Transfer", "Bill Payment",
                   "Wire Transfer", "Fee"]
CREDIT_TXN_TYPES = ["Direct Deposit", "Refund", "Interest Credit"]
CHANNELS = ["Mobile", "Web", "Branch", "ATM", "Phone", "API"]
TICKET_STATUSES = ["Open", "In Progress", "Resolved", "Closed", "Escalated"]
RESOLVED_STATUSES = ["Resolved", "Closed"]
RESOLUTIONS = ["Issue Resolved", "Credited Account", "Referred to Branch",
               "No Action Required", "Escalated to Manager",
               "Pending Customer Response"]
PRIORITIES = ["Low", "Medium", "High", "Critical"]
KYC_STATUSES = ["Verified", "Pending", "Failed"]
DIRECTIONS = ["Debit", "Credit"]
MERCHANT_CATEGORIES = ["Retail", "Grocery", "Travel", "Dining", "Healthcare",
                       "Utilities", "Entertainment"]
BRANCH_TYPES = ["Full Service", "Express", "Wealth Center"]

# ── fixed values: band tables, (exclusive upper bound, label); last = else ───
AGE_BANDS = [(30, "Gen-Z / Millennial"), (45, "Millennial / Gen-X"),
             (60, "Gen-X / Boomer"), (None, "Senior")]
INCOME_TIERS = [(50_000, "Low"), (100_000, "Mid"), (250_000, "Upper-Mid"),
                (None, "High")]
CREDIT_BANDS = [(620, "Poor"), (680, "Fair"), (740, "Good"),
                (800, "Very Good"), (None, "Exceptional")]
# dashboard inactivity bins, lower bound inclusive
INACTIVITY_BINS = [(30, "0-30"), (90, "30-90"), (180, "90-180"), (None, "180+")]

# ── fixed values: business-rule thresholds ───────────────────────────────────
CHURN_INACTIVE_DAYS = 90
CHURN_MIN_CSAT = 3.0
CHURN_MAX_ESCALATIONS = 1
HIGH_VALUE_BALANCE = 100_000
HIGH_VALUE_SEGMENTS = ["Premier", "Private"]

# SCD2 tracked columns of the customer dimension
SCD2_TRACKED = ["segment", "credit_score", "annual_income", "kyc_status",
                "address_line1", "city", "state", "zip_code"]

# churn-priority short form (analytics Q2) and detailed form (view V4)
CRITICAL_INACTIVE_DAYS = 180
LOW_CSAT = 2.5
HIGH_VALUE_AT_RISK_BALANCE = 50_000
# churn-priority labels: short form, then detailed form
PRIORITY_SHORT = ["Critical", "High", "Medium"]
PRIORITY_DETAILED = ["Critical — High Value", "Critical", "High — Service Issue",
                     "High — CSAT", "Medium — Escalations", "Medium"]
CHANNEL_ACTIONS = [("Mobile", "Push notification + app offer"),
                   ("Branch", "Relationship manager outreach"),
                   ("Phone", "Proactive call — retention offer")]
DEFAULT_ACTION = "Email campaign"

# cross-sell rule thresholds
CROSS_SELL_MIN_INCOME = 75_000
MORTGAGE_MIN_INCOME = 60_000
CARD_MIN_SCORE = 680

# dashboard traffic-light thresholds
CREDIT_CARD_GREEN, CREDIT_CARD_AMBER = 720, 660      # KPI card
CREDIT_COLOR_GREEN, CREDIT_COLOR_AMBER = 740, 670    # per-customer colour
CHURN_RED_PCT, CHURN_AMBER_PCT = 15, 10
RESOLUTION_RED_DAYS = 5
RESOLUTION_THRESHOLD_DAYS = 7
CSAT_TARGET = 4.0
