"""Fixed values that must equal the reference pipeline's for equal results.

Fixed values (rule constants, reason labels, table limits, formats), stated as text:
"""

# --- fixed values: rule constants -------------------------------------------
HIGH_VALUE_THRESHOLD = 5000.0          # strict: amount > 5000 is HIGH_VALUE
TRAVEL_WINDOW = "10 minutes"           # tumbling event-time window of the travel rule
WATERMARK = "5 minutes"                # allowed lateness on event_timestamp
BATCH_WINDOW_HOURS = 6                 # reconciliation window length

# --- fixed values: alert reasons --------------------------------------------
HIGH_VALUE = "HIGH_VALUE"
IMPOSSIBLE_TRAVEL = "IMPOSSIBLE_TRAVEL"

# --- fixed values: payload formats -------------------------------------------
EVENT_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"   # e.g. 2024-01-01T00:01:00.000Z
LOCATION_SEPARATOR = ", "                            # "City, CC" -> CC is the last token
DEFAULT_CURRENCY = "USD"

# --- fixed values: stored column limits (VARCHAR(n)) and money precision ------
VARCHAR_LIMITS = {
    "transaction_id": 64,
    "user_id": 32,
    "merchant_category": 64,
    "location": 128,
    "currency": 8,
    "fraud_reason": 32,
}
MONEY_TYPE = "decimal(12,2)"           # NUMERIC(12,2) of the stored tables
TOTAL_TYPE = "decimal(38,2)"           # sums of NUMERIC(12,2) never overflow it

# --- fixed values: reconciliation report headers, in file order ---------------
RECONCILIATION_HEADERS = [
    "Report ID",
    "Window Start",
    "Window End",
    "Total Ingress Transactions",
    "Total Ingress Amount (USD)",
    "Fraud Transactions",
    "Fraud Amount (USD)",
    "Fraud Amount %",
    "Validated Transactions",
    "Validated Amount (USD)",
    "Validated Amount %",
]

# --- tuning knobs (ours, not the reference's) --------------------------------
# A (user, window) group with more rows than this is split over several join tasks.
HOT_GROUP_ROWS = 1_000_000
# Keys in one file of the speed layer's key index.
KEYS_PER_FILE = 4_000_000
# Rows in one time slice of a large micro-batch (a task of the sinks, a file of the feed).
ROWS_PER_SLICE = 500_000
# What the travel query takes from the feed at once, per core: bounds its state.
FEED_BYTES_PER_CORE = 2 << 20
