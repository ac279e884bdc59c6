"""Contract column names, policies and frozen parameters."""

# Canonical transaction columns, in contract order.
TX_COLUMNS = (
    "ts", "from_bank", "account", "to_bank", "counterparty",
    "amount_received", "receiving_currency", "amount_paid",
    "payment_currency", "payment_format", "is_laundering",
)

# Header of the ledger text files, same order as TX_COLUMNS.
LEDGER_HEADER = (
    "Timestamp", "From Bank", "Account", "To Bank", "Account.1",
    "Amount Received", "Receiving Currency", "Amount Paid",
    "Payment Currency", "Payment Format", "Is Laundering",
)
LEDGER_TS_FORMAT = "yyyy/MM/dd HH:mm"

TARGET = "is_laundering"
NUMERIC_CONTRACT = ("from_bank", "to_bank", "amount_received", "amount_paid")

CATEGORICAL_FEATURES = ("payment_format",)
NUMERIC_FEATURES = ("amount_paid", "sender_previous_tx_count")
BINARY_FEATURES = ("is_business_hours", "same_account")
MODEL_FEATURES = CATEGORICAL_FEATURES + NUMERIC_FEATURES + BINARY_FEATURES

# Public request names of the model features.
REQUEST_NAMES = {
    "payment_format": "Payment Format",
    "amount_paid": "Amount Paid",
    "sender_previous_tx_count": "sender_previous_tx_count",
    "is_business_hours": "is_business_hours",
    "same_account": "same_account",
}
TELEMETRY_INPUT_FIELDS = tuple(REQUEST_NAMES.values())
TELEMETRY_OUTPUT_FIELDS = ("score", "alert", "threshold", "model_version")

SEED = 42
TEST_SHARE = 0.30
UNDERSAMPLE_RATIO = 0.10
VISUAL_SAMPLE_ROWS = 50_000
ATTRIBUTION_SAMPLE_ROWS = 5_000

SERVING_THRESHOLD = 0.892163
MODEL_VERSION = "0.1.0"
PRECISION_TARGET = 0.02
PRECISION_TARGETS = (0.005, 0.01, 0.02, 0.05)
ALERT_BUDGETS = (0.001, 0.0025, 0.005, 0.01, 0.02, 0.05)

MIN_AVERAGE_PRECISION = 0.035
MIN_RECALL = 0.65
SCORE_PARITY_TOLERANCE = 1e-6

# Relative, two-sided tolerances of the regression gate.
REGRESSION_TOLERANCES = {
    "average_precision": 0.05,
    "precision": 0.05,
    "recall": 0.05,
    "f1_score": 0.10,
    "alerts": 0.10,
    "alert_rate_pct": 0.10,
    "threshold": 0.05,
}

PSI_EPSILON = 1e-6
PSI_MODERATE = 0.10
PSI_SIGNIFICANT = 0.25
PSI_BINS = 10
DRIFT_WINDOWS = 3

VELOCITY_BANDS = ("0", "1", "2-5", "6-20", "21-100", "100+")
BANK_MIN_SUPPORT = 1_000

# Monitoring traffic: every format meets every (amount, count) pair.
TRAFFIC_FORMATS = (
    "Cheque", "Credit Card", "ACH", "Cash", "Reinvestment", "Wire", "Bitcoin",
)
TRAFFIC_AMOUNTS = (
    25.0, 100.0, 350.0, 1000.0, 3000.0, 7500.0, 15000.0, 50000.0, 125000.0, 500000.0,
)
TRAFFIC_COUNTS = (0, 1, 2, 5, 10, 25, 50, 100, 250, 500)
