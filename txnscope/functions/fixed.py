"""Fixed values.

These values must equal those of the analytics being reproduced for the outputs
to agree; they are stated here once, in their natural order.
"""

# --- Fixed values: platform names and market constants --------------------------
OWN_PLATFORM = "PhonePe"
OWN_PERFORMANCE_LABEL = "PhonePe Performance"
COMPETITORS = ("Google Pay", "Paytm")
# monthly-volume competitor factors (market position report)
MARKET_POSITION_FACTORS = {"Google Pay": 0.75, "Paytm": 0.15}
# competitive landscape: (transactions, value, avg ticket, success rate) factors
LANDSCAPE_FACTORS = {"Google Pay": (0.77, 0.77, 0.95, 0.98),
                     "Paytm": (0.15, 0.15, 0.85, 0.96)}
MARKET_SHARE_ESTIMATES = {"PhonePe": 46.46, "Google Pay": 35.56, "Paytm": 6.90}
OTHER_SHARE_ESTIMATE = 11.08

# --- Fixed values: transaction vocabulary ---------------------------------------
SUCCESS = "SUCCESS"
P2P, P2M = "P2P", "P2M"
YOUNG_AGE_GROUPS = ("18-25", "26-35")
ANDROID = "Android"

# --- Fixed values: model feature order -------------------------------------------
CATEGORICAL_COLUMNS = ("transaction_type", "merchant_category", "sender_age_group",
                       "sender_state", "sender_bank", "receiver_bank", "device_type",
                       "network_type")
FEATURE_COLUMNS = ("amount_log", "amount_zscore", "hour", "day_of_week", "is_weekend",
                   "is_night", "transaction_type_encoded", "merchant_category_encoded",
                   "sender_age_group_encoded", "sender_state_encoded",
                   "device_type_encoded", "network_type_encoded", "cross_state",
                   "high_value")

# --- Fixed values: model settings -------------------------------------------------
SEED = 42
N_TREES = 200
RF_MAX_DEPTH = 10
IFOREST_CONTAMINATION = 0.002
IFOREST_MAX_SAMPLES = 256
DBSCAN_EPS = 0.5
DBSCAN_MIN_SAMPLES = 5
TEST_FRACTION = 0.3
FRAUD_THRESHOLD = 0.05
ENSEMBLE_WEIGHTS = {"iso": 0.3, "rf": 0.5, "dbscan": 0.2}
GRAPH_BLEND = 0.2
RISK_BINS = (0.0, 0.2, 0.5, 0.8, 1.0)
RISK_LABELS = ("Low", "Medium", "High", "Critical")

# --- Fixed values: network view and pattern messages ------------------------------
FRAUD_EDGE = {"color": "red", "width": 2.5, "alpha": 1.0}
PLAIN_EDGE = {"color": "lightgray", "width": 0.5, "alpha": 0.3}
RISKY_HOURS_MESSAGE = "High fraud risk during hours: ["
HIGH_AMOUNT_MESSAGE = "High-value transactions (>₹%.0f) show elevated fraud risk"
RISKY_STATES_MESSAGE = "States with elevated fraud risk: "
