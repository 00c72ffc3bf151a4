"""Default parameter values. Operators take all of these as arguments."""

# Label vocabulary, in the order that decides ties and first matches.
TICKET_CATEGORIES = (
    "Hardware",
    "Software",
    "Network",
    "Access_Account",
    "Password_Reset",
    "Email",
    "Security_Phishing",
    "Printer",
)

# Ingestion contract.
MIN_TEXT_LENGTH = 5
PRIORITY_SENTINEL = "UNSET"

# Monitor windows and thresholds.
ROLLING_DAYS = 7
LABEL_DELAY_DAYS = 5
CLIP_EPSILON = 1e-4
PSI_WATCH = 0.10
PSI_ALERT = 0.25
NOISE_BAND_STDS = 2.0
ISSUE_RATE_ALERT = 0.05
SKEW_GAP_ALERT = 0.05
SERVING_MAX_CHARS = 60

# Alert type of each issue rate, and whether the issue keeps rows from the model.
RATE_ALERTS = {
    "null_text_rate": ("null_or_empty_text", True),
    "sentinel_rate": ("silent_default_priority", False),
    "enum_rate": ("schema_violation_source_system", False),
}
# What raises the priority of an incident.
PRIORITY_LADDER = {
    "skew_high": 0.15,
    "blocking_high": 0.10, "blocking_long": 14, "blocking_low": 0.03,
    "metadata_high": 0.25, "metadata_long": 21, "metadata_low": 0.10,
    "drift_high": 0.4, "drift_long": 14,
}

# Text noise. A repeated empty string is a weight, not a slip.
NOISE_PREFIXES = (
    "", "", "", "Hi team, ", "Hey, ", "Urgent - ", "Following up again - ",
    "Not sure who to ask, but ", "Quick question, ",
)
NOISE_SUFFIXES = (
    "", "", "", " Please advise.", " This is blocking my work.",
    " Thanks in advance.", " Let me know what you need from me.",
    " This has been going on for a couple days now.",
)
TYPO_SWAPS = (("the", "teh"), ("issue", "isue"), ("connect", "conect"), ("password", "passowrd"))
TYPO_RATE = 0.12

# Hyper-parameter grid and early stopping.
SEARCH_AXES = {"rank": (8, 16, 32), "learning_rate": (1e-4, 2e-4, 3e-4), "epochs": (2, 3, 4)}
# Grid of the bag-of-words classifier.
CLASSIFIER_AXES = {"smoothing": (0.1, 1.0, 10.0), "n_features": (1 << 12, 1 << 16)}
PATIENCE = 3
MIN_DELTA = 0.005

# Dataset split and training arrays.
TRAIN_SHARE = 0.7
VAL_SHARE = 0.15
ROWS_PER_LABEL = 90
MAX_TOKENS = 512
BATCH_SIZE = 8
IGNORED_LABEL_ID = -100
