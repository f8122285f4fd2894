"""Fixed values. They define the results of the operators, so they are stated once, here, as plain text."""

# --- columns ---------------------------------------------------------------------------------------------------
SENSOR_COLUMNS = ["temperature", "humidity", "pressure", "gas_resistance"]
PROFILE_COLUMNS = ["temperature", "humidity", "pressure", "gas_resistance", "iaq_score"]
ROLLING_COLUMNS = ["temperature", "humidity", "iaq_score"]
SILVER_FEATURES = [
    "temperature", "humidity", "pressure", "gas_resistance", "iaq_score",
    "hour_of_day", "day_of_week", "is_weekend", "temp_humidity_ratio", "gas_pressure_ratio",
    "temperature_rolling_mean", "temperature_rolling_std", "humidity_rolling_mean", "humidity_rolling_std",
    "iaq_score_rolling_mean", "iaq_score_rolling_std",
]
PARTITION_COLUMNS = ["year", "month", "day", "hour"]
ALERT_COLUMNS = ["timestamp", "device_id", "temperature", "humidity", "iaq_score", "anomaly_score"]

# --- validation ------------------------------------------------------------------------------------------------
VALID_RANGES = {
    "temperature": (0.0, 85.0),
    "humidity": (0.0, 100.0),
    "pressure": (800.0, 1200.0),
    "gas_resistance": (100.0, 500000.0),
}
LOW_QUALITY_RATIO = 0.8

# --- air quality index, table version ---------------------------------------------------------------------------
IAQ_COMFORT_LOW = 30.0
IAQ_COMFORT_HIGH = 60.0
IAQ_POINTS_PER_HUMIDITY = 5.0
IAQ_GAS_POINTS = 300.0
IAQ_MAX = 500.0
GAS_BASELINE_QUANTILE = 0.75
GAS_BASELINE_MIN_ROWS = 10
GAS_BASELINE_FALLBACK = 80000.0

# --- air quality index, per-reading version ---------------------------------------------------------------------
IAQ2_HUMIDITY_CENTRE = 40.0
IAQ2_WEIGHT_ABOVE = 0.25
IAQ2_WEIGHT_BELOW = 0.75
IAQ2_GAS_FLOOR = 10000.0
IAQ2_GAS_CEILING = 250000.0
IAQ2_GAS_WEIGHT = 0.75
AIR_LABELS = [
    (50, "Excellent"),
    (100, "Good"),
    (150, "Lightly Polluted"),
    (200, "Moderately Polluted"),
    (300, "Heavily Polluted"),
]
AIR_LABEL_WORST = "Severely Polluted"

# --- decision score bands (codes are this project's own) ---------------------------------------------------------
SCORE_BANDS = [(0.0, "deep_normal"), (-0.05, "near_boundary"), (-0.10, "anomalous"), (-0.20, "severe")]
SCORE_BAND_LAST = "extreme"

# --- scorer input keys and factor thresholds ----------------------------------------------------------------------
FIELD_ALIASES = {"temperature": "T", "humidity": "H", "pressure": "P", "gas_resistance": "G"}
TEMP_CRITICAL = 35.0
TEMP_HIGH = 33.0
TEMP_LOW = 20.0
HUMIDITY_HIGH = 75.0
HUMIDITY_LOW = 30.0
GAS_VERY_LOW = 20000.0
GAS_LOW = 50000.0
GAS_HIGH = 150000.0
STORM_PRESSURE = 1005.0

# --- labels --------------------------------------------------------------------------------------------------------
LABEL_LIMITS = {
    "iaq_score_max": 150.0,
    "temperature_max": 33.0,
    "temperature_min": 28.0,
    "humidity_max": 70.0,
    "humidity_min": 60.0,
}
PREVIEW_LABEL_LIMITS = {
    "iaq_score_max": 150.0,
    "temperature_max": 32.0,
    "temperature_min": 29.5,
    "humidity_max": 68.0,
    "humidity_min": 62.0,
}
RATE_HIGH = 0.20
RATE_LOW = 0.01

# --- training ------------------------------------------------------------------------------------------------------
SEED = 42
TEST_SHARE = 0.2
N_TREES = 100
SUBSAMPLE = 256
CONTAMINATION_RANGE = (0.01, 0.50)
EULER_GAMMA = 0.5772156649015329
GATE_LIMITS = {"roc_auc": 0.75, "precision": 0.60, "recall": 0.50}
MIN_TEST_ANOMALIES = 5
MIN_EVAL_ANOMALIES = 10

# --- rolling features -------------------------------------------------------------------------------------------------
ROLLING_ROWS = 10
RATIO_EPSILON = 1e-6

# --- drift ---------------------------------------------------------------------------------------------------------
DRIFT_BINS = 20
PSI_EPSILON = 1e-6
KL_EPSILON = 1e-8
PSI_LIMIT = 0.20
KL_LIMIT = 0.15
KS_PVALUE_LIMIT = 0.05
# Up to so many rows on either side the exact law of the two-sample statistic is used, the limit law above.
KS_EXACT_ROWS = 10_000
KS_VIOLATION_LIMIT = 2
MIN_PRODUCTION_ROWS = 500
MIN_FEATURE_ROWS = 10
REFERENCE_DAYS = (1, 30)
PRODUCTION_DAYS = (0, 6)
TRAINING_DAYS = (0, 6)
EVALUATION_DAYS = (1, 7)
SUMMARY_PROBS = [0.05, 0.25, 0.5, 0.75, 0.95]
PROFILE_PROBS = [0.02, 0.98]
SCORE_PROBS = [0.5, 0.95, 0.99]

# --- look-back ---------------------------------------------------------------------------------------------------
DEFAULT_LOOKBACK_HOURS = 2
MAX_LOOKBACK_HOURS = 720
ALERT_LIMIT = 5

# --- comparison --------------------------------------------------------------------------------------------------
COMPARED_METRICS = ["roc_auc", "precision", "recall", "f1", "accuracy"]
SCORE_WEIGHTS = {"recall": 0.40, "roc_auc": 0.35, "precision": 0.15, "f1": 0.10}
