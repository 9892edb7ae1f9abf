"""Fixed values of the data model: column lists, ranges and thresholds."""

# Sensor columns in processing order.
SENSORS = [
    "consumption_kWh",
    "temperature_C",
    "vibration",
    "pressure",
    "cycle_duration",
    "rpm",
    "voltage",
]

# The nine business columns a bronze sensor file must carry.
BUSINESS = ["timestamp", *SENSORS, "failure"]

# One sensor series is one bronze file: a machine at one target cycle.
SERIES = ["machine_id", "target_cycle"]

# Audit columns of the silver layer and their defaults.
AUDIT_DEFAULTS = {
    "is_outlier": 0,
    "outlier_columns": "",
    "quality_flag": "OK",
    "correction_details": "",
    "is_missing_timestamp": 0,
    "is_failure_nan_corrected": 0,
    "failure_nan_correction_details": "",
    "is_duplicate_corrected": 0,
    "duplicate_correction_details": "",
    "is_nan_corrected": 0,
    "nan_columns": "",
    "nan_correction_details": "",
}

# Physical limits that are reported, never enforced (None = open).
PHYSICAL_LIMITS = {
    "consumption_kWh": (0.0, None),
    "temperature_C": (-50.0, 200.0),
    "vibration": (0.0, None),
    "pressure": (0.0, None),
    "cycle_duration": (0.0, None),
    "rpm": (0.0, None),
    "voltage": (0.0, None),
}

# Limits a reading must respect to be scored; replay clamps to them.
READING_LIMITS = {
    "consumption_kWh": (0.0, 1000.0),
    "temperature_C": (-20.0, 200.0),
    "vibration": (0.0, 50.0),
    "pressure": (0.0, 200.0),
    "cycle_duration": (0.0, 300.0),
    "rpm": (0.0, 5000.0),
    "voltage": (0.0, 500.0),
}
MACHINE_ID_MIN = 1
TARGET_CYCLE_RANGE = (1, 10000)

# Text codes read as missing in bronze files.
MISSING_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]

# Decimal and exponent forms; suffixes, hexadecimal and separators are garbage.
NUMBER_PATTERN = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"

# Failure codes and labels.
FAILURE_CODES = [0, 1, 2]
FAILURE_TYPES = ["Breakage", "Overheat"]
NO_FAILURE = "none"

# Model features in order.
FEATURES = [*SENSORS, "cycle_ratio"]

ROLLED = ["temperature_C", "vibration", "pressure"]
ROLLING_ROWS = 10
OUTLIER_SIGMA = 5.0
NEIGHBOUR_RADIUS = 2
ASOF_TOLERANCE_HOURS = 1
NO_INTERVENTION_HOURS = 9999.0
EPS = 1.5
MIN_SAMPLES = 10
ALERT_THRESHOLD = 0.75
CRITICAL_FLOOR = 0.9
NOISE = -1
GLOBAL_MODEL = "global"

# Column order of the serving tables.
SENSOR_TABLE = ["machine_id", "target_cycle", "timestamp", *SENSORS, "failure"]
SNAPSHOT_TABLE = [
    *SENSOR_TABLE,
    *[f"{c}_{s}" for c in ROLLED for s in ("roll_mean_10", "roll_std_10", "delta")],
    "load_proxy",
    "energy_per_cycle",
    "hours_since_last_intervention",
    "failure_type",
]
PREDICTION_TABLE = [
    "recorded_at", "machine_id", "model_version", "cluster_label",
    "anomaly", "anomaly_score", "alert", "alert_level",
]

# Histogram bounds (seconds) of the latency metric.
LATENCY_BOUNDS = [
    0.005, 0.01, 0.025, 0.05, 0.075, 0.1, 0.25, 0.5, 0.75, 1.0, 2.5, 5.0, 7.5, 10.0,
]

# Timestamps outside this span cannot be held at nanosecond precision and count
# as unparseable. It also bounds an hourly series: 5.13 million lattice points.
TIMESTAMP_MIN = "1677-09-21 00:12:44"
TIMESTAMP_MAX = "2262-04-11 23:47:16"
