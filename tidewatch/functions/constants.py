"""Rules, thresholds, names and texts that define the results."""

# Exact names of a timestamp column, lower case.
TIMESTAMP_NAMES = ("timestamp", "time", "datetime", "date", "ts")

# Substrings that mark a timestamp column, lower case.
TIMESTAMP_HINTS = ("timestamp", "time", "date", "datetime", "created_at")

# Substrings that give a numeric column its metric; the first metric in this order wins.
METRIC_PATTERNS = {
    "heart_rate": ("heart", "hr", "bpm", "pulse"),
    "steps": ("step", "walk", "distance"),
    "calories": ("calorie", "energy", "burn"),
    "sleep": ("sleep", "rest", "bedtime"),
    "activity": ("activity", "active", "move"),
}

# Plausible ranges (column, lowest, highest, issue text).
VALIDATION_RULES = (
    ("heart_rate", 30.0, 220.0, "heart_rate outside plausible range (30-220)"),
    ("steps", 0.0, None, "negative steps"),
)

# Threshold rules (metric, value name in the reason, low, high, consecutive rows).
THRESHOLD_RULES = (
    ("heart_rate", "heart_rate", 40, 120, 10),
    ("steps", "step_count", 0, 1000, 5),
    ("sleep", "duration_minutes", 180, 720, 0),
)

# Residual cut in standard deviations per metric, and for any other metric.
RESIDUAL_CUTS = {"heart_rate": 2.5, "steps": 3.0, "calories": 3.0, "sleep": 2.8, "activity": 3.2}
RESIDUAL_CUT_DEFAULT = 3.0

# Upper ends of the Low and Medium severity bands.
SEVERITY_BANDS = {"heart_rate": (2.5, 3.5)}
SEVERITY_BANDS_DEFAULT = (3.0, 4.5)

# Feature relevance by substring of the feature name, first match wins.
RELEVANCE = (
    (("trend", "slope", "linear"), "Trend Pattern"),
    (("energy", "entropy", "complexity"), "Activity Level"),
    (("autocorrelation", "recurrence"), "Rhythm Pattern"),
    (("quantile", "skewness", "kurtosis"), "Distribution Shape"),
    (("mean", "median", "std"), "Central Tendency"),
    (("peak", "fft"), "Spectral Pattern"),
)
RELEVANCE_DEFAULT = "General Pattern"

# Clustering quality bands (name, silhouette above, Davies-Bouldin below).
QUALITY_BANDS = (("Excellent", 0.6, 0.8), ("Good", 0.4, 1.2), ("Fair", 0.2, 2.0))
QUALITY_DEFAULT = "Poor"

# Cluster interpretation by upper end of the overall mean.
INTERPRETATION = {
    "heart_rate": (
        (60.0, "Low resting heart rate pattern"),
        (70.0, "Normal heart rate pattern"),
        (80.0, "Elevated heart rate pattern"),
        (None, "High heart rate pattern"),
    ),
    "steps": (
        (5000.0, "Sedentary activity pattern"),
        (10000.0, "Moderate activity pattern"),
        (None, "Active lifestyle pattern"),
    ),
}

# Reason codes of flag columns, in output order.
REASON_CODES = (
    ("flag_threshold_hr", "thr_hr"),
    ("flag_threshold_steps", "thr_steps"),
    ("flag_threshold_sleep", "thr_sleep"),
    ("flag_trend_hr", "pr_hr"),
    ("flag_trend_steps", "pr_steps"),
    ("flag_trend_sleep", "pr_sleep"),
    ("flag_cluster", "cluster_multi"),
)

# Fixed value: reason text of a residual anomaly.
RESIDUAL_REASON = "Deviates from predicted trend"
