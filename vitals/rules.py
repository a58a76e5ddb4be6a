"""Rule tables. Each is data, passed to operators as a small DataFrame, so users can bring their own."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Ranges, names and limits of the measurement model.
RECORD_RANGES = {
    "heartRate": (30, 250),
    "steps": (0, 100000),
    "distance": (0, 100000),
    "activeEnergyBurned": (0, 10000),
    "basalEnergyBurned": (0, 5000),
    "bloodPressureSystolic": (50, 250),
    "bloodPressureDiastolic": (30, 150),
    "bloodGlucose": (20, 600),
    "bodyTemperature": (30, 45),
    "oxygenSaturation": (0, 100),
    "respiratoryRate": (5, 60),
    "vo2Max": (10, 100),
    "bodyMass": (20, 500),
    "height": (50, 300),
    "bodyMassIndex": (10, 100),
    "bodyFatPercentage": (0, 100),
    "leanBodyMass": (10, 300),
    "waistCircumference": (30, 300),
    "sleepAnalysis": (0, 24),
    "mindfulSession": (0, 24),
}
GATEWAY_RANGES = {
    "heartRate": (0, 250),
    "restingHeartRate": (0, 150),
    "bloodPressureSystolic": (0, 250),
    "bloodPressureDiastolic": (0, 150),
    "oxygenSaturation": (0, 100),
    "bodyTemperature": (0, 42),
    "bloodGlucose": (0, 600),
    "bodyMass": (0, 1000),
    "height": (0, 1000),
    "bodyMassIndex": (0, 60),
    "bodyFatPercentage": (0, 100),
}
AGGREGATE_RANGES = {
    "heartRate": (30, 250),
    "steps": (0, 100000),
    "bloodPressureSystolic": (70, 200),
    "bloodPressureDiastolic": (40, 130),
    "bloodGlucose": (50, 400),
    "bodyTemperature": (35, 42),
    "oxygenSaturation": (70, 100),
}
SIMPLE_AGGREGATE_RANGES = {k: AGGREGATE_RANGES[k] for k in ("heartRate", "steps", "bloodPressureSystolic", "bloodGlucose")}
#: Outlier limits of single values: below, above.
OUTLIER_LIMITS = {"heartRate": (40, 200), "steps": (None, 50000), "sleepAnalysis": (2, 16), "bloodPressureSystolic": (None, 180), "bloodPressureDiastolic": (None, 120)}
#: Anomaly limits of averages, and of the range of a window.
ANOMALY_LIMITS = {"heartRate": (40, 180, 100), "steps": (None, 50000, None), "bloodPressureSystolic": (90, 160, None)}
DATA_TYPES = (
    "height", "bodyMass", "bodyMassIndex", "bodyFatPercentage", "leanBodyMass", "waistCircumference", "stepCount", "distanceWalkingRunning", "flightsClimbed",
    "activeEnergyBurned", "basalEnergyBurned", "exerciseTime", "standHours", "heartRate", "restingHeartRate", "heartRateVariability", "bloodPressureSystolic",
    "bloodPressureDiastolic", "oxygenSaturation", "sleepAnalysis", "timeInBed", "dietaryEnergy", "dietaryProtein", "dietaryCarbohydrates", "dietaryFat",
    "dietaryFiber", "dietarySugar", "dietaryWater", "respiratoryRate", "vo2Max", "bloodGlucose", "bodyTemperature", "mindfulMinutes",
)
ALIASES = {"stepCount": "steps", "mindfulMinutes": "mindfulSession", "distanceWalkingRunning": "distance"}
LOCALE_ZONES = {"ko_KR": "Asia/Seoul", "en_US": "America/New_York", "ja_JP": "Asia/Tokyo", "zh_CN": "Asia/Shanghai"}
SEVERITIES = {"VALIDATION_ERROR": "LOW", "TRANSFORMATION_ERROR": "MEDIUM", "DESERIALIZATION_ERROR": "HIGH", "PROCESSING_ERROR": "HIGH", "UNKNOWN_ERROR": "CRITICAL"}
RETRYABLE = ("PROCESSING_ERROR", "DESERIALIZATION_ERROR")
SENSITIVE_FIELDS = ("password", "passwd", "pwd", "secret", "secret_key", "secret-key", "token", "access_token", "refresh_token", "api_key", "api-key", "apikey", "access_key", "access-key", "s3_secret_key", "s3-secret-key")
ALERT_LIMITS = {"error_rate": 10.0, "failure_share": 0.1, "p95_latency_ms": 10000.0, "throughput": 100.0, "write_failures": 5.0, "window_latency_ms": 300000.0}

PROFILES = {"record": RECORD_RANGES, "gateway": GATEWAY_RANGES, "aggregate": AGGREGATE_RANGES, "simple": SIMPLE_AGGREGATE_RANGES, "outlier": OUTLIER_LIMITS}


def small_table(spark: SparkSession, names: str, rows: list[tuple]) -> DataFrame:
    """A rule table as a relation of the plan itself, so that no Python worker makes it. Values are texts, numbers or null."""
    literal = lambda x: "CAST(NULL AS DOUBLE)" if x is None else "'" + x.replace("\\", "\\\\").replace("'", "\\'") + "'" if isinstance(x, str) else f"{float(x)!r}D"
    return spark.sql(f"SELECT * FROM VALUES {', '.join('(' + ', '.join(map(literal, row)) + ')' for row in rows)} AS t({names})")


def ranges(spark: SparkSession, profile: str) -> DataFrame:
    """(data_type, low, high) of a named profile."""
    return small_table(spark, "data_type, low, high", [(t, lo, hi) for t, (lo, hi) in PROFILES[profile].items()])


def anomaly_limits(spark: SparkSession) -> DataFrame:
    return small_table(spark, "data_type, avg_low, avg_high, max_range", [(t, *v) for t, v in ANOMALY_LIMITS.items()])
