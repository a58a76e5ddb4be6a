"""Quality of aggregates: validation, anomalies, completeness, timeliness, score."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import rules

FIELDS = ("user_id", "data_type", "count", "min_value", "max_value", "avg_value", "sum_value", "stddev_value", "record_count", "window_start", "window_end", "updated_at")


def finite(c: Column) -> Column:
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))


def validate_aggregates(df: DataFrame, ranges: DataFrame | None = None, anomalies: DataFrame | None = None) -> DataFrame:
    """``df`` with ``fault`` (first failure or null) and ``has_anomaly``. Rule tables are small DataFrames."""
    spark = df.sparkSession
    ranges = ranges if ranges is not None else rules.ranges(spark, "aggregate")
    anomalies = anomalies if anomalies is not None else rules.anomaly_limits(spark)
    rows = df.join(F.broadcast(ranges.withColumnsRenamed({"data_type": "__t", "low": "__low", "high": "__high"})), F.col("data_type") == F.col("__t"), "left")
    rows = rows.join(F.broadcast(anomalies.withColumnRenamed("data_type", "__a")), F.col("data_type") == F.col("__a"), "left")
    slack = F.abs("avg_value") * 1e-9
    is_true = lambda c: F.coalesce(c, F.lit(False))
    fault = (
        F.when(~is_true((F.col("count") > 0) & (F.col("record_count") > 0)), "no_records")
        .when(~(finite(F.col("min_value")) & finite(F.col("max_value"))), "not_finite")
        .when(is_true((F.col("min_value") < F.col("__low")) | (F.col("max_value") > F.col("__high")) | (F.col("min_value") > F.col("__high")) | (F.col("max_value") < F.col("__low"))), "out_of_range")
        .when(~is_true((F.col("min_value") <= F.col("avg_value") + slack) & (F.col("avg_value") - slack <= F.col("max_value")) & (F.col("stddev_value") >= 0)), "inconsistent")
    )
    anomaly = (
        is_true((F.col("avg_value") > F.col("avg_high")) | (F.col("avg_value") < F.col("avg_low")))
        | is_true(F.col("max_value") - F.col("min_value") > F.col("max_range"))
        | is_true((F.col("stddev_value") == 0) & (F.col("count") > 1))
        | is_true((F.col("stddev_value") > 0) & (F.col("avg_value") > 0) & (F.col("stddev_value") > F.col("avg_value")))
    )
    return rows.withColumns({"fault": fault, "has_anomaly": anomaly}).drop("__t", "__low", "__high", "__a", "avg_low", "avg_high", "max_range")


def validate_simple(df: DataFrame) -> DataFrame:
    """The simpler validator: count, finite fields, order of min, avg and max, ranges of four types."""
    ranges = F.broadcast(rules.ranges(df.sparkSession, "simple").withColumnsRenamed({"data_type": "__t", "low": "__low", "high": "__high"}))
    rows = df.join(ranges, F.col("data_type") == F.col("__t"), "left")
    slack = F.abs("avg_value") * 1e-9
    good = (F.col("count") > 0) & (F.col("min_value") <= F.col("max_value")) & (F.col("min_value") <= F.col("avg_value") + slack) & (F.col("avg_value") - slack <= F.col("max_value"))
    for c in ("min_value", "max_value", "avg_value", "sum_value", "stddev_value"):
        good = good & (F.col(c).isNull() | finite(F.col(c)))
    good = good & F.coalesce((F.col("min_value") >= F.col("__low")) & (F.col("max_value") <= F.col("__high")), F.lit(True))
    return rows.withColumn("valid", F.coalesce(good, F.lit(False))).drop("__t", "__low", "__high")


def completeness(columns: list[str], fields: tuple[str, ...] = FIELDS) -> Column:
    there = [F.col(c).isNotNull().cast("int") if c in columns else F.lit(0) for c in fields]
    return sum(there[1:], there[0]) / len(fields)


def completeness_map(columns: list[str], fields: tuple[str, ...] = FIELDS) -> Column:
    return F.create_map(*[x for c in fields for x in (F.lit(c), F.col(c).isNotNull() if c in columns else F.lit(False))])


def timely(as_of_ms: Column, hours: int = 24) -> Column:
    """False where the window's end is missing or longer ago."""
    return F.coalesce(as_of_ms - F.col("window_end") <= hours * 3_600_000, F.lit(False))


def score(df: DataFrame, as_of_ms: Column) -> DataFrame:
    """``df`` (with has_anomaly) with completeness, is_timely and quality_score from 0 to 1."""
    rows = df.withColumns({"completeness": completeness(df.columns), "is_timely": timely(as_of_ms)})
    raw = F.col("completeness") * F.when(F.col("is_timely"), 1.0).otherwise(0.9) * F.when(F.col("has_anomaly"), 0.95).otherwise(1.0) * F.when(F.col("count") < 10, 0.9).otherwise(1.0)
    return rows.withColumn("quality_score", F.greatest(F.lit(0.0), F.least(F.lit(1.0), raw)))


def outliers(df: DataFrame) -> DataFrame:
    """Measurements beyond the documented outlier limits."""
    limits = F.broadcast(rules.ranges(df.sparkSession, "outlier"))
    return df.join(limits, "data_type").where((F.col("value") < F.col("low")) | (F.col("value") > F.col("high")))


def alerts(metrics: DataFrame, limits: dict[str, float] = rules.ALERT_LIMITS) -> DataFrame:
    """(window_start, alert, value) of metric rows (window_start, metric, value) beyond their limits; throughput alerts below its own."""
    table = rules.small_table(metrics.sparkSession, "metric, limit_value", list(limits.items()))
    rows = metrics.join(F.broadcast(table), "metric")
    beyond = F.when(F.col("metric") == "throughput", F.col("value") < F.col("limit_value")).otherwise(F.col("value") > F.col("limit_value"))
    return rows.where(beyond).select("window_start", F.col("metric").alias("alert"), "value")
