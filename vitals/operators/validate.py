"""Validation of measurements and routing of bad ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..rules import RETRYABLE, SEVERITIES
from .ingest import filled

REQUIRED = ("device_id", "user_id", "sample_id", "data_type", "value", "start_date", "end_date")
MAX_DURATION_MS = 7 * 86_400_000


def _all(conditions: list[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out & c
    return out


def validate_full(df: DataFrame, ranges: DataFrame, strict: bool = False, required: tuple[str, ...] = ("user_id", "sample_id", "data_type", "value", "start_date", "end_date")) -> DataFrame:
    """``df`` with ``reject_reason`` (the first failure or null) and ``warn_long_duration``.

    Order: required fields, numeric value from 0, start not after end, range of the type. An unknown type passes unless
    ``strict``. NaN and infinities are not numeric. ``ranges`` is a small rule table (data_type, low, high).
    """
    value = F.col("value").try_cast("double")
    rows = df.join(F.broadcast(ranges.select(F.col("data_type").alias("__type"), F.col("low").alias("__low"), F.col("high").alias("__high"))), F.col("data_type") == F.col("__type"), "left")
    outside = (value < F.col("__low")) | (value > F.col("__high"))
    reason = (
        F.when(~_all([filled(F.col(c).cast("string")) for c in required]), "missing_field")
        .when(value.isNull() | F.isnan(value) | (F.abs(value) == float("inf")), "not_numeric")
        .when(value < 0, "negative_value")
        .when(F.col("start_date") > F.col("end_date"), "start_after_end")
        .when(F.col("__type").isNull() & F.lit(strict), "unknown_type")
        .when(F.coalesce(outside, F.lit(False)), "out_of_range")
    )
    return rows.withColumns({"reject_reason": reason, "warn_long_duration": F.col("end_date") - F.col("start_date") > MAX_DURATION_MS}).drop("__type", "__low", "__high")


def validate_light(df: DataFrame) -> DataFrame:
    """``df`` with ``reject_reason``: four required fields, a value from 0, start not after end (missing ones are 0)."""
    reason = (
        F.when(~_all([filled(F.col(c).cast("string")) for c in ("user_id", "sample_id", "data_type", "value")]), "missing_field")
        .when(~(F.col("value").try_cast("double") >= 0), "negative_value")
        .when(F.coalesce("start_date", F.lit(0)) > F.coalesce("end_date", F.lit(0)), "start_after_end")
    )
    return df.withColumn("reject_reason", reason)


def split(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid and rejected rows."""
    return df.where("reject_reason is null").drop("reject_reason"), df.where("reject_reason is not null")


def severity(error_type: Column) -> Column:
    out = F
    for name, level in SEVERITIES.items():
        out = out.when(error_type == name, level)
    return out.otherwise("MEDIUM")


def error_records(rejected: DataFrame, error_type: str, at_ms: Column, message: str = "reject_reason") -> DataFrame:
    """Dead-letter rows: the original row as JSON, a deterministic id, type, message, ids, severity and whether to retry."""
    raw = F.to_json(F.struct(*[c for c in rejected.columns if c != message]))
    optional = lambda name, kind: (F.col(name) if name in rejected.columns else F.lit(None)).cast(kind).alias(name)
    return rejected.select(
        F.sha2(F.concat_ws("|", F.lit(error_type), raw), 256).alias("error_id"),
        F.lit(error_type).alias("error_type"),
        F.col(message).alias("error_message"),
        at_ms.alias("error_timestamp"),
        *[optional(n, "string") for n in ("device_id", "user_id", "sample_id", "data_type")],
        raw.alias("raw_payload"),
        optional("kafka_topic", "string"),
        optional("kafka_partition", "int"),
        optional("kafka_offset", "bigint"),
        severity(F.lit(error_type)).alias("severity"),
        F.lit(error_type in RETRYABLE).alias("retryable"),
        F.coalesce(F.col("data_type") if "data_type" in rejected.columns else F.lit(None).cast("string"), F.lit("unknown")).alias("data_type_partition"),
    )


def with_error_class(df: DataFrame) -> DataFrame:
    """``df`` (error_type, data_type) with severity, retryable and data_type_partition."""
    return df.withColumns({"severity": severity(F.col("error_type")), "retryable": F.col("error_type").isin(*RETRYABLE), "data_type_partition": F.coalesce("data_type", F.lit("unknown"))})
