"""Declared schemas of payloads, measurements, errors and aggregates, as DDL."""

from __future__ import annotations

SAMPLE = "id:string, type:string, value:string, unit:string, startDate:string, endDate:string, createdAt:string, sourceBundle:string, metadata:map<string,string>, isSynced:boolean, timezone:string, timezoneOffset:int"
PAYLOAD = f"deviceId string, userId string, timestamp string, appVersion string, samples array<struct<{SAMPLE}>>"
MEASUREMENT = (
    "device_id string, user_id string, sample_id string, data_type string, value double, unit string, start_date bigint, end_date bigint, source_bundle string, metadata map<string,string>, "
    "is_synced boolean, created_at bigint, payload_timestamp bigint, app_version string, processing_time bigint, timezone string, timezone_offset int"
)
ERROR = (
    "error_id string, error_type string, error_message string, error_timestamp bigint, device_id string, user_id string, sample_id string, data_type string, raw_payload string, "
    "kafka_topic string, kafka_partition int, kafka_offset bigint, severity string, retryable boolean, data_type_partition string"
)
_STATISTICS = "window_start bigint, window_end bigint, min_value double, max_value double, avg_value double, sum_value double, count bigint, stddev_value double, first_value double, last_value double, record_count bigint, timezone string, updated_at bigint"
DAILY = f"user_id string, data_type string, aggregation_date date, {_STATISTICS}"
WEEKLY = f"user_id string, data_type string, year int, week_of_year int, week_start_date date, week_end_date date, {_STATISTICS}, daily_avg_of_avg double"
MONTHLY = f"user_id string, data_type string, year int, month int, month_start_date date, month_end_date date, days_in_month int, {_STATISTICS}, daily_avg_of_avg double"
KEYS = {"daily": ["user_id", "data_type", "aggregation_date"], "weekly": ["user_id", "data_type", "year", "week_of_year"], "monthly": ["user_id", "data_type", "year", "month"]}
