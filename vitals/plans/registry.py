"""Queries by their inventory id, with DuckDB SQL for the same rows."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import rules
from ..functions import masking, times
from ..operators import aggregate, analytics, ingest, metrics, quality, query_api, validate
from ..sources import payloads as wire
from ..sources import tables
from ..streaming import calendar, job
from . import views as v

#: Whose aggregates the parameterised queries ask for.
USER, BUYER = 0, 8
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# Common table expressions of the SQL.
SAMPLES = """samples AS (
  SELECT event_id AS sample_id, user_id, value, ts AS start_ts, epoch_us(ts) // 1000 AS start_date, epoch_us(ts) // 1000 + event_id % 600 * 1000 AS end_date, props,
    CASE event_type WHEN 'view' THEN 'heartRate' WHEN 'click' THEN 'steps' WHEN 'purchase' THEN 'bloodGlucose' WHEN 'signup' THEN 'oxygenSaturation' ELSE 'bodyTemperature' END AS data_type,
    CASE user_id % 4 WHEN 0 THEN 'Asia/Seoul' WHEN 1 THEN 'America/New_York' WHEN 2 THEN 'Europe/London' ELSE 'UTC' END AS timezone
  FROM events)"""
PURCHASES = "purchases AS (SELECT o_orderkey AS sample_id, o_custkey AS user_id, o_orderpriority AS data_type, o_totalprice AS value, o_orderdate AS start_ts FROM orders)"
STATS = "count(value) AS count, sum(value) AS sum_value, min(value) AS min_value, max(value) AS max_value, avg(value) AS avg_value, stddev_pop(value) AS stddev_value, first(value ORDER BY start_ts, sample_id) AS first_value, last(value ORDER BY start_ts, sample_id) AS last_value, count(*) AS record_count"
LOCAL = "((start_ts AT TIME ZONE 'UTC') AT TIME ZONE timezone)"
DAILY = f"daily AS (SELECT user_id, data_type, timezone, CAST({LOCAL} AS DATE) AS aggregation_date, {STATS} FROM samples GROUP BY 1, 2, 3, 4)"
WEEKLY = f"weekly AS (SELECT user_id, data_type, timezone, CAST(date_trunc('week', {LOCAL}) AS DATE) AS week_start_date, {STATS} FROM samples GROUP BY 1, 2, 3, 4)"
MONTHLY = f"monthly AS (SELECT user_id, data_type, CAST(year(start_ts) AS INTEGER) AS year, CAST(month(start_ts) AS INTEGER) AS month, {STATS} FROM purchases GROUP BY 1, 2, 3, 4)"
ROUNDED = "count, round(sum_value, 7) AS sum_value, min_value, max_value, round(avg_value, 7) AS avg_value, round(stddev_value, 4) AS stddev_value, first_value, last_value, record_count"
_WITH = {"samples": SAMPLES, "daily": f"{SAMPLES},\n{DAILY}", "weekly": f"{SAMPLES},\n{WEEKLY}", "monthly": f"{PURCHASES},\n{MONTHLY}", "purchases": PURCHASES, "both": f"{SAMPLES},\n{DAILY},\n{WEEKLY}"}


def rounded(df: DataFrame, *more: str) -> DataFrame:
    # 7 places: sums of two-place values over up to 63 rows are no ties there
    return df.withColumns({c: F.round(c, 4 if c == "stddev_value" else 7) for c in (*more, "sum_value", "avg_value", "stddev_value") if c in df.columns})


def query(name: str, sql: str | None = None, base: str | None = None):
    def add(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = (f"WITH {_WITH[base]}\n" if base else "") + sql
        return f

    return add


RANGE_CASE = "CASE data_type " + " ".join(f"WHEN '{t}' THEN value < {lo} OR value > {hi}" for t, (lo, hi) in rules.RECORD_RANGES.items()) + " ELSE false END"
REASON = f"CASE WHEN value < 0 THEN 'negative_value' WHEN start_date > end_date THEN 'start_after_end' WHEN {RANGE_CASE} THEN 'out_of_range' END"
CHECKED = f"checked AS (SELECT *, {REASON} AS reject_reason FROM samples)"
_WITH["checked"] = f"{SAMPLES},\n{CHECKED}"


def checked(spark: SparkSession, sf: str) -> DataFrame:
    return validate.validate_full(v.samples(spark, sf), rules.ranges(spark, "record"))


# Ingest and validation


@query("f1_flatten", "SELECT 'device-' || user_id AS device_id, CAST(user_id AS VARCHAR) AS user_id, CAST(sample_id AS VARCHAR) AS sample_id, data_type, value, 'count' AS unit, start_date, end_date, timezone, 'ko_KR' AS locale FROM samples WHERE user_id % 50 <> 7", "samples")
def f1(spark, sf):
    rows = ingest.flatten(ingest.sanitise(v.stored_payloads(spark, sf)), F.lit(v.AS_OF_MS))
    return rows.select("device_id", "user_id", "sample_id", "data_type", "value", "unit", "start_date", "end_date", "timezone", F.try_element_at("metadata", F.lit("locale")).alias("locale"))


@query("f9_validate_full", "SELECT data_type, coalesce(reject_reason, 'valid') AS outcome, count(*) AS n FROM checked GROUP BY 1, 2", "checked")
def f9(spark, sf):
    return checked(spark, sf).groupBy("data_type", F.coalesce("reject_reason", F.lit("valid")).alias("outcome")).agg(F.count("*").alias("n"))


@query("f9_validate_rows", "SELECT sample_id, reject_reason, end_date - start_date > 604800000 AS warn_long_duration FROM checked", "checked")
def f9_rows(spark, sf):
    return checked(spark, sf).select("sample_id", "reject_reason", "warn_long_duration")


@query("f10_validate_light", "SELECT sample_id, CASE WHEN value - 20 < 0 THEN 'negative_value' WHEN start_date > end_date THEN 'start_after_end' END AS reject_reason FROM samples", "samples")
def f10(spark, sf):
    return validate.validate_light(v.samples(spark, sf).withColumn("value", F.col("value") - 20)).select("sample_id", "reject_reason")


_G = "CASE data_type " + " ".join(f"WHEN '{t}' THEN value < {lo} OR value > {hi}" for t, (lo, hi) in rules.GATEWAY_RANGES.items()) + " ELSE false END"


@query("f11_ingest_errors", f"SELECT CAST(user_id AS VARCHAR) AS user_id, date_trunc('hour', start_ts) AS hour, CAST(sum(CASE WHEN {_G} THEN 1 ELSE 0 END + CASE WHEN value <= 0 AND data_type <> 'bodyTemperature' THEN 1 ELSE 0 END) AS BIGINT) AS n_errors FROM samples GROUP BY 1, 2", "samples")
def f11(spark, sf):
    rows = ingest.payload_errors(v.payloads(spark, sf), rules.GATEWAY_RANGES)
    return rows.select(F.col("userId").alias("user_id"), F.to_timestamp("timestamp").cast("timestamp_ntz").alias("hour"), F.size("errors").cast("long").alias("n_errors"))


@query("f12_type_whitelist", "SELECT count(DISTINCT (user_id, date_trunc('hour', start_ts))) AS accepted FROM samples", "samples")
def f12(spark, sf):
    p = v.payloads(spark, sf)
    return p.agg(F.count_if(ingest.accepted_types(p)).alias("accepted"))


@query("f14_error_records", "SELECT sample_id, 'VALIDATION_ERROR' AS error_type, reject_reason AS error_message, 'LOW' AS severity, false AS retryable, data_type AS data_type_partition FROM (SELECT CAST(sample_id AS VARCHAR) AS sample_id, data_type, reject_reason FROM checked) WHERE reject_reason IS NOT NULL", "checked")
def f14(spark, sf):
    _, bad = validate.split(checked(spark, sf))
    return validate.error_records(bad, "VALIDATION_ERROR", F.lit(v.AS_OF_MS)).select("sample_id", "error_type", "error_message", "severity", "retryable", "data_type_partition")


@query("f16_split", "SELECT reject_reason IS NULL AS valid, count(*) AS n FROM checked GROUP BY 1", "checked")
def f16(spark, sf):
    good, bad = validate.split(checked(spark, sf))
    n = lambda df, flag: df.agg(F.lit(flag).alias("valid"), F.count("*").alias("n"))
    return n(good, True).unionByName(n(bad, False))


@query("f23_thresholds", "SELECT user_id, aggregation_date, max_value AS peak, round(avg_value, 7) AS avg_value FROM daily WHERE data_type = 'heartRate' AND (max_value > 200 OR min_value < 40) AND aggregation_date >= DATE '2024-01-24'", "daily")
def f23(spark, sf):
    d = v.daily(spark, sf).where("data_type = 'heartRate' and (max_value > 200 or min_value < 40)").where(F.col("aggregation_date") >= F.date_sub(F.lit(v.AS_OF), 7))
    return d.select("user_id", "aggregation_date", F.col("max_value").alias("peak"), F.round("avg_value", 7).alias("avg_value"))


@query("f24_masking", r"""SELECT doc_id, sha256(regexp_replace(text, '(?i)\b((?:s3[_-]secret[_-]key|s3-secret-key|access[_-]token|refresh[_-]token|access[_-]key|secret[_-]key|access-key|secret-key|api[_-]key|password|api-key|apikey|passwd|secret|token|pwd)\s*=\s*)[^\s,;&]+', '\1***MASKED***', 'g')) AS masked FROM documents""")
def f24(spark, sf):
    return v.table(spark, sf, "documents").select("doc_id", F.sha2(masking.mask_text(F.col("text")), 256).alias("masked"))


@query("f25_lookup", f"SELECT user_id, data_type, aggregation_date, {ROUNDED} FROM daily WHERE data_type = 'steps' AND aggregation_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-17'", "daily")
def f25(spark, sf):
    d = v.daily(spark, sf).where((F.col("data_type") == "steps") & query_api.between_dates("aggregation_date", dt.date(2024, 1, 10), dt.date(2024, 1, 17)))
    return rounded(d).drop("timezone", "window_start", "window_end").orderBy("user_id", "aggregation_date")


# Aggregates


@query("a1_calendar_daily", f"SELECT user_id, data_type, timezone, aggregation_date, epoch_ms(CAST(aggregation_date AS TIMESTAMP) AT TIME ZONE timezone) AS window_start, epoch_ms((CAST(aggregation_date AS TIMESTAMP) + INTERVAL 1 DAY) AT TIME ZONE timezone) AS window_end, {ROUNDED} FROM daily", "daily")
def a1_daily(spark, sf):
    return rounded(v.daily(spark, sf))


@query("st9_calendar_weekly", f"SELECT user_id, data_type, timezone, CAST(isoyear(week_start_date) AS INTEGER) AS year, CAST(week(week_start_date) AS INTEGER) AS week_of_year, week_start_date, CAST(week_start_date + 6 AS DATE) AS week_end_date, {ROUNDED} FROM weekly", "weekly")
def st9_weekly(spark, sf):
    return rounded(v.weekly(spark, sf)).drop("window_start", "window_end")


@query("st9_calendar_monthly", f"SELECT user_id, data_type, year, month, make_date(year, month, 1) AS month_start_date, last_day(make_date(year, month, 1)) AS month_end_date, CAST(day(last_day(make_date(year, month, 1))) AS INTEGER) AS days_in_month, {ROUNDED} FROM monthly", "monthly")
def st9_monthly(spark, sf):
    return rounded(v.monthly(spark, sf)).drop("window_start", "window_end", "timezone")


@query("st4_fixed_monday", f"SELECT user_id, data_type, epoch_ms(date_trunc('week', start_ts)) AS window_start, {ROUNDED} FROM (SELECT user_id, data_type, date_trunc('week', start_ts) AS start_ts, {STATS} FROM samples GROUP BY 1, 2, 3)", "samples")
def st4_monday(spark, sf):
    return rounded(aggregate.fixed_aggregate(v.samples(spark, sf), "weekly")).drop("window_end", "year", "week_of_year", "week_start_date", "week_end_date")


@query("st4_fixed_epoch", "SELECT user_id, data_type, start_date // 2592000000 * 2592000000 AS window_start, count(*) AS count, round(avg(value), 7) AS avg_value FROM samples GROUP BY 1, 2, 3", "samples")
def st4_epoch(spark, sf):
    return rounded(aggregate.fixed_aggregate(v.samples(spark, sf), "monthly", aligned=False)).select("user_id", "data_type", "window_start", "count", "avg_value")


@query("a2_merged_partials", f"SELECT user_id, data_type, {ROUNDED} FROM (SELECT user_id, data_type, {STATS} FROM samples GROUP BY 1, 2)", "samples")
def a2(spark, sf):
    parts = aggregate.partials(v.samples(spark, sf), ["user_id", "data_type", F.to_date("start_ts").alias("day")])
    rows = aggregate.finished(aggregate.merged(parts, ["user_id", "data_type"]))
    return rounded(rows)


@query("a3_rollup_to_month", "SELECT user_id, data_type, CAST(year(start_ts) AS INTEGER) AS year, CAST(month(start_ts) AS INTEGER) AS month, count(*) AS count, round(sum(value), 7) AS sum_value, round(stddev_pop(value), 3) AS stddev_value FROM samples GROUP BY 1, 2, 3, 4", "samples")
def a3(spark, sf):
    parts = aggregate.partials(v.samples(spark, sf), ["user_id", "data_type", F.to_date("start_ts").alias("day")])
    rows = aggregate.finished(aggregate.merged(parts, ["user_id", "data_type", F.year("day").alias("year"), F.month("day").alias("month")]))
    return rows.select("user_id", "data_type", "year", "month", "count", F.round("sum_value", 7).alias("sum_value"), F.round("stddev_value", 3).alias("stddev_value"))


@query("a4_daily_avg_of_avg", "SELECT user_id, data_type, round(avg(avg_value), 7) AS daily_avg_of_avg, count(*) AS days FROM daily GROUP BY 1, 2", "daily")
def a4(spark, sf):
    return aggregate.mean_of_daily_means(v.daily(spark, sf), ["user_id", "data_type"]).withColumn("daily_avg_of_avg", F.round("daily_avg_of_avg", 7))


@query("a6_raw_daily_average", "SELECT CAST(start_ts AS DATE) AS date, round(avg(value), 7) AS avg_value FROM samples WHERE data_type = 'heartRate' GROUP BY 1", "samples")
def a6(spark, sf):
    return v.samples(spark, sf).where("data_type = 'heartRate'").groupBy(F.to_date("start_ts").alias("date")).agg(F.round(F.avg("value"), 7).alias("avg_value"))


@query("a7_cross_user_weekly", "SELECT data_type, week_start_date, count(DISTINCT user_id) AS user_count, round(avg(avg_value), 7) AS overall_avg, min(min_value) AS overall_min, max(max_value) AS overall_max FROM weekly GROUP BY 1, 2", "weekly")
def a7(spark, sf):
    return v.weekly(spark, sf).groupBy("data_type", "week_start_date").agg(F.countDistinct("user_id").alias("user_count"), F.round(F.avg("avg_value"), 7).alias("overall_avg"), F.min("min_value").alias("overall_min"), F.max("max_value").alias("overall_max"))


@query("a8_zone_distribution", "SELECT timezone, count(*) AS record_count, count(DISTINCT user_id) AS user_count FROM samples GROUP BY 1", "samples")
def a8(spark, sf):
    return v.samples(spark, sf).groupBy("timezone").agg(F.count("*").alias("record_count"), F.countDistinct("user_id").alias("user_count"))


@query("a9_zone_by_month", "SELECT timezone, CAST(month(aggregation_date) AS INTEGER) AS month, round(avg(avg_value), 7) AS overall_avg, count(DISTINCT user_id) AS user_count FROM daily WHERE data_type = 'heartRate' GROUP BY 1, 2", "daily")
def a9(spark, sf):
    return v.daily(spark, sf).where("data_type = 'heartRate'").groupBy("timezone", F.month("aggregation_date").alias("month")).agg(F.round(F.avg("avg_value"), 7).alias("overall_avg"), F.countDistinct("user_id").alias("user_count"))


@query("a10_share_with_zone", "SELECT CAST(start_ts AS DATE) AS date, count(*) AS total, count(*) FILTER (timezone <> 'UTC') AS with_zone, round(count(*) FILTER (timezone <> 'UTC') * 100.0 / count(*), 7) AS percentage FROM samples GROUP BY 1", "samples")
def a10(spark, sf):
    n = F.count_if(F.col("timezone") != "UTC")
    return v.samples(spark, sf).groupBy(F.to_date("start_ts").alias("date")).agg(F.count("*").alias("total"), n.alias("with_zone"), F.round(n * 100.0 / F.count("*"), 7).alias("percentage"))


_MOVING = "CASE WHEN user_id % 10 = 3 AND sample_id % 2 = 0 THEN 'Asia/Tokyo' ELSE timezone END"


@query("a11_several_zones", f"SELECT user_id, count(DISTINCT z) AS timezone_count, array_to_string(list_sort(list_distinct(list(z))), ',') AS timezones FROM (SELECT user_id, {_MOVING} AS z FROM samples) GROUP BY 1 HAVING count(DISTINCT z) > 1", "samples")
def a11(spark, sf):
    rows = analytics.several_zones(v.samples(spark, sf).withColumn("timezone", F.expr(_MOVING)))
    return rows.withColumn("timezones", F.array_join("timezones", ","))


@query("a12_year_pivot", "SELECT data_type, month, max(avg_value) FILTER (year = 1996) AS avg_1996, max(avg_value) FILTER (year = 1997) AS avg_1997 FROM (SELECT data_type, CAST(year(start_ts) AS INTEGER) AS year, CAST(month(start_ts) AS INTEGER) AS month, round(avg(value), 2) AS avg_value FROM purchases GROUP BY 1, 2, 3) WHERE year IN (1996, 1997) GROUP BY 1, 2", "purchases")
def a12(spark, sf):
    m = v.purchases(spark, sf).groupBy("data_type", F.year("start_ts").alias("year"), F.month("start_ts").alias("month")).agg(F.round(F.avg("value"), 2).alias("avg_value"))
    return analytics.year_pivot(m, [1996, 1997], ["data_type"])


@query("a13_cohorts", "SELECT CASE WHEN avg_value < 60 THEN 'Low' WHEN avg_value <= 100 THEN 'Normal' ELSE 'High' END AS category, count(DISTINCT user_id) AS user_count, round(avg(avg_value), 7) AS avg_value FROM daily WHERE data_type = 'heartRate' GROUP BY 1", "daily")
def a13(spark, sf):
    return rounded(analytics.cohorts(v.daily(spark, sf).where("data_type = 'heartRate'")))


@query("a14_duplicates", "SELECT sample_id, count(*) AS n FROM (SELECT sample_id FROM samples UNION ALL SELECT sample_id FROM samples WHERE sample_id % 10 = 0) GROUP BY 1 HAVING count(*) > 1", "samples")
def a14(spark, sf):
    s = v.samples(spark, sf)
    return analytics.duplicates(s.unionByName(s.where("sample_id % 10 = 0")))


@query("a15_missing_zone", "SELECT count(*) FILTER (nullif(timezone, 'UTC') IS NULL) AS missing FROM samples", "samples")
def a15(spark, sf):
    return v.samples(spark, sf).agg(F.count_if(F.nullif(F.col("timezone"), F.lit("UTC")).isNull()).alias("missing"))


@query("a16_row_count", "SELECT count(*) AS n FROM samples", "samples")
def a16(spark, sf):
    return v.samples(spark, sf).agg(F.count("*").alias("n"))


@query("a17_rejection_rate", "SELECT data_type, count(*) AS processed, count(reject_reason) AS rejected, round(count(reject_reason) / count(*), 6) AS rejection_rate FROM checked GROUP BY 1", "checked")
def a17(spark, sf):
    return metrics.rejection(checked(spark, sf), "data_type").withColumn("rejection_rate", F.round("rejection_rate", 6))


@query("a18_throughput", "SELECT time_bucket(INTERVAL 5 MINUTE, start_ts) AS window_start, data_type, count(*) AS records FROM checked WHERE reject_reason IS NULL GROUP BY 1, 2", "checked")
def a18(spark, sf):
    good, _ = validate.split(checked(spark, sf))
    return metrics.throughput(good, "start_ts", "5 minutes", "data_type").withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@query("a19_failures", "SELECT reject_reason, data_type, count(*) AS failures FROM checked WHERE reject_reason IS NOT NULL GROUP BY 1, 2", "checked")
def a19(spark, sf):
    return metrics.failures(checked(spark, sf))


@query("a20_latency", "SELECT data_type, count(*) AS n, min(l) AS least, round(avg(l), 7) AS mean, max(l) AS most FROM (SELECT data_type, end_date - start_date - 60000 AS l FROM samples) WHERE l >= 0 GROUP BY 1", "samples")
def a20(spark, sf):
    rows = v.samples(spark, sf).withColumn("latency_ms", F.col("end_date") - F.col("start_date") - 60000)
    return metrics.latency(rows, "latency_ms", "data_type").select("data_type", "n", "least", F.round("mean", 7).alias("mean"), "most")


def _windows(spark, sf):
    return v.daily(spark, sf).select(F.lit("daily").alias("window_type"), "record_count", (F.lit(v.AS_OF_MS) - F.col("window_end") + F.col("record_count")).alias("latency_ms")).unionByName(
        v.weekly(spark, sf).select(F.lit("weekly").alias("window_type"), "record_count", (F.lit(v.AS_OF_MS) - F.col("window_end") + F.col("record_count")).alias("latency_ms"))
    )


_SORTED = "x AS (SELECT data_type, l, row_number() OVER (PARTITION BY data_type ORDER BY l) AS r, count(*) OVER (PARTITION BY data_type) AS n FROM (SELECT data_type, end_date - start_date AS l FROM samples))"
_AT = lambda q: f"max(l) FILTER (r = least(CAST(floor(n * {q}) AS BIGINT), n - 1) + 1)"


@query("a21_exact_percentiles", f", {_SORTED} SELECT data_type, {_AT('CAST(0.5 AS DOUBLE)')} AS p50, {_AT('CAST(0.95 AS DOUBLE)')} AS p95, {_AT('CAST(0.99 AS DOUBLE)')} AS p99 FROM x GROUP BY 1", "samples")
def a21(spark, sf):
    rows = v.samples(spark, sf).withColumn("l", F.col("end_date") - F.col("start_date"))
    return metrics.exact_percentiles(rows, "l", ["data_type"], {"p50": 0.5, "p95": 0.95, "p99": 0.99})


@query("a22_window_summary", """, w AS (
  SELECT 'daily' AS window_type, record_count, 1706659200000 - epoch_ms((CAST(aggregation_date AS TIMESTAMP) + INTERVAL 1 DAY) AT TIME ZONE timezone) + record_count AS l FROM daily
  UNION ALL SELECT 'weekly', record_count, 1706659200000 - epoch_ms((CAST(week_start_date AS TIMESTAMP) + INTERVAL 7 DAY) AT TIME ZONE timezone) + record_count FROM weekly),
t AS (SELECT window_type, l, record_count FROM w UNION ALL SELECT NULL, l, record_count FROM w),
x AS (SELECT *, row_number() OVER (PARTITION BY window_type ORDER BY l) AS r, count(*) OVER (PARTITION BY window_type) AS n FROM t)
SELECT window_type, count(*) AS windows, CAST(sum(record_count) AS BIGINT) AS records, round(avg(record_count), 7) AS avg_records, min(l) AS min_latency, round(avg(l), 1) AS avg_latency, max(l) AS max_latency,
  max(l) FILTER (r = least(CAST(floor(n * CAST(0.5 AS DOUBLE)) AS BIGINT), n - 1) + 1) AS p50, max(l) FILTER (r = least(CAST(floor(n * CAST(0.95 AS DOUBLE)) AS BIGINT), n - 1) + 1) AS p95, max(l) FILTER (r = least(CAST(floor(n * CAST(0.99 AS DOUBLE)) AS BIGINT), n - 1) + 1) AS p99
FROM x GROUP BY 1""", "both")
def a22(spark, sf):
    rows = metrics.window_summary(_windows(spark, sf))
    return rows.withColumns({"avg_records": F.round("avg_records", 7), "avg_latency": F.round("avg_latency", 1)})


@query("a23_counters", "SELECT user_id, data_type, count(*) AS samples FROM samples GROUP BY 1, 2", "samples")
def a23(spark, sf):
    return v.payloads(spark, sf).select(F.col("userId").cast("long").alias("user_id"), F.explode("samples").alias("s")).groupBy("user_id", F.col("s.type").alias("data_type")).agg(F.count("*").alias("samples"))


@query("a24_totals", "SELECT 'daily' AS kind, count(*) AS windows, CAST(sum(record_count) AS BIGINT) AS records FROM daily UNION ALL SELECT 'weekly', count(*), CAST(sum(record_count) AS BIGINT) FROM weekly", "both")
def a24(spark, sf):
    total = lambda df, kind: df.agg(F.lit(kind).alias("kind"), F.count("*").alias("windows"), F.sum("record_count").alias("records"))
    return total(v.daily(spark, sf), "daily").unionByName(total(v.weekly(spark, sf), "weekly"))


@query("a26_rates", "SELECT time_bucket(INTERVAL 5 MINUTE, start_ts) AS window_start, round(count(*) / 300, 6) AS per_second, round(count(reject_reason) * 100 / nullif(count(*) - count(reject_reason), 0), 6) AS error_percent FROM checked GROUP BY 1", "checked")
def a26(spark, sf):
    rows = checked(spark, sf).groupBy(F.window("start_ts", "5 minutes").start.cast("timestamp_ntz").alias("window_start")).agg(F.count("*").alias("n"), F.count("reject_reason").alias("bad"))
    return rows.select("window_start", F.round(F.col("n") / 300, 6).alias("per_second"), F.round(F.try_divide(F.col("bad") * 100, F.col("n") - F.col("bad")), 6).alias("error_percent"))


# Joins


@query("j1_daily_summary", """SELECT d.user_id, d.aggregation_date, round(d.avg_value, 7) AS avg_heart_rate, round(s.sum_value, 7) AS total_steps, round(sl.avg_value, 7) AS avg_sleep_hours
FROM daily d LEFT JOIN daily s ON d.user_id = s.user_id AND d.aggregation_date = s.aggregation_date AND s.data_type = 'steps'
LEFT JOIN daily sl ON d.user_id = sl.user_id AND d.aggregation_date = sl.aggregation_date AND sl.data_type = 'sleepAnalysis' WHERE d.data_type = 'heartRate'""", "daily")
def j1(spark, sf):
    return analytics.daily_summary(v.daily(spark, sf)).withColumns({c: F.round(c, 7) for c in ("avg_heart_rate", "total_steps", "avg_sleep_hours")})


ORACLES["j1_daily_summary_joined"] = ORACLES["j1_daily_summary"]


@query("j1_daily_summary_joined")
def j1_joined(spark, sf):
    return analytics.daily_summary_joined(v.daily(spark, sf)).withColumns({c: F.round(c, 7) for c in ("avg_heart_rate", "total_steps", "avg_sleep_hours")})


_Z = "SELECT d.user_id, d.data_type, d.aggregation_date, round(abs(avg_value - m) / s, 7) AS z_score FROM daily d JOIN (SELECT user_id, data_type, avg(avg_value) AS m, stddev(avg_value) AS s FROM daily GROUP BY 1, 2) x ON d.user_id = x.user_id AND d.data_type = x.data_type WHERE s > 0 AND abs(avg_value - m) / s > 1.5"


@query("w7_z_scores", _Z, "daily")
def w7(spark, sf):
    return analytics.z_scores(v.daily(spark, sf), 1.5).select("user_id", "data_type", "aggregation_date", F.round("z_score", 7).alias("z_score"))


@query("j2_z_scores_joined", _Z, "daily")
def j2(spark, sf):
    return analytics.z_scores_joined(v.daily(spark, sf), 1.5).select("user_id", "data_type", "aggregation_date", F.round("z_score", 7).alias("z_score"))


@query("j3_fixed_and_calendar", """, f AS (SELECT user_id, data_type, CAST(start_ts AS DATE) AS aggregation_date, avg(value) AS a FROM samples GROUP BY 1, 2, 3)
SELECT user_id, data_type, aggregation_date, round(a, 7) AS fixed_avg, round(avg_value, 7) AS calendar_avg, round(abs(a - avg_value), 7) AS diff FROM f JOIN daily USING (user_id, data_type, aggregation_date) WHERE abs(a - avg_value) > 1.0""", "daily")
def j3(spark, sf):
    rows = analytics.compare_windows(aggregate.fixed_aggregate(v.samples(spark, sf), "daily"), v.daily(spark, sf))
    return rows.withColumns({c: F.round(c, 7) for c in ("fixed_avg", "calendar_avg", "diff")})


def _profiles(spark, sf):
    """Profile changes: a user's signups, with zones in turn."""
    s = v.samples(spark, sf).where("data_type = 'oxygenSaturation'")
    return s.select("user_id", F.element_at(F.array(*map(F.lit, v.ZONES)), (F.col("sample_id") % 4 + 1).cast("int")).alias("timezone"), F.col("start_ts").alias("updated_at"))


_PROFILES = "p AS (SELECT user_id, ['Asia/Seoul', 'America/New_York', 'Europe/London', 'UTC'][CAST(sample_id % 4 AS INTEGER) + 1] AS tz, start_ts AS updated_at FROM samples WHERE data_type = 'oxygenSaturation')"


@query("j4_zone_as_of", f", {_PROFILES} SELECT sample_id, tz AS user_timezone FROM samples s ASOF LEFT JOIN p ON s.user_id = p.user_id AND s.start_ts >= p.updated_at", "samples")
def j4(spark, sf):
    return analytics.zone_as_of(v.samples(spark, sf), _profiles(spark, sf)).select("sample_id", "user_timezone")


@query("j4_zone_latest", f", {_PROFILES} SELECT sample_id, z AS user_timezone FROM samples s LEFT JOIN (SELECT user_id, arg_max(tz, updated_at) AS z FROM p GROUP BY 1) q ON s.user_id = q.user_id", "samples")
def j4_latest(spark, sf):
    return analytics.zone_latest(v.samples(spark, sf), _profiles(spark, sf)).select("sample_id", "user_timezone")


@query("j5_travellers", "SELECT user_id, data_type, aggregation_date, round(avg_value, 7) AS avg_value FROM daily WHERE user_id IN (SELECT DISTINCT user_id FROM samples WHERE timezone <> 'UTC' ORDER BY user_id LIMIT 10)", "daily")
def j5(spark, sf):
    return analytics.travellers_days(v.daily(spark, sf), v.samples(spark, sf)).select("user_id", "data_type", "aggregation_date", F.round("avg_value", 7).alias("avg_value"))


@query("j7_zone_by_priority", f", {_PROFILES} SELECT sample_id, coalesce(nullif(s.timezone, 'UTC'), z, CASE WHEN sample_id % 3 = 0 THEN 'Asia/Tokyo' END, 'UTC') AS zone FROM samples s LEFT JOIN (SELECT user_id, arg_max(tz, updated_at) AS z FROM p GROUP BY 1) q ON s.user_id = q.user_id", "samples")
def j7(spark, sf):
    rows = v.samples(spark, sf).withColumns({"timezone": F.nullif(F.col("timezone"), F.lit("UTC")), "metadata": F.create_map(F.lit("locale"), F.when(F.col("sample_id") % 3 == 0, "ja_JP").otherwise("xx"))})
    return analytics.zone_by_priority(rows, _profiles(spark, sf), rules.LOCALE_ZONES).select("sample_id", "zone")


# Window functions


@query("w1_year_over_year", "SELECT user_id, data_type, year, month, round(avg_value, 7) AS avg_value, round(lag(avg_value) OVER (PARTITION BY user_id, data_type, month ORDER BY year), 7) AS prev_year_avg FROM monthly", "monthly")
def w1(spark, sf):
    rows = analytics.lagged(v.monthly(spark, sf), ["user_id", "data_type", "month"], ["year"], "avg_value", {"prev_year_avg": 1})
    return rounded(rows, "prev_year_avg").select("user_id", "data_type", "year", "month", "avg_value", "prev_year_avg")


@query("w2_week_over_week", "SELECT user_id, data_type, week_start_date, round(avg_value, 7) AS avg_value, round((avg_value - p) / nullif(p, 0) * 100, 7) AS pct_change FROM (SELECT *, lag(avg_value) OVER (PARTITION BY user_id, data_type ORDER BY week_start_date) AS p FROM weekly)", "weekly")
def w2(spark, sf):
    rows = analytics.lagged(v.weekly(spark, sf), ["user_id", "data_type"], ["week_start_date"], "avg_value", {"prev": 1})
    return rows.select("user_id", "data_type", "week_start_date", F.round("avg_value", 7).alias("avg_value"), F.round(analytics.percent_change("avg_value", "prev"), 7).alias("pct_change"))


@query("w3_month_comparison", "SELECT user_id, data_type, year, month, round(lag(avg_value, 1) OVER w, 7) AS prev_month_avg, round(lag(avg_value, 12) OVER w, 7) AS same_month_last_year FROM monthly WINDOW w AS (PARTITION BY user_id, data_type ORDER BY year, month)", "monthly")
def w3(spark, sf):
    rows = analytics.lagged(v.monthly(spark, sf), ["user_id", "data_type"], ["year", "month"], "avg_value", {"prev_month_avg": 1, "same_month_last_year": 12})
    return rounded(rows, "prev_month_avg", "same_month_last_year").select("user_id", "data_type", "year", "month", "prev_month_avg", "same_month_last_year")


@query("w4_moving_average", "SELECT user_id, data_type, aggregation_date, round(avg(avg_value) OVER (PARTITION BY user_id, data_type ORDER BY aggregation_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 7) AS moving_avg FROM daily", "daily")
def w4(spark, sf):
    return analytics.moving_average(v.daily(spark, sf)).select("user_id", "data_type", "aggregation_date", F.round("moving_avg", 7).alias("moving_avg"))


# Query API


@query("r1_daily", f"SELECT user_id, data_type, strftime(aggregation_date, '%Y-%m-%d') AS aggregation_date, {ROUNDED} FROM daily WHERE user_id = {USER} AND data_type = 'heartRate' AND aggregation_date BETWEEN DATE '2024-01-01' AND DATE '2024-01-31'", "daily")
def r1(spark, sf):
    days = v.stored_days(spark, sf, *query_api.default_dates(v.AS_OF, None, None))
    rows = query_api.daily_aggregates(days, USER, "heartRate", v.AS_OF)
    return query_api.as_text(rounded(rows).drop("year", "timezone", "window_start", "window_end"))


@query("r2_weekly", f"SELECT user_id, data_type, week_start_date, round(avg_value, 7) AS avg_value FROM weekly WHERE user_id = {USER} AND data_type = 'steps' AND isoyear(week_start_date) * 100 + week(week_start_date) BETWEEN 202352 AND 202403", "weekly")
def r2(spark, sf):
    rows = query_api.weekly_aggregates(v.stored(spark, sf, "weekly"), USER, "steps", v.AS_OF, "2023-W52", "2024-W03")
    return rounded(rows).select("user_id", "data_type", "week_start_date", "avg_value")


@query("r2_default_weeks", f"SELECT user_id, data_type, week_start_date, round(avg_value, 7) AS avg_value FROM weekly WHERE user_id = {USER} AND week_start_date BETWEEN date_trunc('week', DATE '2024-04-04' - 84) AND DATE '2024-04-04'", "weekly")
def r2_default(spark, sf):
    """Without a range the last twelve weeks count, here from the week of 11 January."""
    rows = None
    for kind in (*v.TYPES.values(), "bodyTemperature"):
        one = query_api.weekly_aggregates(v.stored(spark, sf, "weekly"), USER, kind, dt.date(2024, 4, 4))
        rows = one if rows is None else rows.unionByName(one)
    return rounded(rows).select("user_id", "data_type", "week_start_date", "avg_value")


@query("r3_default_months", f"SELECT user_id, data_type, year, month, round(avg_value, 7) AS avg_value FROM monthly WHERE user_id = {BUYER} AND year * 12 + month BETWEEN 1998 * 12 + 2 AND 1998 * 12 + 8", "monthly")
def r3_default(spark, sf):
    """Without a range the last six months and the present one count."""
    rows = None
    for kind in ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"):
        one = query_api.monthly_aggregates(v.stored(spark, sf, "monthly"), BUYER, kind, dt.date(1998, 8, 20))
        rows = one if rows is None else rows.unionByName(one)
    return rounded(rows).select("user_id", "data_type", "year", "month", "avg_value")


@query("t2_order", """
SELECT user_id, aggregation_date, row_number() OVER (ORDER BY user_id, aggregation_date) AS place FROM daily WHERE data_type = 'steps' AND aggregation_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-17'""", "daily")
def t2(spark, sf):
    """The place of each row in the order in which the look-up gives its rows, task after task."""
    rows = f25(spark, sf).withColumn("at", F.monotonically_increasing_id())
    return rows.select("user_id", "aggregation_date", F.row_number().over(Window.orderBy("at")).cast("long").alias("place"))  # rows of eight days of one type


@query("r3_monthly", f"SELECT user_id, data_type, year, month, round(avg_value, 7) AS avg_value FROM monthly WHERE user_id = {BUYER} AND data_type = '1-URGENT' AND year * 100 + month BETWEEN 199511 AND 199803", "monthly")
def r3(spark, sf):
    rows = query_api.monthly_aggregates(v.stored(spark, sf, "monthly"), BUYER, "1-URGENT", v.AS_OF, "1995-11", "1998-03")
    return rounded(rows).select("user_id", "data_type", "year", "month", "avg_value")


@query("r4_top_records", f"SELECT user_id, aggregation_date, round(sum_value, 7) AS sum_value, CAST(row_number() OVER (ORDER BY sum_value DESC, aggregation_date) AS INTEGER) AS rank FROM daily WHERE user_id = {USER} AND data_type = 'heartRate' AND aggregation_date BETWEEN DATE '2024-01-01' AND DATE '2024-01-31' ORDER BY sum_value DESC, aggregation_date LIMIT 10", "daily")
def r4(spark, sf):
    days = v.stored_days(spark, sf, *query_api.default_dates(v.AS_OF, None, None))
    rows = query_api.top_records(days, USER, "heartRate", v.AS_OF, sort_by="sum_value")
    return rounded(rows).select("user_id", "aggregation_date", "sum_value", "rank")


@query("r5_envelope", f"SELECT user_id, data_type, count(*) AS count, min(aggregation_date) AS first_date FROM daily WHERE user_id = {USER} AND data_type = 'heartRate' GROUP BY 1, 2", "daily")
def r5(spark, sf):
    rows = query_api.daily_aggregates(v.stored(spark, sf, "daily"), USER, "heartRate", v.AS_OF, dt.date(2023, 12, 1), dt.date(2024, 3, 1)).select("user_id", "data_type", "aggregation_date", "avg_value")
    return query_api.envelope(rows, ["user_id", "data_type"]).select("user_id", "data_type", "count", F.col("records")[0]["aggregation_date"].alias("first_date"))


@query("r6_top_each", "SELECT user_id, data_type, aggregation_date, round(sum_value, 7) AS sum_value, CAST(rank AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY user_id, data_type ORDER BY sum_value DESC, aggregation_date) AS rank FROM daily) WHERE rank <= 3", "daily")
def r6(spark, sf):
    d = v.daily(spark, sf)
    requests = v.samples(spark, sf).select("user_id", "data_type", F.lit(dt.date(2023, 12, 1)).alias("start"), F.lit(dt.date(2024, 3, 1)).alias("end")).distinct()
    return rounded(query_api.top_records_each(d, requests, "sum_value", "desc", 3)).select("user_id", "data_type", "aggregation_date", "sum_value", "rank")


@query("f17_predicates", "SELECT sample_id FROM samples WHERE data_type = 'steps' AND value >= 50 AND value < 100 AND timezone <> 'UTC'", "samples")
def f17(spark, sf):
    return v.samples(spark, sf).where(query_api.predicates([("data_type", "==", "steps"), ("value", ">=", 50.0), ("value", "<", 100.0), ("timezone", "!=", "UTC")])).select("sample_id")


@query("t3_latest", "SELECT week_start_date, round(avg(avg_value), 7) AS avg_value FROM weekly WHERE data_type = 'steps' GROUP BY 1 ORDER BY 1 DESC LIMIT 4", "weekly")
def t3(spark, sf):
    return v.weekly(spark, sf).where("data_type = 'steps'").groupBy("week_start_date").agg(F.round(F.avg("avg_value"), 7).alias("avg_value")).orderBy(F.desc("week_start_date")).limit(4)


# Times


@query("d8_window_metadata", "SELECT sample_id, strftime(start_ts, '%Y-%m-%d') AS day_key, isoyear(start_ts) || '-W' || lpad(CAST(week(start_ts) AS VARCHAR), 2, '0') AS week_key, strftime(start_ts, '%Y-%m') AS month_key, epoch_ms(date_trunc('month', start_ts) + INTERVAL 30 DAY) AS month_end_ms FROM samples", "samples")
def d8(spark, sf):
    d = F.to_date("start_ts")
    return v.samples(spark, sf).select("sample_id", times.window_key(d, "daily").alias("day_key"), times.window_key(d, "weekly").alias("week_key"), times.window_key(d, "monthly").alias("month_key"), times.utc_window(F.col("start_ts"), "monthly").end_ms.alias("month_end_ms"))


@query("d11_iso_times", "SELECT sample_id, start_date AS utc_ms, start_date - 32400000 AS seoul_ms, CAST(NULL AS BIGINT) AS junk_ms FROM samples", "samples")
def d11(spark, sf):
    text = F.date_format("start_ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    ms = times.iso_to_millis
    return v.samples(spark, sf).select("sample_id", ms(F.concat(text, F.lit("Z"))).alias("utc_ms"), ms(F.concat(text, F.lit("+09:00"))).alias("seoul_ms"), ms(F.concat(F.lit("x"), text)).alias("junk_ms"))


#: Zones as devices state them: names with and without a slash, unknown and missing ones.
STATED_ZONES = ("Mars/Olympus", None, "Japan", "ROK", "GMT", "EST", "Singapore", "PST8PDT", "", "asia/seoul", "Asia/Seoul", "America/Argentina/Buenos_Aires")
_STATED = "[" + ", ".join("NULL" if z is None else f"'{z}'" for z in STATED_ZONES) + f"][CAST(sample_id % {len(STATED_ZONES)} AS INTEGER) + 1]"
_RESOLVED = f"CASE WHEN {_STATED} IS NULL OR {_STATED} IN ('Mars/Olympus', '', 'asia/seoul') THEN 'UTC' ELSE {_STATED} END"


def stated_zone(sample_id):
    return F.element_at(F.array(*map(F.lit, STATED_ZONES)), (sample_id % len(STATED_ZONES) + 1).cast("int"))


@query("d13_resolve_zone", f"""
SELECT sample_id, zone AS resolved, CAST(extract(hour FROM (start_ts AT TIME ZONE 'UTC') AT TIME ZONE zone) AS INTEGER) AS local_hour
FROM (SELECT *, {_RESOLVED.replace("'UTC'", "'Asia/Tokyo'")} AS zone FROM samples)""", "samples")
def d13(spark, sf):
    rows = v.samples(spark, sf).withColumn("timezone", stated_zone(F.col("sample_id")))
    rows = times.with_zone(rows, default="Asia/Tokyo")
    return rows.select("sample_id", F.col("resolved_timezone").alias("resolved"), F.hour(F.from_utc_timestamp("start_ts", F.col("resolved_timezone"))).alias("local_hour"))


@query("d15_zone_offset", f"SELECT sample_id, CAST(epoch({LOCAL}) - epoch(start_ts) AS BIGINT) // 60 AS offset_minutes, abs(CAST(epoch({LOCAL}) - epoch(start_ts) AS BIGINT) // 60 - 540) <= 60 AS agrees FROM samples", "samples")
def d15(spark, sf):
    ts, zone = F.col("start_ts"), F.col("timezone")
    return v.samples(spark, sf).select("sample_id", times.zone_offset_minutes(ts, zone).cast("long").alias("offset_minutes"), times.offset_agrees(ts, zone, F.lit(540)).alias("agrees"))


# Quality

_A = "CASE data_type " + " ".join(f"WHEN '{t}' THEN min_value < {lo} OR max_value > {hi} OR min_value > {hi} OR max_value < {lo}" for t, (lo, hi) in rules.AGGREGATE_RANGES.items()) + " ELSE false END"
_ANOMALY = "(CASE data_type WHEN 'heartRate' THEN avg_value > 180 OR avg_value < 40 OR max_value - min_value > 100 WHEN 'steps' THEN avg_value > 50000 WHEN 'bloodPressureSystolic' THEN avg_value > 160 OR avg_value < 90 ELSE false END OR (stddev_value = 0 AND count > 1) OR (stddev_value > 0 AND avg_value > 0 AND stddev_value > avg_value))"


@query("q5_validate_aggregates", f"SELECT user_id, data_type, aggregation_date, CASE WHEN {_A} THEN 'out_of_range' END AS fault, {_ANOMALY} AS has_anomaly FROM daily", "daily")
def q5(spark, sf):
    return quality.validate_aggregates(v.daily(spark, sf)).select("user_id", "data_type", "aggregation_date", "fault", "has_anomaly")


@query("q8_quality_score", f"SELECT user_id, data_type, aggregation_date, round(11.0 / 12 * CASE WHEN 1706659200000 - epoch_ms((CAST(aggregation_date AS TIMESTAMP) + INTERVAL 1 DAY) AT TIME ZONE timezone) <= 86400000 THEN 1.0 ELSE 0.9 END * CASE WHEN {_ANOMALY} THEN 0.95 ELSE 1.0 END * CASE WHEN count < 10 THEN 0.9 ELSE 1.0 END, 6) AS quality_score FROM daily", "daily")
def q8(spark, sf):
    rows = quality.score(quality.validate_aggregates(v.daily(spark, sf)), F.lit(v.AS_OF_MS))
    return rows.select("user_id", "data_type", "aggregation_date", F.round("quality_score", 6).alias("quality_score"))


_S = "CASE data_type " + " ".join(f"WHEN '{t}' THEN min_value >= {lo} AND max_value <= {hi}" for t, (lo, hi) in rules.SIMPLE_AGGREGATE_RANGES.items()) + " ELSE true END"


@query("q9_validate_simple", f"SELECT user_id, data_type, aggregation_date, {_S} AS valid FROM daily", "daily")
def q9(spark, sf):
    return quality.validate_simple(v.daily(spark, sf)).select("user_id", "data_type", "aggregation_date", "valid")


@query("q10_fault_counts", f"SELECT data_type, count(*) FILTER ({_A}) AS errors, count(*) FILTER ({_ANOMALY}) AS warnings FROM daily GROUP BY 1", "daily")
def q10(spark, sf):
    return quality.validate_aggregates(v.daily(spark, sf)).groupBy("data_type").agg(F.count("fault").alias("errors"), F.count_if("has_anomaly").alias("warnings"))


@query("q11_outliers", "SELECT sample_id, data_type, value FROM samples WHERE (data_type = 'heartRate' AND (value < 40 OR value > 200)) OR (data_type = 'steps' AND value > 50000)", "samples")
def q11(spark, sf):
    return quality.outliers(v.samples(spark, sf)).select("sample_id", "data_type", "value")


@query("q12_alerts", "SELECT window_start, alert, round(x, 6) AS value FROM (SELECT time_bucket(INTERVAL 5 MINUTE, start_ts) AS window_start, 'failure_share' AS alert, count(reject_reason) / count(*) AS x FROM checked GROUP BY 1) WHERE x > 0.1 UNION ALL SELECT time_bucket(INTERVAL 5 MINUTE, start_ts), 'throughput', round(count(*) / 300, 6) FROM checked GROUP BY 1 HAVING count(*) / 300 < 100", "checked")
def q12(spark, sf):
    rows = checked(spark, sf).groupBy(F.window("start_ts", "5 minutes").start.cast("timestamp_ntz").alias("window_start")).agg(F.count("*").alias("n"), F.count("reject_reason").alias("bad"))
    values = rows.select("window_start", F.explode(F.create_map(F.lit("failure_share"), F.col("bad") / F.col("n"), F.lit("throughput"), F.col("n") / 300)).alias("metric", "value"))
    return quality.alerts(values).withColumn("value", F.round("value", 6))


# Late data and streams

_LATE = ", o AS (SELECT *, max(floor(epoch(start_ts))) OVER (PARTITION BY user_id % 8 ORDER BY end_date, sample_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 60 AS w FROM samples)"


@query("st12_late_events", f"{_LATE} SELECT CAST(user_id % 8 AS BIGINT) AS source, count(*) AS events, count(*) FILTER (floor(epoch(start_ts)) < w) AS late_events, round(count(*) FILTER (floor(epoch(start_ts)) < w) / count(*) * 100, 6) AS late_percent, CAST(max(greatest(0, coalesce(w - floor(epoch(start_ts)), 0))) AS BIGINT) AS max_lateness FROM o GROUP BY 1", "samples")
def st12(spark, sf):
    rows = metrics.late_events(v.samples(spark, sf).withColumn("source", F.col("user_id") % 8), F.struct("end_date", "sample_id"), "start_ts", 60, "source", F.floor(F.col("end_date") / 3_600_000))
    return metrics.late_summary(rows, "source").withColumn("late_percent", F.round("late_percent", 6))


@query("st13_window_bookkeeping", f"{_LATE}, k AS (SELECT CAST(floor(epoch(start_ts)) AS BIGINT) // 300 * 300 AS s, w FROM o) SELECT s AS window_start, count(*) FILTER (coalesce(w < s + 300, true)) AS on_time, count(*) FILTER (w >= s + 300 AND w < s + 420) AS late_updates, count(*) FILTER (w >= s + 420) AS dropped FROM k GROUP BY 1", "samples")
def st13(spark, sf):
    rows = metrics.late_events(v.samples(spark, sf).withColumn("source", F.col("user_id") % 8), F.struct("end_date", "sample_id"), "start_ts", 60, "source", F.floor(F.col("end_date") / 3_600_000))
    return metrics.window_bookkeeping(rows, 300, 120)


def _stream(spark: SparkSession, sf: str) -> DataFrame:
    schema = v.table(spark, sf, "events").schema
    return v.as_samples(spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet").parquet(f"{sf}/events.parque[t]"))


@query("st17_stream_daily", f"SELECT user_id, data_type, timezone, aggregation_date, {ROUNDED} FROM daily", "daily")
def st17(spark, sf):
    root = v.work(spark, "job")
    job.start(_stream(spark, sf), root, f"{root}/checkpoint", ("daily",)).awaitTermination()
    return rounded(spark.read.parquet(f"{root}/daily")).select("user_id", "data_type", "timezone", "aggregation_date", "count", "sum_value", "min_value", "max_value", "avg_value", "stddev_value", "first_value", "last_value", "record_count")


@query("st15_stream_dedup", "SELECT data_type, count(*) AS n FROM samples GROUP BY 1", "samples")
def st15(spark, sf):
    root = v.work(spark, "dedup")
    stream = _stream(spark, sf)
    twice = calendar.without_redelivered(stream.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))))
    twice.select("sample_id", "data_type").writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema("sample_id long, data_type string").parquet(f"{root}/out").groupBy("data_type").agg(F.count("*").alias("n"))


# Tables


@query("s9_upsert", "SELECT user_id, data_type, aggregation_date, CASE WHEN aggregation_date >= DATE '2024-01-20' THEN 2 ELSE 1 END AS updated_at, round(CASE WHEN aggregation_date >= DATE '2024-01-20' THEN avg_value * 2 ELSE avg_value END, 7) AS avg_value FROM daily", "daily")
def s9(spark, sf):
    root = v.work(spark, "upsert")
    base = v.daily(spark, sf).select("user_id", "data_type", "aggregation_date", "avg_value")
    old = base.withColumn("updated_at", F.lit(1))
    new = base.where("aggregation_date >= date'2024-01-20'").withColumns({"avg_value": F.col("avg_value") * 2, "updated_at": F.lit(2)})
    for df in (old, new):
        tables.upsert(spark, f"{root}/table", df, ["user_id", "data_type", "aggregation_date"], ["data_type"], f"{root}/staging")
    return spark.read.schema(new.schema).parquet(f"{root}/table").withColumn("avg_value", F.round("avg_value", 7)).select("user_id", "data_type", "aggregation_date", "updated_at", "avg_value")


@query("s5_write_raw", "SELECT data_type, CAST(start_ts AS DATE) AS start_day, count(*) AS n FROM samples GROUP BY 1, 2", "samples")
def s5(spark, sf):
    root = v.work(spark, "raw")
    tables.write_raw(v.samples(spark, sf).drop("start_ts"), f"{root}/raw")
    tables.compact(spark, f"{root}/raw", tables.RAW_PARTITIONS, f"{root}/staging", tables.TARGET_BYTES["raw"])
    return spark.read.schema("sample_id long, start_day date, data_type string").parquet(f"{root}/raw").groupBy("data_type", "start_day").agg(F.count("*").alias("n"))


@query("s7_dlq_envelope", "SELECT doc_id, lower(hex(encode(lang))) AS original, 'DESERIALIZATION_ERROR' AS type FROM documents")
def s7(spark, sf):
    docs = v.table(spark, sf, "documents").withColumn("value", F.col("lang").cast("binary"))
    rows = wire.dlq_envelope(docs, "value", F.lit("DESERIALIZATION_ERROR"), F.lit("bad magic byte"), F.lit("2024-01-31T00:00:00Z"), F.create_map(F.lit("source"), F.col("source")))
    return rows.select("doc_id", F.get_json_object("envelope", "$.originalMessage").alias("original"), F.get_json_object("envelope", "$.error.type").alias("type"))


@query("s2_decode_wire", "SELECT event_id, CASE WHEN event_id % 7 <> 0 THEN event_id END AS schema_id, CASE WHEN event_id % 7 <> 0 THEN event_type END AS body, CASE WHEN event_id % 7 = 0 THEN 'DESERIALIZATION_ERROR' END AS wire_error FROM events")
def s2(spark, sf):
    head = F.unhex(F.concat(F.when(F.col("event_id") % 7 == 0, "01").otherwise("00"), F.lpad(F.hex("event_id"), 8, "0")))
    rows = wire.decode_wire(v.table(spark, sf, "events").withColumn("value", F.concat(head, F.col("event_type").cast("binary"))))
    return rows.select("event_id", "schema_id", F.col("body").cast("string").alias("body"), "wire_error")


@query("s11_required", "SELECT count(*) FILTER (user_id % 5 <> 0) AS kept, count(*) FILTER (user_id % 5 = 0) AS quarantined FROM samples", "samples")
def s11(spark, sf):
    good, bad = tables.required(v.samples(spark, sf).withColumn("zone", F.when(F.col("user_id") % 5 != 0, F.col("timezone"))), ["sample_id", "zone"])
    return good.agg(F.count("*").alias("kept")).crossJoin(bad.agg(F.count("*").alias("quarantined")))  # one row each


#: The bucket of a user by the engine's hash of a 64-bit integer, step by step.
_M = "4294967295::HUGEINT"
_ROTATED = lambda x, n: f"((({x}) << {n}) & {_M}) | (({x}) >> {32 - n})"


@query("s19_user_bucket", f"""
, u AS (SELECT DISTINCT user_id, (user_id & 4294967295)::HUGEINT AS low, ((user_id >> 32) & 4294967295)::HUGEINT AS high FROM samples),
a AS (SELECT *, (low * 3432918353) & {_M} AS k, (high * 3432918353) & {_M} AS l FROM u),
b AS (SELECT *, (({_ROTATED('k', 15)}) * 461845907) & {_M} AS m, (({_ROTATED('l', 15)}) * 461845907) & {_M} AS o FROM a),
c AS (SELECT *, xor(42::HUGEINT, m) AS x FROM b),
d AS (SELECT *, xor((({_ROTATED('x', 13)}) * 5 + 3864292196) & {_M}, o) AS y FROM c),
e AS (SELECT *, xor((({_ROTATED('y', 13)}) * 5 + 3864292196) & {_M}, 8::HUGEINT) AS z FROM d),
f AS (SELECT *, (xor(z, z >> 16) * 2246822507) & {_M} AS z2 FROM e),
g AS (SELECT *, (xor(z2, z2 >> 13) * 3266489909) & {_M} AS z3 FROM f)
SELECT user_id, CAST(xor(z3, z3 >> 16) & 15 AS INTEGER) AS user_bucket FROM g""", "samples")
def s19_bucket(spark, sf):
    return tables.transforms(v.samples(spark, sf)).select("user_id", F.col("user_bucket").cast("int").alias("user_bucket")).distinct()


@query("s19_transforms", "SELECT CAST(start_ts AS DATE) AS day, date_trunc('hour', start_ts) AS hour, count(*) AS n FROM samples GROUP BY 1, 2", "samples")
def s19(spark, sf):
    return tables.transforms(v.samples(spark, sf)).groupBy("day", F.col("hour").cast("timestamp_ntz").alias("hour")).agg(F.count("*").alias("n"))
