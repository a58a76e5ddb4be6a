"""Queries of sources, tables, faults and streams, added to the registry."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions import times
from ..operators import aggregate, ingest, metrics, quality, query_api, validate
from ..rules import ALIASES, GATEWAY_RANGES, SEVERITIES
from ..sources import payloads as wire
from ..sources import tables
from ..streaming import calendar, job
from . import views as v
from .registry import _G, _WITH, CHECKED, LOCAL, ROUNDED, SAMPLES, STATS, USER, query, rounded

AS_OF = "1706659200000"
#: What is wrong with each message of ``views.messages``.
FAULTS = """messages AS (
  SELECT *, CASE WHEN sample_id % 11 = 0 THEN 'frame' WHEN sample_id % 11 = 1 THEN 'text' WHEN sample_id % 13 IN (0, 1, 2) THEN 'sample'
    WHEN sample_id % 17 = 3 THEN 'negative_value' WHEN sample_id % 17 = 4 THEN 'start_after_end' WHEN sample_id % 17 = 5 THEN 'invalid_timestamp' END AS fault
  FROM samples)"""
SOUND = "sound AS (SELECT * FROM messages WHERE fault IS NULL)"
_WITH["messages"] = f"{SAMPLES},\n{FAULTS}"
_WITH["sound"] = f"{SAMPLES},\n{FAULTS},\n{SOUND}"


def local(kind: str, source: str) -> str:
    """SQL of calendar statistics of ``source`` by ``kind`` (day, week, month)."""
    return f"SELECT user_id, data_type, timezone, CAST(date_trunc('{kind}', {LOCAL}) AS DATE) AS first_date, {STATS} FROM {source} GROUP BY 1, 2, 3, 4"


# Sources and sinks


@query("s2_messages", "SELECT CASE WHEN fault IN ('frame', 'text') THEN fault ELSE 'read' END AS outcome, count(*) AS n, CAST(sum(CASE WHEN fault = 'frame' THEN 0 ELSE sample_id END) AS BIGINT) AS ids FROM (SELECT sample_id, coalesce(fault, '') AS fault FROM messages) GROUP BY 1", "messages")
def s2(spark: SparkSession, sf: str) -> DataFrame:
    rows = wire.parse_json_body(wire.decode_wire(v.messages(spark, sf)))
    outcome = F.when(F.col("wire_error").isNotNull(), "frame").when(F.col("payload.userId").isNull(), "text").otherwise("read")
    return rows.groupBy(outcome.alias("outcome")).agg(F.count("*").alias("n"), F.coalesce(F.sum("schema_id"), F.lit(0)).alias("ids"))


@query("s3_read_json", "SELECT coalesce(fault, '') = 'text' AS malformed, count(*) AS n FROM (SELECT CASE WHEN sample_id % 11 = 1 THEN 'text' END AS fault FROM samples) GROUP BY 1", "samples")
def s3(spark, sf):
    path = v.work(spark, "json")
    v.messages(spark, sf).select("text").write.text(path)
    good, bad = wire.read_payload_json(spark, path)
    n = lambda df, flag: df.agg(F.lit(flag).alias("malformed"), F.count("*").alias("n"))
    return n(good.where("userId is not null and size(samples) = 1"), False).unionByName(n(bad, True))


@query("s4_publish", "SELECT CAST(user_id AS VARCHAR) AS key, n AS sample_count, count(*) AS messages FROM (SELECT user_id, count(*) AS n FROM samples GROUP BY user_id, date_trunc('hour', start_ts)) GROUP BY 1, 2", "samples")
def s4(spark, sf):
    path = v.work(spark, "published")
    wire.publish_payloads(v.payloads(spark, sf), {"path": path}, "parquet")
    rows = spark.read.schema("key binary, value binary, headers array<struct<key string, value binary>>").parquet(path)
    header = F.filter("headers", lambda h: h["key"] == "sample-count")[0]["value"].cast("string").cast("long")
    return rows.groupBy(F.col("key").cast("string").alias("key"), header.alias("sample_count")).agg(F.count("*").alias("messages"))


@query("s6_write_errors", "SELECT DATE '2024-01-31' AS error_day, 'VALIDATION_ERROR' AS error_type, reject_reason AS error_message, count(*) AS n FROM checked WHERE reject_reason IS NOT NULL GROUP BY 3", "checked")
def s6(spark, sf):
    from .registry import checked

    path = v.work(spark, "errors")
    _, bad = validate.split(checked(spark, sf))
    tables.write_errors(validate.error_records(bad, "VALIDATION_ERROR", F.lit(v.AS_OF_MS)), path)
    return spark.read.schema(f"{schemas.ERROR}, error_day date").parquet(path).groupBy("error_day", "error_type", "error_message").agg(F.count("*").alias("n"))


_STORED = {kind: f"SELECT data_type, CAST({year} AS INTEGER) AS year, count(*) AS windows, round(sum(avg_value), 4) AS avg_total, CAST(sum(record_count) AS BIGINT) AS records FROM {kind} GROUP BY 1, 2" for kind, year in (("daily", "year(aggregation_date)"), ("weekly", "isoyear(week_start_date)"), ("monthly", "year"))}


def _totals(df: DataFrame) -> DataFrame:
    return df.groupBy("data_type", "year").agg(F.count("*").alias("windows"), F.round(F.sum("avg_value"), 4).alias("avg_total"), F.sum("record_count").alias("records"))


@query("s8_stored_daily", _STORED["daily"], "daily")
def s8_daily(spark, sf):
    return _totals(v.stored(spark, sf, "daily"))


@query("s8_stored_weekly", _STORED["weekly"], "weekly")
def s8_weekly(spark, sf):
    return _totals(v.stored(spark, sf, "weekly"))


@query("s8_stored_monthly", _STORED["monthly"], "monthly")
def s8_monthly(spark, sf):
    return _totals(v.stored(spark, sf, "monthly"))


@query("s10_overwrite", "SELECT data_type, count(*) AS n, round(sum(CASE WHEN data_type = 'steps' THEN value * 2 ELSE value END), 4) AS total FROM samples GROUP BY 1", "samples")
def s10(spark, sf):
    path = v.work(spark, "overwrite")
    rows = v.samples(spark, sf).drop("start_ts", "props")
    tables.write_raw(rows, path)
    tables.write_raw(rows.where("data_type = 'steps'").withColumn("value", F.col("value") * 2), path, "overwrite")
    return spark.read.schema("value double, start_day date, data_type string").parquet(path).groupBy("data_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))


@query("s12_file_target", "SELECT data_type, count(*) AS n, CAST(ceil(count(*) / 100.0) AS BIGINT) AS n_files, least(100, count(*)) AS largest FROM samples GROUP BY 1", "samples")
def s12(spark, sf):
    """Files of a hundred rows; how many rows fill a file of a size is read from files that are there."""
    path = v.work(spark, "target")
    rows = v.samples(spark, sf).drop("start_ts", "props")
    tables.write_partitioned(rows, path, ["data_type"], records_per_file=100)
    stored = spark.read.schema("sample_id long, data_type string").parquet(path)
    if not 90 <= tables.records_stored(stored, 100 * tables.file_sizes(stored).first()["bytes"] // rows.count()) <= 110:
        raise AssertionError("rows of a file don't follow the files' size")
    files = stored.groupBy("data_type", F.col("_metadata.file_path").alias("f")).agg(F.count("*").alias("n"))
    return files.groupBy("data_type").agg(F.sum("n").alias("n"), F.count("*").alias("n_files"), F.max("n").alias("largest"))


def _database(spark: SparkSession, sf: str) -> str:
    """A database of the declared tables, with the daily aggregates of the data in it."""
    name = f"vitals_{uuid.uuid4().hex}"
    declared = {"raw": (f"{schemas.MEASUREMENT}, start_day date", tables.RAW_PARTITIONS), "errors": (f"{schemas.ERROR}, error_day date", tables.ERROR_PARTITIONS), "daily": (schemas.DAILY, ["data_type"]), "weekly": (schemas.WEEKLY, ["data_type"]), "monthly": (schemas.MONTHLY, ["data_type"])}
    tables.create_tables(spark, name, declared, v.work(spark, "database"))
    days = v.daily(spark, sf).withColumns({"user_id": F.col("user_id").cast("string"), "updated_at": F.lit(v.AS_OF_MS)})
    days.select(*spark.table(f"{name}.daily").columns).write.mode("append").insertInto(f"{name}.daily")
    return name


@query("s13_scan", f"SELECT CAST(user_id AS VARCHAR) AS user_id, data_type, round(avg_value, 7) AS avg_value FROM daily WHERE data_type = 'steps' AND max_value > 90", "daily")
def s13(spark, sf):
    where = query_api.predicates([("data_type", "==", "steps"), ("max_value", ">", 90.0)])
    return tables.scan(spark, "daily", _database(spark, sf), where, ["user_id", "data_type", "avg_value"]).withColumn("avg_value", F.round("avg_value", 7))


@query("s16_tables", "SELECT t.table_name, CASE WHEN t.table_name = 'daily' THEN (SELECT count(*) FROM daily) ELSE 0 END AS n FROM (VALUES ('daily'), ('errors'), ('monthly'), ('raw'), ('weekly')) t(table_name)", "daily")
def s16(spark, sf):
    name = _database(spark, sf)
    listed = tables.list_tables(spark, name)
    parts = [spark.table(f"{name}.{t}").agg(F.lit(t).alias("table_name"), F.count("*").alias("n")) for t in ("raw", "errors", "daily", "weekly", "monthly")]
    counts = parts[0]
    for p in parts[1:]:
        counts = counts.unionByName(p)
    return listed.join(counts, "table_name")


@query("s17_compact", "SELECT data_type, count(*) AS n, round(sum(value), 4) AS total, count(DISTINCT sample_id % 8) AS files_before, CASE WHEN count(DISTINCT sample_id % 8) > 0 THEN 1 END AS files_after FROM samples GROUP BY 1", "samples")
def s17(spark, sf):
    """Types lie in a file for each of eight writers before, and in one after, as all of a type is less than the target."""
    root, target = v.work(spark, "compact"), 1 << 28
    i = F.col("sample_id") % 8
    for writer in range(8):
        v.samples(spark, sf).drop("start_ts").where(i == writer).coalesce(1).write.mode("append").partitionBy("data_type").parquet(f"{root}/t")
    stored = lambda: spark.read.schema("sample_id long, value double, data_type string").parquet(f"{root}/t")
    before = [(r.data_type, r.n_files) for r in tables.partition_sizes(stored(), ["data_type"]).collect()]  # five types
    tables.compact(spark, f"{root}/t", ["data_type"], f"{root}/staging", target)
    rows = stored()
    sizes = tables.partition_sizes(rows, ["data_type"]).select("data_type", F.col("n_files").cast("int").alias("files_after")).join(spark.createDataFrame(before, "data_type string, files_before long"), "data_type")
    return rows.groupBy("data_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total")).join(sizes, "data_type")


@query("s18_file_sizes", "SELECT count(*) AS n, count(DISTINCT (CAST(start_ts AS DATE), data_type)) AS n_files, sum(CASE WHEN sample_id IS NOT NULL THEN 1 END) > 0 AS has_bytes FROM samples", "samples")
def s18(spark, sf):
    path = v.work(spark, "sizes")
    tables.write_raw(v.samples(spark, sf).drop("start_ts", "props"), path)
    rows = spark.read.schema("sample_id long, start_day date, data_type string").parquet(path)
    size = tables.file_sizes(rows).select("n_files", (F.col("bytes") > 100 * F.col("n_files")).alias("has_bytes"))
    return rows.agg(F.count("*").alias("n")).withColumn("k", F.lit(1)).join(size.withColumn("k", F.lit(1)), "k").drop("k")  # one row each


@query("s20_migrate", "SELECT sample_id, value AS reading, CAST(user_id % 100 AS BIGINT) AS bucket, CAST(NULL AS VARCHAR) AS note FROM samples", "samples")
def s20(spark, sf):
    path = v.work(spark, "migrate")
    v.samples(spark, sf).select("sample_id", "value", (F.col("user_id") % 100).cast("int").alias("bucket"), "props").write.parquet(f"{path}/old")
    rows, _ = tables.migrate(spark.read.parquet(f"{path}/old"), [("add", "note", "string"), ("rename", "value", "reading"), ("widen", "bucket", "bigint"), ("drop", "props"), ("optional", "reading")])
    rows.write.parquet(f"{path}/new")
    return spark.read.schema(rows.schema).parquet(f"{path}/new").select("sample_id", "reading", "bucket", "note")


# Faults


@query("f3_bad_samples", "SELECT CAST(sample_id AS VARCHAR) AS sample_id, data_type, coalesce(fault, 'none') AS fault FROM messages WHERE fault IS NULL OR fault NOT IN ('frame', 'text', 'sample')", "messages")
def f3(spark, sf):
    flat, _ = job.decoded(v.messages(spark, sf), F.lit(v.AS_OF_MS))
    return job.timed(flat).select("sample_id", "data_type", F.coalesce("reject_reason", F.lit("none")).alias("fault"))


@query("f4_missing_fields", "SELECT sample_id, CASE WHEN sample_id % 5 < 3 THEN 'missing_field' WHEN sample_id % 5 = 3 THEN 'unknown_type' ELSE reject_reason END AS reject_reason FROM checked", "checked")
def f4(spark, sf):
    from .. import rules

    i = F.col("sample_id") % 5
    rows = v.samples(spark, sf).withColumns({"user_id": F.when(i != 0, F.col("user_id")), "data_type": F.when(i == 1, "  ").when(i == 3, "unheardOf").otherwise(F.col("data_type")), "end_date": F.when(i != 2, F.col("end_date")), "value": F.when(i == 3, 1.0).otherwise(F.col("value"))})
    return validate.validate_full(rows, rules.ranges(spark, "record"), strict=True).select("sample_id", "reject_reason")


_TYPES = [*SEVERITIES, "SOMETHING_ELSE"]


@query("f15_error_classes", "SELECT sample_id, ['LOW', 'MEDIUM', 'HIGH', 'HIGH', 'CRITICAL', 'MEDIUM'][CAST(sample_id % 6 AS INTEGER) + 1] AS severity, sample_id % 6 IN (2, 3) AS retryable, CASE WHEN sample_id % 7 = 0 THEN 'unknown' ELSE data_type END AS data_type_partition FROM samples", "samples")
def f15(spark, sf):
    rows = v.samples(spark, sf).withColumns({"error_type": F.element_at(F.array(*map(F.lit, _TYPES)), (F.col("sample_id") % 6 + 1).cast("int")), "data_type": F.when(F.col("sample_id") % 7 != 0, F.col("data_type"))})
    return validate.with_error_class(rows).select("sample_id", "severity", "retryable", "data_type_partition")


@query("st3_timestamps", "SELECT sample_id, CASE WHEN sample_id % 4 < 2 THEN 'invalid_timestamp' WHEN start_date > end_date THEN 'start_after_end' END AS reject_reason FROM samples", "samples")
def st3(spark, sf):
    i = F.col("sample_id") % 4
    at = F.when(i == 0, F.timestamp_millis(F.lit(-5))).when(i > 1, F.col("start_ts"))
    return job.timed(v.samples(spark, sf).withColumn("start_ts", at)).select("sample_id", "reject_reason")


# Times


@query("d5_window_ends", f"SELECT sample_id, epoch_ms((date_trunc('day', {LOCAL}) + INTERVAL 1 DAY) AT TIME ZONE timezone) - 1 AS day_end, epoch_ms((date_trunc('week', {LOCAL}) + INTERVAL 7 DAY) AT TIME ZONE timezone) - 1 AS week_end, CAST(date_trunc('month', {LOCAL}) AS DATE) AS month_first, last_day(CAST({LOCAL} AS DATE)) AS month_last FROM samples", "samples")
def d5(spark, sf):
    w = {kind: times.local_window(F.col("start_ts"), F.col("timezone"), kind) for kind in times.UNITS}
    return v.samples(spark, sf).select("sample_id", w["daily"].inclusive_end_ms.alias("day_end"), w["weekly"].inclusive_end_ms.alias("week_end"), w["monthly"].first_date.alias("month_first"), w["monthly"].last_date.alias("month_last"))


@query("d9_fixed_windows", "SELECT sample_id, epoch_ms(date_trunc('day', start_ts)) AS day_start, epoch_ms(date_trunc('week', start_ts) + INTERVAL 7 DAY) AS week_end, epoch_ms(date_trunc('month', start_ts)) AS month_start FROM samples", "samples")
def d9(spark, sf):
    w = {kind: times.utc_window(F.col("start_ts"), kind) for kind in times.UNITS}
    return v.samples(spark, sf).select("sample_id", w["daily"].start_ms.alias("day_start"), w["weekly"].end_ms.alias("week_end"), w["monthly"].start_ms.alias("month_start"))


@query("d10_millis_to_iso", "SELECT sample_id, strftime(make_timestamp(start_date * 1000), '%Y-%m-%dT%H:%M:%S.%g') || '+00:00' AS iso, CASE WHEN sample_id % 3 = 0 THEN NULL ELSE strftime(make_timestamp(start_date * 1000), '%Y-%m-%dT%H:%M:%S.%g') || 'Z' END AS either FROM samples", "samples")
def d10(spark, sf):
    i, ms = F.col("sample_id") % 3, F.col("start_date")
    text = F.when(i == 0, "soon").when(i == 1, times.millis_to_iso(ms)).otherwise(F.concat((ms / 1000).cast("decimal(20,3)").cast("string")))
    return v.samples(spark, sf).select("sample_id", times.millis_to_iso(ms).alias("iso"), times.number_or_iso_to_iso(text).alias("either"))


@query("d17_parse_keys", """SELECT sample_id, CASE WHEN sample_id % 4 = 0 THEN NULL ELSE CAST(isoyear(start_ts) * 100 + week(start_ts) AS INTEGER) END AS week, CASE WHEN sample_id % 4 = 1 THEN NULL ELSE CAST(year(start_ts) * 100 + month(start_ts) AS INTEGER) END AS month,
  CASE WHEN sample_id % 4 = 2 THEN NULL ELSE CAST(start_ts AS DATE) END AS day FROM samples""", "samples")
def d17(spark, sf):
    d, i = F.to_date("start_ts"), F.col("sample_id") % 4
    week = times.parse_week(F.when(i == 0, "2024-W54").otherwise(times.window_key(d, "weekly")))
    month = times.parse_month(F.when(i == 1, "2024-13").otherwise(times.window_key(d, "monthly")))
    day = times.parse_date(F.when(i == 2, "2024-02-30").otherwise(times.window_key(d, "daily")))
    return v.samples(spark, sf).select("sample_id", (week["year"] * 100 + week["week"]).alias("week"), (month["year"] * 100 + month["month"]).alias("month"), day.alias("day"))


# Aggregates and metrics


@query("a2_nan_and_null", """SELECT user_id, data_type, count(x) AS count, round(sum(x), 4) AS sum_value, min(x) AS min_value, max(x) AS max_value, round(avg(x), 7) AS avg_value, round(stddev_pop(x - 1e6), 3) AS stddev_value,
  first(x ORDER BY start_ts, sample_id) FILTER (x IS NOT NULL) AS first_value, last(x ORDER BY start_ts, sample_id) FILTER (x IS NOT NULL) AS last_value, count(*) AS record_count
FROM (SELECT *, CASE WHEN sample_id % 5 > 1 THEN value + 1e6 END AS x FROM samples) GROUP BY 1, 2""", "samples")
def a2_nan(spark, sf):
    i = F.col("sample_id") % 5
    rows = v.samples(spark, sf).withColumn("value", F.when(i == 0, F.lit(float("nan"))).when(i > 1, F.col("value") + 1e6))
    parts = aggregate.partials(rows, ["user_id", "data_type", F.to_date("start_ts").alias("day")])
    out = aggregate.finished(aggregate.merged(parts, ["user_id", "data_type"]))
    return out.withColumns({"sum_value": F.round("sum_value", 4), "avg_value": F.round("avg_value", 7), "stddev_value": F.round("stddev_value", 3)}).withColumn("stddev_value", F.when(F.col("count") > 0, F.col("stddev_value")))


@query("a20_latency_percentiles", "SELECT data_type, quantile_disc(l, 0.5) AS p50, quantile_disc(l, 0.95) AS p95, quantile_disc(l, 0.99) AS p99 FROM (SELECT data_type, end_date - start_date - 60000 AS l FROM samples) WHERE l >= 0 GROUP BY 1", "samples")
def a20(spark, sf):
    rows = v.samples(spark, sf).withColumn("latency_ms", F.col("end_date") - F.col("start_date") - 60000)
    return metrics.latency(rows, "latency_ms", "data_type").select("data_type", "p50", "p95", "p99")


_LATE = f"{CHECKED}, o AS (SELECT *, max(floor(epoch(start_ts))) OVER (PARTITION BY user_id % 8 ORDER BY end_date, sample_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 60 AS w FROM checked)"


def _late(spark: SparkSession, sf: str) -> DataFrame:
    from .registry import checked

    rows = checked(spark, sf).withColumn("source", F.col("user_id") % 8)
    return metrics.late_events(rows, F.struct("end_date", "sample_id"), "start_ts", 60, "source", F.floor(F.col("end_date") / 3_600_000))


@query("a26_all_rates", f""", {_LATE}
SELECT time_bucket(INTERVAL 5 MINUTE, start_ts) AS window_start, round(count(*) / 300, 6) AS per_second, round(count(reject_reason) * 100 / nullif(count(*) - count(reject_reason), 0), 6) AS error_percent, count(*) AS records_per_window,
  round(count(*) FILTER (floor(epoch(start_ts)) < w) * 100 / count(*), 6) AS late_percent FROM o GROUP BY 1""", "samples")
def a26(spark, sf):
    rows = metrics.rates(_late(spark, sf)).withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))
    return rows.withColumns({c: F.round(c, 6) for c in ("per_second", "error_percent", "late_percent")})


@query("a26_errors_by_type", "SELECT time_bucket(INTERVAL 5 MINUTE, start_ts) AS window_start, data_type, reject_reason, count(*) AS errors FROM checked WHERE reject_reason IS NOT NULL GROUP BY 1, 2, 3", "checked")
def a26_types(spark, sf):
    from .registry import checked

    _, bad = validate.split(checked(spark, sf))
    return bad.groupBy(F.window("start_ts", "5 minutes").start.cast("timestamp_ntz").alias("window_start"), "data_type", "reject_reason").agg(F.count("*").alias("errors"))


_LIMITS = {"error_rate": 0.005, "failure_share": 0.4, "p95_latency_ms": 550_000.0, "throughput": 0.008, "write_failures": 1.0, "window_latency_ms": 300_000.0}


@query("q12_all_alerts", f""", g AS (SELECT time_bucket(INTERVAL 1 HOUR, start_ts) AS window_start, count(*) AS n, count(reject_reason) AS bad, quantile_disc(end_date - start_date, 0.95) AS p, max(end_date) AS last FROM checked GROUP BY 1),
m AS (SELECT window_start, 'error_rate' AS alert, bad / 3600 AS value FROM g UNION ALL SELECT window_start, 'failure_share', bad / n FROM g UNION ALL SELECT window_start, 'p95_latency_ms', p FROM g UNION ALL SELECT window_start, 'throughput', n / 3600 FROM g
  UNION ALL SELECT window_start, 'write_failures', bad FROM g UNION ALL SELECT window_start, 'window_latency_ms', last - epoch_ms(window_start + INTERVAL 1 HOUR) FROM g)
SELECT window_start, alert, round(CAST(value AS DOUBLE), 6) AS value FROM m WHERE CASE alert {' '.join(f"WHEN '{k}' THEN value {'<' if k == 'throughput' else '>'} {x}" for k, x in _LIMITS.items())} END""", "checked")
def q12(spark, sf):
    from .registry import checked

    rows = checked(spark, sf).select(F.window("start_ts", "1 hour").alias("w"), "reject_reason", "end_date", (F.col("end_date") - F.col("start_date")).alias("latency_ms"))
    g = rows.groupBy("w").agg(F.count("*").alias("n"), F.count("reject_reason").alias("bad"), F.max("end_date").alias("last"))
    g = metrics.with_percentiles(g, rows, "latency_ms", ["w"], {"p": 0.95})
    values = {"error_rate": F.col("bad") / 3600, "failure_share": F.col("bad") / F.col("n"), "p95_latency_ms": F.col("p"), "throughput": F.col("n") / 3600, "write_failures": F.col("bad"), "window_latency_ms": F.col("last") - F.unix_millis("w.end")}
    pairs = [x for k, c in values.items() for x in (F.lit(k), c.cast("double"))]
    rows = g.select(F.col("w.start").cast("timestamp_ntz").alias("window_start"), F.explode(F.create_map(*pairs)).alias("metric", "value"))
    return quality.alerts(rows, _LIMITS).withColumn("value", F.round("value", 6))


@query("r5_empty_envelope", f"SELECT user_id, data_type, (SELECT count(*) FROM daily d WHERE d.user_id = u.user_id AND d.data_type = u.data_type) AS count FROM (SELECT {USER} AS user_id, data_type FROM samples GROUP BY 2 UNION ALL SELECT -1, data_type FROM samples GROUP BY 2) u", "daily")
def r5_empty(spark, sf):
    kinds = v.samples(spark, sf).select("data_type").distinct()
    wanted = kinds.withColumn("user_id", F.explode(F.array(F.lit(USER), F.lit(-1))))
    rows = v.stored(spark, sf, "daily").select("user_id", "data_type", "aggregation_date", "avg_value").join(wanted, ["user_id", "data_type"], "left_semi")
    out = query_api.envelope(rows, ["user_id", "data_type"], wanted.select(F.col("user_id").cast("long").alias("user_id"), "data_type"))
    return out.where(F.size("records") == F.col("count")).select("user_id", "data_type", "count")


# Streams


def _closed(spark: SparkSession, sf: str, kind: str) -> DataFrame:
    """Windows that timers closed: a second file holds one far later sample, which moves the watermark past all of them."""
    root = v.work(spark, f"timers-{kind}")
    calendar.rocksdb(spark)
    rows = v.samples(spark, sf).select("sample_id", "user_id", "data_type", "timezone", "start_ts", "value")
    rows.write.parquet(f"{root}/in")
    late = rows.limit(1).withColumns({"user_id": F.lit(-1).cast("long"), "start_ts": F.lit("2024-06-01 00:00:00").cast("timestamp")})
    schema = "sample_id long, user_id long, data_type string, timezone string, start_ts timestamp, value double"
    for step in (rows.limit(0), late):
        step.coalesce(1).write.mode("append").parquet(f"{root}/in")
        stream = spark.readStream.schema(schema).parquet(f"{root}/in")
        q = calendar.closing_windows(stream, kind).writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start()
        q.awaitTermination()
    return spark.read.schema(calendar.OUTPUT).parquet(f"{root}/out").where("user_id >= 0")


def _timers(kind: str, unit: str):
    name = {"daily": "st6", "weekly": "st8", "monthly": "st7"}[kind]
    sql = f"SELECT user_id, data_type, timezone, first_date, {ROUNDED} FROM ({local(unit, 'samples')})".replace(", record_count FROM (", " FROM (")

    @query(f"{name}_timers_{kind}", sql, "samples")
    def timers(spark, sf):
        first = F.to_date(F.from_utc_timestamp(F.timestamp_millis("window_start"), F.col("timezone"))).alias("first_date")
        return rounded(_closed(spark, sf, kind)).select("user_id", "data_type", "timezone", first, "count", "sum_value", "min_value", "max_value", "avg_value", "stddev_value", "first_value", "last_value")


for _kind, _unit in (("daily", "day"), ("weekly", "week"), ("monthly", "month")):
    _timers(_kind, _unit)


@query("st5_lateness", f"SELECT data_type, count(*) AS n, CAST(sum(count) AS BIGINT) AS records FROM ({local('week', '(SELECT * REPLACE (user_id % 5 AS user_id) FROM samples)')}) GROUP BY 1", "samples")
def st5(spark, sf):
    """Rows that come after others of later windows, but within the allowed lateness of six hours, are in their windows."""
    root, schema = v.work(spark, "lateness"), "sample_id long, user_id long, data_type string, timezone string, start_ts timestamp, value double"
    calendar.rocksdb(spark)
    rows = v.samples(spark, sf).select("sample_id", "user_id", "data_type", "timezone", "start_ts", "value").withColumn("user_id", F.col("user_id") % 5)
    late = F.col("start_ts").between(F.lit("2024-01-14 19:00:00"), F.lit("2024-01-15 00:00:00"))  # up to a week's end in UTC
    end = rows.limit(1).withColumns({"user_id": F.lit(-1).cast("long"), "start_ts": F.lit("2024-06-01 00:00:00").cast("timestamp")})
    before = F.col("start_ts") < F.lit("2024-01-15 00:30:00")
    for step in (rows.where(before & ~late), rows.where(late), rows.where(~before & ~late), end):
        step.coalesce(1).write.mode("append").parquet(f"{root}/in")
        stream = spark.readStream.schema(schema).parquet(f"{root}/in")
        calendar.closing_windows(stream, "weekly").writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    out = spark.read.schema(calendar.OUTPUT).parquet(f"{root}/out").where("user_id >= 0")
    return out.groupBy("data_type").agg(F.count("*").alias("n"), F.sum("count").alias("records"))


_jobs: dict[tuple[str, str], str] = {}


def _job(spark: SparkSession, sf: str) -> str:
    """The root of one run of the whole job over ``views.messages``, in several batches, once in an application."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _jobs:
        root = v.work(spark, "whole-job")
        v.messages(spark, sf).select("value").repartition(4, F.xxhash64("value")).write.parquet(f"{root}/in")
        stream = wire.read_payload_stream(spark, f"{root}/in", max_files=2)
        job.start(stream, f"{root}/out", f"{root}/checkpoint", fixed=True, payloads=True, now_ms=F.lit(v.AS_OF_MS)).awaitTermination()
        _jobs[key] = f"{root}/out"
    return _jobs[key]


_FIRST = {"daily": "aggregation_date", "weekly": "week_start_date", "monthly": "month_start_date"}
_PARTS = {"daily": "", "weekly": "year int, week_of_year int, ", "monthly": "year int, month int, "}


def _branch_schema(kind: str) -> str:
    return f"{_PARTS[kind]}user_id string, data_type string, timezone string, {_FIRST[kind]} date, count long, sum_value double, min_value double, max_value double, avg_value double, stddev_value double, first_value double, last_value double, record_count long"


def _branch(kind: str, unit: str):
    @query(f"st19_job_{kind}", f"SELECT CAST(user_id AS VARCHAR) AS user_id, data_type, timezone, first_date, {ROUNDED} FROM ({local(unit, 'sound')})", "sound")
    def branch(spark, sf):
        return rounded(spark.read.schema(_branch_schema(kind)).parquet(f"{_job(spark, sf)}/{kind}")).withColumnRenamed(_FIRST[kind], "first_date").drop("year", "week_of_year", "month")


for _kind, _unit in (("daily", "day"), ("weekly", "week"), ("monthly", "month")):
    _branch(_kind, _unit)


@query("st18_side_by_side", f""", f AS (SELECT user_id, data_type, CAST(start_ts AS DATE) AS first_date, avg(value) AS a, count(*) AS n FROM sound GROUP BY 1, 2, 3), c AS ({local('day', 'sound')})
SELECT CAST(user_id AS VARCHAR) AS user_id, data_type, first_date, round(a, 7) AS fixed_avg, round(avg_value, 7) AS calendar_avg, n - count AS more FROM f JOIN c USING (user_id, data_type, first_date)""", "sound")
def st18(spark, sf):
    root, stats = _job(spark, sf), "user_id string, data_type string, aggregation_date date, avg_value double, count long"
    fixed, days = (spark.read.schema(stats).parquet(f"{root}/{x}") for x in ("fixed", "daily"))
    rows = fixed.alias("f").join(days.alias("c"), ["user_id", "data_type", "aggregation_date"])
    return rows.select("user_id", "data_type", F.col("aggregation_date").alias("first_date"), F.round("f.avg_value", 7).alias("fixed_avg"), F.round("c.avg_value", 7).alias("calendar_avg"), (F.col("f.count") - F.col("c.count")).alias("more"))


@query("st19_job_errors", "SELECT CASE WHEN fault IN ('frame', 'text') THEN 'DESERIALIZATION_ERROR' ELSE 'VALIDATION_ERROR' END AS error_type, CASE WHEN fault IN ('frame', 'text') THEN 'message can''t be read' ELSE fault END AS error_message, DATE '2024-01-31' AS error_day, count(*) AS n FROM messages WHERE fault IS NOT NULL AND fault <> 'sample' GROUP BY 1, 2", "messages")
def st19_errors(spark, sf):
    return job.errors(spark, _job(spark, sf)).groupBy("error_type", "error_message", "error_day").agg(F.count("*").alias("n"))


@query("st19_job_raw", "SELECT CAST(sample_id AS VARCHAR) AS sample_id, data_type, value, CAST(start_ts AS DATE) AS start_day FROM sound", "sound")
def st19_raw(spark, sf):
    return spark.read.schema("sample_id string, data_type string, value double, start_day date, batch long").parquet(f"{_job(spark, sf)}/raw").drop("batch")


@query("a25_sink_statistics", f"""
SELECT count(DISTINCT sample_id % 2) AS batches, count(*) FILTER (coalesce(fault, '') <> 'sample') AS records, count(*) FILTER (fault IS NOT NULL AND fault <> 'sample') AS errors,
  (SELECT count(*) FROM (SELECT DISTINCT sample_id % 2, user_id, data_type, timezone, CAST({LOCAL} AS DATE) FROM sound)) AS upserts
FROM messages""", "sound")
def a25(spark, sf):
    """A job's totals over two batches; each writes the days that its sound rows touch."""
    root, rows = v.work(spark, "statistics"), v.messages(spark, sf)
    write = job.batch_writer(root, ("daily",), payloads=True, now_ms=F.lit(v.AS_OF_MS))
    for half in (0, 1):
        write(rows.where(F.col("sample_id") % 2 == half).select("value"), half)
    return metrics.sink_statistics(spark.read.schema(job.METRICS).parquet(f"{root}/metrics"))


# Whole rows of what other queries count


@query("f2_all_columns", """SELECT 'device-' || user_id AS device_id, CAST(user_id AS VARCHAR) AS user_id, CAST(sample_id AS VARCHAR) AS sample_id, data_type, value, 'count' AS unit, start_date, end_date,
  CASE WHEN sample_id % 3 = 0 THEN 'org.example.app' END AS source_bundle, 'ko_KR' AS locale, sample_id % 2 = 0 AS is_synced, CASE WHEN sample_id % 5 = 0 THEN start_date ELSE 1706659200000 END AS created_at,
  epoch_ms(date_trunc('hour', start_ts)) AS payload_timestamp, '1.0' AS app_version, 1706659200000 AS processing_time, CASE WHEN sample_id % 7 = 0 THEN 'UTC' ELSE timezone END AS timezone, CASE WHEN sample_id % 7 = 1 THEN 540 END AS timezone_offset
FROM samples WHERE user_id % 50 <> 7""", "samples")
def f2_all(spark, sf):
    """All columns of flat measurements; of the optional fields some are there and some are not."""
    i = lambda s: s["id"].cast("long")
    changed = {
        "sourceBundle": lambda s: F.when(i(s) % 3 == 0, "org.example.app"),
        "isSynced": lambda s: F.when(i(s) % 2 == 0, True),
        "createdAt": lambda s: F.when(i(s) % 5 == 0, s["startDate"]),
        "timezone": lambda s: F.when(i(s) % 7 != 0, s["timezone"]),
        "timezoneOffset": lambda s: F.when(i(s) % 7 == 1, 540),
    }

    def sample(s):
        for name, value in changed.items():
            s = s.withField(name, value(s))
        return s

    rows = v.stored_payloads(spark, sf).withColumn("samples", F.transform("samples", sample))
    rows = ingest.flatten(ingest.sanitise(rows), F.lit(v.AS_OF_MS))
    return rows.withColumn("locale", F.try_element_at("metadata", F.lit("locale"))).drop("metadata")


@query("f11_error_rows", f""", numbered AS (SELECT *, CAST(row_number() OVER (PARTITION BY user_id, date_trunc('hour', start_ts) ORDER BY sample_id) - 1 AS INTEGER) AS place, date_trunc('hour', start_ts) AS hour FROM samples)
SELECT CAST(user_id AS VARCHAR) AS user_id, hour, place, data_type, 'not a number' AS error FROM numbered WHERE sample_id % 19 = 0
UNION ALL SELECT CAST(user_id AS VARCHAR), hour, place, data_type, 'out of range' FROM numbered WHERE sample_id % 19 <> 0 AND {_G}
UNION ALL SELECT CAST(user_id AS VARCHAR), hour, place, data_type, 'not positive' FROM numbered WHERE sample_id % 19 <> 0 AND value <= 0 AND data_type <> 'bodyTemperature'""", "samples")
def f11_rows(spark, sf):
    """Each fault of each sample with the sample's place in its payload."""
    no_number = lambda s: s.withField("value", F.when(s["id"].cast("long") % 19 == 0, "n/a").otherwise(s["value"]))
    rows = ingest.payload_errors(v.stored_payloads(spark, sf).withColumn("samples", F.transform("samples", no_number)), GATEWAY_RANGES)
    rows = rows.select("userId", "timestamp", F.explode("errors").alias("e"))
    return rows.select(F.col("userId").alias("user_id"), F.to_timestamp("timestamp").cast("timestamp_ntz").alias("hour"), F.col("e.index").alias("place"), F.col("e.type").alias("data_type"), F.col("e.error").alias("error"))


@query("f12_rejected_types", "SELECT CAST(user_id AS VARCHAR) AS user_id, date_trunc('hour', start_ts) AS hour, user_id % 10 <> 3 AND bool_and(sample_id % 13 <> 0) AS accepted FROM samples GROUP BY user_id, 2", "samples")
def f12_rejected(spark, sf):
    """Payloads with unknown types or no samples at all are not accepted; other names of known types are."""
    i = lambda s: s["id"].cast("long")
    other = next(iter(ALIASES.values()))
    kind = lambda s: s.withField("type", F.when(i(s) % 13 == 0, "shoeSize").when(i(s) % 13 == 1, other).otherwise(s["type"]))
    rows = v.stored_payloads(spark, sf).withColumn("samples", F.filter(F.transform("samples", kind), lambda s: F.col("userId").cast("long") % 10 != 3))
    return rows.select(F.col("userId").alias("user_id"), F.to_timestamp("timestamp").cast("timestamp_ntz").alias("hour"), ingest.accepted_types(rows).alias("accepted"))


@query("s14_iso_text", """SELECT sample_id, strftime(start_ts, '%Y-%m-%d') AS day, CASE WHEN sample_id % 3 = 0 THEN NULL
  WHEN sample_id % 4 = 0 THEN strftime(date_trunc('second', start_ts), '%Y-%m-%dT%H:%M:%S') ELSE strftime(date_trunc('second', start_ts) + INTERVAL 1 MICROSECOND * (sample_id % 4 * 1000 + 5), '%Y-%m-%dT%H:%M:%S.%f') END AS at FROM samples""", "samples")
def s14(spark, sf):
    i = F.col("sample_id")
    part = F.timestamp_micros(F.unix_micros(F.date_trunc("second", "start_ts")) + F.when(i % 4 == 0, 0).otherwise(i % 4 * 1000 + 5))
    return query_api.as_text(v.samples(spark, sf).select("sample_id", F.to_date("start_ts").alias("day"), F.when(i % 3 != 0, part).alias("at")))


@query("s21_drift", """SELECT name, change, breaking_backward, breaking_forward, CASE name WHEN 'value' THEN (SELECT count(value) FROM samples) WHEN 'zone' THEN (SELECT count(*) FROM samples WHERE sample_id % 3 <> 0)
  WHEN 'bucket' THEN (SELECT count(*) FROM samples) WHEN 'sample_id' THEN (SELECT count(*) FROM samples) END AS stored_values
FROM (VALUES ('sample_id', 'none', false, false), ('bucket', 'widened', false, true), ('value', 'type_changed', true, true), ('zone', 'removed', true, false), ('note', 'added', false, false)) t(name, change, breaking_backward, breaking_forward)""", "samples")
def s21(spark, sf):
    """What changes between two versions of a stored table, and how many stored values each change meets."""
    path = v.work(spark, "drift")
    i = F.col("sample_id")
    old = v.samples(spark, sf).select("sample_id", (i % 100).cast("int").alias("bucket"), "value", F.when(i % 3 != 0, F.col("timezone")).alias("zone"))
    old.write.parquet(f"{path}/old")
    stored = spark.read.schema(old.schema).parquet(f"{path}/old")
    new, _ = tables.migrate(stored, [("widen", "bucket", "bigint"), ("drop", "zone"), ("add", "note", "string")])
    new.withColumn("value", F.col("value").cast("string")).write.parquet(f"{path}/new")
    of = lambda name: tables.fields(spark, spark.read.parquet(f"{path}/{name}").schema)
    report = lambda mode: tables.drift(of("old"), of("new"), mode).withColumnRenamed("breaking", f"breaking_{mode.lower()}")
    counts = stored.agg(*[F.count(c).alias(c) for c in stored.columns]).unpivot([], stored.columns, "name", "stored_values")
    return report("BACKWARD").join(report("FORWARD"), ["name", "change"]).join(counts, "name", "left")


@query("t4_scan_limit", "SELECT least(50, count(*)) AS n, least(1, count(*)) AS n_types FROM daily WHERE data_type = 'steps'", "daily")
def t4(spark, sf):
    """The limit of a scan is the feature: any 50 rows that fit."""
    rows = tables.scan(spark, "daily", _database(spark, sf), F.col("data_type") == "steps", ["user_id", "data_type"], limit=50)
    return rows.agg(F.count("*").alias("n"), F.count_distinct("data_type").alias("n_types"))


@query("st14_repeated_batch", f"SELECT CAST(user_id AS VARCHAR) AS user_id, data_type, timezone, first_date, {ROUNDED} FROM ({local('day', 'sound')})", "sound")
def st14(spark, sf):
    """A batch that is written again, as after a failure before its commit, changes nothing."""
    root, rows = v.work(spark, "repeated"), v.messages(spark, sf).select("value")
    write = job.batch_writer(root, ("daily",), payloads=True, now_ms=F.lit(v.AS_OF_MS))
    for half in (0, 1, 1):
        write(rows.where(F.pmod(F.xxhash64("value"), F.lit(2)) == half), half)
    return rounded(spark.read.schema(_branch_schema("daily")).parquet(f"{root}/daily")).withColumnRenamed(_FIRST["daily"], "first_date")
