"""Queries of hostile messages and of stateful streams, added to the registry."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import ingest
from ..streaming import calendar, job, partials, profiles
from ..streaming.clocks import SourceClocks
from . import views as v
from .registry import _PROFILES, _RESOLVED, ROUNDED, _profiles, query, rounded, stated_zone
from .storage_queries import _FIRST, _branch_schema, local

# Messages that must not stop the job


@query("st19_bad_zone", f"""
SELECT CAST(user_id AS VARCHAR) AS user_id, data_type, timezone, first_date, {ROUNDED}
FROM ({local('day', f"(SELECT * REPLACE ({_RESOLVED} AS timezone) FROM sound)")})""", "sound")
def st19_bad_zone(spark, sf):
    """The whole job over messages with unknown, missing, empty and slashless zones: their windows are those of the resolved zone."""
    root = v.work(spark, "bad-zones")
    rows = v.messages(spark, sf, stated_zone(F.col("sample_id"))).select("value")
    write = job.batch_writer(root, ("daily",), payloads=True, now_ms=F.lit(v.AS_OF_MS))
    for half in (0, 1):
        write(rows.where(F.pmod(F.xxhash64("value"), F.lit(2)) == half), half)
    return rounded(spark.read.schema(_branch_schema("daily")).parquet(f"{root}/daily")).withColumnRenamed(_FIRST["daily"], "first_date")


@query("f13_duplicate_keys", """
SELECT CAST(sample_id AS VARCHAR) AS sample_id, CASE sample_id % 3 WHEN 0 THEN 'last' WHEN 1 THEN 'only' END AS locale, CASE WHEN sample_id % 3 < 2 THEN 'other' END AS note,
  [2, 2, 0][CAST(sample_id % 3 AS INTEGER) + 1] AS n_keys
FROM samples WHERE user_id % 50 <> 7""", "samples")
def f13(spark, sf):
    """Metadata with keys that are equal after trimming: the last one's value stays. Maps without keys and missing maps pass."""
    i = lambda s: s["id"].cast("long") % 3
    pairs = lambda *kv: F.map_from_arrays(F.array(*map(F.lit, kv[::2])), F.array(*map(F.lit, kv[1::2])))
    twice, once = pairs("locale", "first", " note", "other ", " locale", "mid", "locale ", " last"), pairs("locale ", "only", "note", "other")
    rows = v.stored_payloads(spark, sf)
    rows = rows.withColumn("samples", F.transform("samples", lambda s: s.withField("metadata", F.when(i(s) == 0, twice).when(i(s) == 1, once))))
    flat = ingest.flatten(ingest.sanitise(rows), F.lit(v.AS_OF_MS))
    value = lambda key: F.try_element_at("metadata", F.lit(key))
    return flat.select("sample_id", value("locale").alias("locale"), value("note").alias("note"), F.size("metadata").alias("n_keys"))


@query("st19_dropped", """
SELECT count(*) FILTER (coalesce(fault, '') <> 'sample') AS records, count(*) FILTER (fault = 'sample') AS dropped_samples, count(*) FILTER (sample_id % 10 < 3) AS dropped_payloads
FROM messages""", "messages")
def st19_dropped(spark, sf):
    """What flattening leaves out is counted, so that a batch's counts add up to what was sent."""
    root = v.work(spark, "dropped")
    i = F.col("sample_id") % 10
    body = F.when(i == 0, '{"userId": "7", "deviceId": "d", "timestamp": "2024-01-31T00:00:00Z", "samples": []}').when(i == 1, '{"userId": "7", "timestamp": "2024-01-31T00:00:00Z", "samples": [{"id": "1"}]}')
    body = body.when(i == 2, '{"userId": " ", "deviceId": "d", "timestamp": "x", "samples": [{"id": "1"}]}')
    empty = v.samples(spark, sf).where(i < 3).select(F.concat(F.unhex(F.lit("0000000001")), body.cast("binary")).alias("value"))
    job.batch_writer(root, (), payloads=True, now_ms=F.lit(v.AS_OF_MS))(v.messages(spark, sf).select("value").unionByName(empty), 0)
    counts = spark.read.schema(job.METRICS).parquet(f"{root}/metrics")
    return counts.select("records", "dropped_samples", "dropped_payloads")


# Clocks, firings, lifetimes, partial sums and profiles of streams

DAY_MS, FIRST_MS = 86_400_000, 1_704_067_200_000
_SIX_DAYS, _IDLE, _DELAY = 6 * DAY_MS, 9 * DAY_MS, DAY_MS


def _steps(spark, root, schema, steps, start):
    """Each of ``steps`` is written and worked through as a batch of its own."""
    for rows in steps:
        rows.coalesce(1).write.mode("append").parquet(f"{root}/in")  # one file, one batch
        start(spark.readStream.schema(schema).parquet(f"{root}/in")).awaitTermination()


def _appended(stream, root, **trigger):
    return stream.writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/checkpoint").trigger(**(trigger or {"availableNow": True})).start()


def _arrivals(spark, sf):
    """Samples of three sources in six-day batches by arrival; some arrive nine days late, and source 2 stops on the tenth."""
    rows = v.samples(spark, sf).select("sample_id", (F.col("user_id") % 3).alias("source"), F.col("start_date").alias("event_ms"))
    late = F.when(F.col("sample_id") % 29 == 0, 9 * DAY_MS).otherwise(0)
    rows = rows.where((F.col("source") != 2) | (F.col("event_ms") < FIRST_MS + 10 * DAY_MS)).withColumn("arrival_ms", F.col("event_ms") + 60_000 + late)
    return rows.withColumn("batch", F.floor((F.col("arrival_ms") - FIRST_MS) / _SIX_DAYS))


@query("st2_idle_source", f"""
, a AS (
  SELECT sample_id, user_id % 3 AS source, start_date AS event_ms, start_date + 60000 + CASE WHEN sample_id % 29 = 0 THEN 9 * {DAY_MS} ELSE 0 END AS arrival_ms
  FROM samples WHERE user_id % 3 <> 2 OR start_date < {FIRST_MS + 10 * DAY_MS}),
b AS (SELECT *, (arrival_ms - {FIRST_MS}) // {_SIX_DAYS} AS batch FROM a),
n AS (SELECT DISTINCT batch FROM b),
clock AS (
  SELECT n.batch, b.source, max(b.event_ms) AS newest_ms, max(b.arrival_ms) AS heard_ms FROM n JOIN b ON b.batch <= n.batch GROUP BY 1, 2),
now AS (SELECT n.batch, max(b.arrival_ms) AS now_ms FROM n JOIN b USING (batch) GROUP BY 1),
w AS (
  SELECT batch, min(newest_ms) FILTER (heard_ms >= now_ms - {_IDLE}) - {_DELAY} AS least, count(*) FILTER (heard_ms >= now_ms - {_IDLE}) AS active_sources
  FROM clock JOIN now USING (batch) GROUP BY 1),
m AS (SELECT batch, active_sources, max(least) OVER (ORDER BY batch) AS watermark_ms FROM w),
p AS (SELECT *, lag(watermark_ms) OVER (ORDER BY batch) AS before_ms FROM m)
SELECT b.batch, CAST(b.source AS VARCHAR) AS source, p.watermark_ms, p.active_sources, count(*) AS n, count(*) FILTER (b.event_ms < p.before_ms) AS late
FROM b JOIN p USING (batch) GROUP BY 1, 2, 3, 4""", "samples")
def st2(spark, sf):
    """A source that stops holds the watermark until its timeout and no longer; rows are late by the watermark before their batch."""
    root, rows = v.work(spark, "clocks"), _arrivals(spark, sf)
    rows.repartition("batch").write.partitionBy("batch").parquet(f"{root}/all")
    clocks = SourceClocks(root, "source", _DELAY, _IDLE)

    def write(batch, batch_id):
        out = clocks.advance(batch, batch_id, F.col("event_ms"), F.col("arrival_ms"), F.max("arrival_ms"))
        out.withColumn("batch", F.lit(batch_id).cast("long")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(f"{root}/out")

    schema = "sample_id long, source long, event_ms long, arrival_ms long"
    every = spark.read.schema(f"{schema}, batch long").parquet(f"{root}/all")
    steps = [every.where(F.col("batch") == b.batch).drop("batch") for b in every.select("batch").distinct().orderBy("batch").collect()]  # seven
    _steps(spark, root, schema, steps, lambda s: s.writeStream.foreachBatch(write).option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start())
    out = spark.read.schema(f"{schema}, late boolean, batch long").parquet(f"{root}/out")
    counts = out.groupBy("batch", F.col("source").cast("string").alias("source")).agg(F.count("*").alias("n"), F.count_if("late").alias("late"))
    return counts.join(clocks.watermarks(spark).select("batch", "watermark_ms", "active_sources"), "batch").select("batch", "source", "watermark_ms", "active_sources", "n", "late")


_FEW = "(SELECT * REPLACE (user_id % 5 AS user_id) FROM samples WHERE start_ts < TIMESTAMP '2024-01-14 12:00:00')"
_IN_TIME = "(SELECT * FROM few WHERE sample_id % 10 <> 0)"
_STREAM = "sample_id long, user_id long, data_type string, timezone string, start_ts timestamp, value double"


@query("st5_refire", f"""
, few AS {_FEW},
f AS ({local('week', _IN_TIME)}),
l AS ({local('week', '(SELECT * FROM few WHERE sample_id % 10 <> 0 OR sample_id % 20 = 0)')})
SELECT user_id, data_type, timezone, first_date, coalesce(f.count, 0) AS first_count, l.count AS last_count, round(f.sum_value, 7) AS first_sum, round(l.sum_value, 7) AS last_sum,
  round(l.avg_value, 7) AS last_avg, l.min_value AS last_min, l.max_value AS last_max
FROM l JOIN f USING (user_id, data_type, timezone, first_date)""", "samples")
def st5_refire(spark, sf):
    """Weeks fire at their end; a late tenth comes in two parts, one while all weeks are open and one after the lateness: only the first changes results."""
    root = v.work(spark, "refire")
    calendar.rocksdb(spark)
    rows = v.samples(spark, sf).select("sample_id", "user_id", "data_type", "timezone", "start_ts", "value").where(F.col("start_ts") < "2024-01-14 12:00:00").withColumn("user_id", F.col("user_id") % 5)
    at = lambda text: rows.limit(1).withColumns({"user_id": F.lit(-1).cast("long"), "start_ts": F.lit(text).cast("timestamp")})
    i = F.col("sample_id")
    steps = [rows.where(i % 10 != 0), at("2024-01-16 00:00:00"), rows.where(i % 20 == 0), at("2024-03-01 00:00:00"), rows.where(i % 20 == 10)]
    _steps(spark, root, _STREAM, steps, lambda s: _appended(calendar.refiring_windows(s, "weekly", lateness="20 days"), root))
    out = spark.read.schema(f"{calendar.OUTPUT}, firing int").parquet(f"{root}/out").where("user_id >= 0")
    keys = ["user_id", "data_type", "timezone", "window_start"]
    first = out.where("firing = 1").select(*keys, F.col("count").alias("first_count"), F.round("sum_value", 7).alias("first_sum"))
    last = calendar.latest_firings(out).select(*keys, F.col("count").alias("last_count"), F.round("sum_value", 7).alias("last_sum"), F.round("avg_value", 7).alias("last_avg"), F.col("min_value").alias("last_min"), F.col("max_value").alias("last_max"))
    day = F.to_date(F.from_utc_timestamp(F.timestamp_millis("window_start"), F.col("timezone"))).alias("first_date")
    return first.join(last, keys).select("user_id", "data_type", "timezone", day, "first_count", "last_count", "first_sum", "last_sum", "last_avg", "last_min", "last_max")


@query("st11_state_ttl", """
SELECT sample_id, 1 AS within, CASE WHEN sample_id % 3 = 0 THEN 2 ELSE 1 END AS expired FROM samples""", "samples")
def st11(spark, sf):
    """A third of all ids comes again in a later batch: within the ids' lifetime it is dropped, after it it passes."""
    calendar.rocksdb(spark)
    rows = v.samples(spark, sf).select("sample_id", "value")
    out = None
    for name, lifetime in (("within", "48 hours"), ("expired", "1 millisecond")):
        root = v.work(spark, f"lifetime-{name}")
        _steps(spark, root, "sample_id long, value double", [rows, rows.where("sample_id % 3 = 0")], lambda s, r=root, t=lifetime: _appended(calendar.without_repeats(s, lifetime=t, buckets=8), r, once=True))  # state in processing time always asks for one more batch
        counts = spark.read.schema("sample_id long, value double").parquet(f"{root}/out").groupBy("sample_id").agg(F.count("*").cast("int").alias(name))
        out = counts if out is None else out.join(counts, "sample_id")
    return out


@query("a3_stored_partials", f"""
, u AS (SELECT 'day' AS unit, * FROM ({local('day', 'samples')}) UNION ALL SELECT 'week', * FROM ({local('week', 'samples')}) UNION ALL SELECT 'month', * FROM ({local('month', 'samples')}))
SELECT unit, user_id, data_type, timezone, first_date, {ROUNDED} FROM u""", "samples")
def a3_partials(spark, sf):
    """Days, weeks and months from stored partial sums after late batches, a repeated one, a fold, and batches after the fold."""
    root = v.work(spark, "partials")
    rows = v.samples(spark, sf).select("sample_id", "user_id", "data_type", "timezone", "start_ts", "value")
    part = F.pmod(F.xxhash64("sample_id"), F.lit(5))
    for batch_id in (0, 1, 2, 2):
        partials.write_delta(rows.where(part == batch_id), root, batch_id)
    partials.fold(spark, root, 2, least=2)
    for batch_id in (3, 3, 4):
        partials.write_delta(rows.where(part == batch_id), root, batch_id)
    out, first = None, {"daily": "aggregation_date", "weekly": "week_start_date", "monthly": "month_start_date"}
    for kind, unit in (("daily", "day"), ("weekly", "week"), ("monthly", "month")):
        one = rounded(partials.windows(partials.read(spark, root), kind)).select(F.lit(unit).alias("unit"), "user_id", "data_type", "timezone", F.col(first[kind]).alias("first_date"), "count", "sum_value", "min_value", "max_value", "avg_value", "stddev_value", "first_value", "last_value", "record_count")
        out = one if out is None else out.unionByName(one)
    return out


@query("st17_partial_sums", f"SELECT CAST(user_id AS VARCHAR) AS user_id, data_type, timezone, first_date, {ROUNDED} FROM ({local('week', 'sound')})", "sound")
def st17_partials(spark, sf):
    """The whole job with stored partial sums in place of raw rows: weeks are upserted from the parts of the windows that a batch touches."""
    root = v.work(spark, "partial-job")
    write = job.batch_writer(root, ("weekly",), payloads=True, now_ms=F.lit(v.AS_OF_MS), partial_sums=True)
    for half in (0, 1, 1):
        write(v.messages(spark, sf).select("value").where(F.pmod(F.xxhash64("value"), F.lit(2)) == half), half)
    return rounded(spark.read.schema(_branch_schema("weekly")).parquet(f"{root}/weekly")).withColumnRenamed(_FIRST["weekly"], "first_date").drop("year", "week_of_year")


@query("j4_stream_as_of", f", {_PROFILES} SELECT sample_id, tz AS user_timezone FROM samples s ASOF LEFT JOIN p ON s.user_id = p.user_id AND s.start_ts >= p.updated_at", "samples")
def j4_stream(spark, sf):
    """Profiles come from a table, and out of order in a stream, after measurements that they hold for."""
    root = v.work(spark, "as-of")
    calendar.rocksdb(spark)
    rows, marks = v.samples(spark, sf).select("user_id", "sample_id", "start_ts"), _profiles(spark, sf).select("user_id", "timezone", "updated_at")
    known = marks.where(F.col("updated_at") < "2024-01-10")
    some = lambda low, high: marks.where((F.col("updated_at") >= low) & (F.col("updated_at") < high))
    end = rows.limit(1).withColumns({"user_id": F.lit(-1).cast("long"), "start_ts": F.lit("2024-06-01 00:00:00").cast("timestamp")})
    none_rows, none_marks = rows.limit(0), marks.limit(0)
    steps = [
        (rows.where(F.col("start_ts") < "2024-01-15"), none_marks), (none_rows, some("2024-01-14", "2024-01-19")), (none_rows, some("2024-01-10", "2024-01-14")),
        (none_rows, some("2024-01-19", "2024-03-01")), (rows.where(F.col("start_ts") >= "2024-01-15"), none_marks), (end, none_marks),
    ]
    for i, (new_rows, new_marks) in enumerate(steps):
        new_rows.coalesce(1).write.mode("append").parquet(f"{root}/rows")
        new_marks.coalesce(1).write.mode("append").parquet(f"{root}/marks")
        streams = [spark.readStream.schema(s).parquet(f"{root}/{n}") for s, n in (("user_id long, sample_id long, start_ts timestamp", "rows"), ("user_id long, timezone string, updated_at timestamp", "marks"))]
        _appended(profiles.zone_as_of_stream(*streams, known, delay="24 days"), root).awaitTermination()
    return spark.read.schema(profiles.OUTPUT).parquet(f"{root}/out").where("user_id >= 0").select("sample_id", "user_timezone")
