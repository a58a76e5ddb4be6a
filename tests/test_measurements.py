import datetime as dt
import zoneinfo

import numpy as np
import pytest
from pyspark.sql import functions as F

from vitals import rules, schemas
from vitals.functions import masking, times
from vitals.operators import aggregate, analytics, ingest, metrics, quality, query_api, validate
from vitals.sources import payloads as wire
from vitals.sources import tables

UTC = dt.timezone.utc
NOW = 1763200000000


def payload(spark, *rows):
    return spark.createDataFrame(rows, schemas.PAYLOAD)


def sample(**change):
    one = {"id": "s1", "type": "heartRate", "value": "72.0", "unit": "count/min", "startDate": "2025-11-15T10:00:00Z", "endDate": "2025-11-15T10:00:00Z", "createdAt": None, "sourceBundle": None, "metadata": None, "isSynced": None, "timezone": None, "timezoneOffset": None}
    return one | change


def test_flatten_drops_unsound_payloads_and_samples(spark):
    good = {"deviceId": "d", "userId": "u", "timestamp": "2025-11-15T10:00:00Z", "appVersion": "1", "samples": [sample(), sample(id="s2", type=None), sample(id="s3", value="x"), sample(id="s4", startDate="no"), sample(id="s5", type="steps", value="1000")]}
    rows = ingest.flatten(payload(spark, good, good | {"userId": " "}, good | {"deviceId": None}, good | {"samples": []}, good | {"samples": None}, good | {"timestamp": "never"}), F.lit(NOW)).collect()
    assert sorted(r.sample_id for r in rows) == ["s1", "s5"]
    assert rows[0].metadata == {} and rows[0].is_synced is False and rows[0].created_at == NOW and rows[0].timezone == "UTC"


def test_sanitise_and_whitelist(spark):
    p = payload(spark, {"deviceId": " d ", "userId": " u", "timestamp": "x", "appVersion": " 1 ", "samples": [sample(id=" a ", metadata={" k ": " v "})]}, {"deviceId": "d", "userId": "u", "timestamp": "x", "appVersion": "1", "samples": [sample(type="mood")]})
    r = ingest.sanitise(p).collect()[0]
    assert (r.deviceId, r.userId, r.appVersion, r.samples[0].id, r.samples[0].metadata) == ("d", "u", "1", "a", {"k": "v"})
    assert [x[0] for x in p.select(ingest.accepted_types(p)).collect()] == [True, False]
    errors = ingest.payload_errors(payload(spark, {"deviceId": "d", "userId": "u", "timestamp": "x", "appVersion": "1", "samples": [sample(value="300"), sample(value="-1"), sample()]}), rules.GATEWAY_RANGES).collect()[0].errors
    assert [(e["index"], e.error) for e in errors] == [(0, "out of range"), (1, "out of range"), (1, "not positive")]


@pytest.mark.parametrize(("change", "strict", "reason"), [
    ({}, False, None), ({"user_id": " "}, False, "missing_field"), ({"value": None}, False, "missing_field"), ({"value": float("nan")}, False, "not_numeric"),
    ({"value": -1.0}, False, "negative_value"), ({"end_date": 0}, False, "start_after_end"), ({"value": 250.0}, False, None), ({"value": 250.1}, False, "out_of_range"),
    ({"data_type": "mood"}, False, None), ({"data_type": "mood"}, True, "unknown_type"),
])
def test_validate_full(spark, change, strict, reason):
    row = {"user_id": "u", "sample_id": "s", "data_type": "heartRate", "value": 72.0, "start_date": 10, "end_date": 20} | change
    df = spark.createDataFrame([row], "user_id string, sample_id string, data_type string, value double, start_date long, end_date long")
    assert validate.validate_full(df, rules.ranges(spark, "record"), strict).first().reject_reason == reason


def test_error_records_are_idempotent(spark):
    df = spark.createDataFrame([("u", "s", "heartRate", -1.0)], "user_id string, sample_id string, data_type string, value double")
    _, bad = validate.split(validate.validate_light(df.withColumns({"start_date": F.lit(0), "end_date": F.lit(0)})))
    a, b = (validate.error_records(bad, "VALIDATION_ERROR", F.lit(t)).first() for t in (1, 2))
    assert a.error_id == b.error_id and (a.severity, a.retryable) == ("LOW", False)
    kinds = spark.createDataFrame([("PROCESSING_ERROR", None), ("OTHER", "x")], "error_type string, data_type string")
    assert [tuple(r)[2:] for r in validate.with_error_class(kinds).collect()] == [("HIGH", True, "unknown"), ("MEDIUM", False, "x")]


@pytest.mark.parametrize("zone", ["America/New_York", "Asia/Seoul", "America/Sao_Paulo", "Asia/Beirut", "Europe/London"])
def test_local_days_match_zoneinfo(spark, zone):
    z = zoneinfo.ZoneInfo(zone)
    instants = [dt.datetime(2018, 11, 4, 5, tzinfo=UTC), dt.datetime(2022, 3, 27, 9, tzinfo=UTC), dt.datetime(2024, 2, 29, 23, 59, tzinfo=UTC), dt.datetime(2025, 3, 9, 12, tzinfo=UTC), dt.datetime(2025, 11, 2, 12, tzinfo=UTC)]
    w = times.local_window(F.col("ts"), F.lit(zone), "daily")
    rows = spark.createDataFrame([(i,) for i in instants], "ts timestamp").select("ts", w.first_date.alias("d"), w.start_ms.alias("a"), w.end_ms.alias("b")).collect()
    for i, r in zip(instants, rows, strict=True):
        day = i.astimezone(z).date()
        edge = lambda d: int(dt.datetime(d.year, d.month, d.day, tzinfo=z).timestamp() * 1000)  # noqa: E731, B023
        assert (r.d, r.a, r.b) == (day, edge(day), edge(day + dt.timedelta(days=1)))


def test_times(spark):
    row = spark.range(1).select(
        times.iso_to_millis(F.lit("2025-11-15T10:00:00.123Z")).alias("a"), times.iso_to_millis(F.lit("2025-11-15T10:00:00+09:00")).alias("b"), times.iso_to_millis(F.lit("soon")).alias("c"), times.iso_to_millis(F.lit("")).alias("d"),
        times.number_or_iso_to_iso(F.lit("0")).alias("e"), times.parse_week(F.lit("2025-W53")).alias("f"), times.parse_week(F.lit("2025-W54")).alias("g"), times.parse_month(F.lit("2025-13")).alias("h"), times.parse_date(F.lit("2025-02-30")).alias("i"),
        times.window_key(F.lit(dt.date(2025, 12, 30)), "weekly").alias("j"), times.millis_to_iso(F.lit(0)).alias("k"),
    ).first()
    assert (row.a, row.b, row.c, row.d) == (1763200800123, 1763168400000, None, None)
    assert row.e == "1970-01-01T00:00:00.000Z" and tuple(row.f) == (2025, 53) and row.g is None and row.h is None and row.i is None
    assert row.j == "2026-W01" and row.k == "1970-01-01T00:00:00.000+00:00"


def test_zone_table_guards_conversion(spark):
    df = spark.createDataFrame([("Asia/Seoul",), ("Mars/Olympus",), (None,)], "timezone string")
    assert [r.resolved_timezone for r in times.with_zone(df).collect()] == ["Asia/Seoul", "UTC", "UTC"]


def test_masking(spark):
    text = 'password=abc user=x {"api_key": "k1", "name": "n"} Token = t'
    row = spark.createDataFrame([(text, {"Secret-Key": "s", "a": "b"})], "t string, m map<string,string>").select(masking.mask_text(F.col("t")).alias("t"), masking.mask_map(F.col("m")).alias("m")).first()
    assert "abc" not in row.t and "k1" not in row.t and "user=x" in row.t and '"name": "n"' in row.t and not row.t.endswith("= t")
    assert row.m == {"Secret-Key": masking.MASK, "a": "b"}


def measurements(spark, n=200):
    start = dt.datetime(2024, 3, 1, tzinfo=UTC)
    rows = [(i, i % 3, "heartRate" if i % 2 else "steps", ["UTC", "Asia/Seoul", "America/New_York"][i % 3], start + dt.timedelta(minutes=131 * i), float((i * 37) % 101)) for i in range(n)]
    return spark.createDataFrame(rows, "sample_id long, user_id long, data_type string, timezone string, start_ts timestamp, value double")


def test_merged_partials_equal_direct_statistics(spark):
    df = measurements(spark)
    direct = {(r.user_id, r.data_type): r for r in df.groupBy("user_id", "data_type").agg(*aggregate.statistics()).collect()}
    parts = aggregate.partials(df, ["user_id", "data_type", F.to_date("start_ts").alias("day")])
    for r in aggregate.finished(aggregate.merged(parts, ["user_id", "data_type"])).collect():
        d = direct[r.user_id, r.data_type]
        assert (r["count"], r.min_value, r.max_value, r.first_value, r.last_value) == (d["count"], d.min_value, d.max_value, d.first_value, d.last_value)
        assert r.stddev_value == pytest.approx(d.stddev_value) and r.avg_value == pytest.approx(d.avg_value)


def test_quality(spark):
    cols = "user_id string, data_type string, count long, record_count long, min_value double, max_value double, avg_value double, sum_value double, stddev_value double, window_start long, window_end long, updated_at long"
    df = spark.createDataFrame([("u", "heartRate", 100, 100, 60.0, 90.0, 75.0, 7500.0, 8.5, 0, NOW, NOW), ("u", "heartRate", 0, 0, 100.0, 50.0, 75.0, 0.0, 0.0, 0, NOW, NOW), ("u", "heartRate", 5, 5, 60.0, 240.0, 190.0, 1.0, 3.0, 0, None, NOW)], cols)
    rows = quality.score(quality.validate_aggregates(df), F.lit(NOW + 1)).collect()
    assert [r.fault for r in rows] == [None, "no_records", None] and [r.has_anomaly for r in rows] == [False, False, True]
    assert rows[0].quality_score == 1.0 and rows[2].quality_score == pytest.approx(11 / 12 * 0.9 * 0.95 * 0.9)
    assert [r.valid for r in quality.validate_simple(df).collect()] == [True, False, True]


def test_query_parameters():
    with pytest.raises(query_api.QueryError):
        query_api.check_ids(user_id=" ")
    with pytest.raises(query_api.QueryError):
        query_api.check_top("median", "asc", 1)
    with pytest.raises(query_api.QueryError):
        query_api.check_top("count", "asc", 0)
    with pytest.raises(query_api.QueryError):
        query_api.predicates([("a", "~", 1)])
    assert query_api.check_week("2025-W45") == (2025, 45)
    assert query_api.default_months(dt.date(2024, 8, 31), None, None) == ((2024, 2), (2024, 8))


def test_pair_ranges_over_years(spark):
    df = spark.createDataFrame([(y, w) for y in (2023, 2024, 2025) for w in (1, 26, 52)], "year int, week int")
    got = {tuple(r) for r in df.where(query_api.between_pairs("year", "week", (2023, 26), (2025, 1))).collect()}
    assert got == {(2023, 26), (2023, 52), (2024, 1), (2024, 26), (2024, 52), (2025, 1)}


def test_top_records_golden(spark):
    rows = [("u", "steps", dt.date(2025, 11, d), mx, av) for d, mx, av in ((15, 10000.0, 8000.0), (16, 15000.0, 12000.0), (17, None, None))]
    df = spark.createDataFrame(rows, "user_id string, data_type string, aggregation_date date, max_value double, avg_value double").withColumns({"sum_value": F.lit(1.0), "count": F.lit(1)})
    top = query_api.top_records(df, "u", "steps", dt.date(2025, 11, 17)).collect()
    assert [(r["rank"], r.max_value) for r in top] == [(1, 15000.0), (2, 10000.0), (3, None)]
    assert query_api.envelope(top_df := df.select("user_id", "aggregation_date"), ["user_id"]).first()["count"] == top_df.count()


def test_joins_agree(spark):
    daily = aggregate.calendar_aggregate(measurements(spark), "daily")
    key = lambda r: (r.user_id, r.aggregation_date)
    assert sorted(analytics.daily_summary(daily).collect(), key=key) == sorted(analytics.daily_summary_joined(daily).select("user_id", "aggregation_date", "avg_heart_rate", "total_steps", "avg_sleep_hours").collect(), key=key)
    pick = lambda df: sorted((r.user_id, r.data_type, r.aggregation_date, round(r.z_score, 6)) for r in df.collect())
    assert pick(analytics.z_scores(daily, 1)) == pick(analytics.z_scores_joined(daily, 1))


def test_exact_percentiles(spark):
    values = [5, 1, 1, 9, 7, 3, 3, 3, 2, 8]
    row = metrics.exact_percentiles(spark.createDataFrame([("k", x) for x in values], "k string, x long"), "x", ["k"], {"p50": 0.5, "p95": 0.95}).first()
    s = sorted(values)
    assert (row.p50, row.p95) == (s[min(int(10 * 0.5), 9)], s[min(int(10 * 0.95), 9)])


def test_wire_and_kafka(spark):
    df = spark.createDataFrame([(bytearray(b"\x00\x00\x00\x01\x02{}"),), (bytearray(b"\x01abc"),), (None,)], "value binary")
    rows = wire.decode_wire(df).collect()
    assert (rows[0].schema_id, bytes(rows[0].body), rows[0].wire_error) == (258, b"{}", None) and [r.wire_error for r in rows[1:]] == ["DESERIALIZATION_ERROR"] * 2
    assert wire.kafka_options("h:1", "t", "someday", {"security.protocol": "SSL"}, 5) == {"kafka.bootstrap.servers": "h:1", "subscribe": "t", "startingOffsets": "earliest", "failOnDataLoss": "false", "kafka.security.protocol": "SSL", "maxOffsetsPerTrigger": "5"}


def test_read_payload_json(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"deviceId":"d","userId":"u","samples":[{"id":"1"}]}\n{broken\n')
    good, bad = wire.read_payload_json(spark, str(tmp_path))
    assert [r.userId for r in good.collect()] == ["u"] and [r.value for r in bad.collect()] == ["{broken"]


def test_upsert_is_repeatable(spark, tmp_path):
    path, stage = str(tmp_path / "t"), str(tmp_path / "s")
    df = lambda v, ks: spark.createDataFrame([(k, k % 2, v) for k in ks], "k long, p long, updated_at long")
    tables.upsert(spark, path, df(1, [1, 2, 3]), ["k"], ["p"], stage)
    for _ in range(2):
        tables.upsert(spark, path, df(2, [3, 5]), ["k"], ["p"], stage)
    assert {(r.k, r.updated_at) for r in spark.read.parquet(path).collect()} == {(1, 1), (2, 1), (3, 2), (5, 2)}
    before = spark.read.parquet(path).count()
    tables.compact(spark, path, ["p"], stage, 1 << 20)
    assert spark.read.parquet(path).count() == before and tables.file_sizes(spark.read.parquet(path)).first().n_files == 2


def test_catalogue_and_scan(spark):
    tables.create_tables(spark, "vitals_test", {"daily": (schemas.DAILY, ["data_type"])})
    tables.create_tables(spark, "vitals_test", {"daily": (schemas.DAILY, ["data_type"])})
    assert [r.table_name for r in tables.list_tables(spark, "vitals_test").collect()] == ["daily"]
    assert tables.scan(spark, "daily", "vitals_test", F.col("user_id") == "u", ["user_id"], 5).count() == 0
    with pytest.raises(LookupError):
        tables.scan(spark, "nothing", "vitals_test")


def test_migration_and_drift(spark):
    df = spark.createDataFrame([(1, "a")], "n int, s string")
    out, history = tables.migrate(df, [("add", "x", "double"), ("rename", "s", "t"), ("widen", "n", "bigint"), ("optional", "t")])
    assert out.dtypes == [("n", "bigint"), ("t", "string"), ("x", "double")] and len(history) == 4
    with pytest.raises(ValueError, match="can't become"):
        tables.migrate(df, [("widen", "s", "int")])
    report = {r.name: (r.change, r.breaking) for r in tables.drift(tables.fields(spark, df.schema), tables.fields(spark, out.schema)).collect()}
    assert report == {"n": ("widened", False), "s": ("removed", True), "t": ("added", False), "x": ("added", False)}
    with pytest.raises(ValueError, match="breaking"):
        tables.gate(tables.drift(tables.fields(spark, df.schema), tables.fields(spark, out.schema)))


def test_large_partitions_are_compacted_in_parts(spark, tmp_path):
    path, stage = str(tmp_path / "t"), str(tmp_path / "s")
    spark.range(60_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("x"), F.when(F.col("id") < 59_000, 0).otherwise(1).alias("p")).repartition(12).write.partitionBy("p").parquet(path)
    tables.compact(spark, path, ["p"], stage, 1 << 20)
    sizes = {r.p: (r.n_files, r.bytes) for r in tables.partition_sizes(spark.read.parquet(path), ["p"]).collect()}
    assert spark.read.parquet(path).agg(F.count("*"), F.countDistinct("id")).first()[:] == (60_000, 60_000)
    assert sizes[1][0] == 1 and 2 <= sizes[0][0] <= 2 * -(-sizes[0][1] // (1 << 20))
    before = {r.f for r in spark.read.parquet(path).select(F.col("_metadata.file_path").alias("f")).distinct().collect()}
    tables.compact(spark, path, ["p"], stage, 1 << 30 if sizes[0][0] == 1 else 1 << 18)
    assert spark.read.parquet(path).count() == 60_000 and before


def test_envelopes_of_empty_results(spark):
    rows = spark.createDataFrame([(1, "a", 5), (1, "a", 3)], "user_id long, data_type string, x long")
    wanted = spark.createDataFrame([(1, "a"), (2, "b")], "user_id long, data_type string")
    got = {r.user_id: ([x.x for x in r.records], r["count"]) for r in query_api.envelope(rows, ["user_id", "data_type"], wanted).collect()}
    assert got == {1: ([3, 5], 2), 2: ([], 0)}


def test_percentiles_of_many_values(spark):
    rng = np.random.default_rng(1)
    values = {"a": rng.integers(0, 5000, 4000).tolist(), "b": [7] * 300, None: rng.integers(-50, 50, 999).tolist()}
    df = spark.createDataFrame([(k, x) for k, xs in values.items() for x in xs], "k string, x long")
    for r in metrics.exact_percentiles(df, "x", ["k"], {"p50": 0.5, "p95": 0.95, "p99": 0.99, "p100": 1.0}, parts=8).collect():
        s = sorted(values[r.k])
        assert [r.p50, r.p95, r.p99, r.p100] == [s[min(int(len(s) * q), len(s) - 1)] for q in (0.5, 0.95, 0.99, 1.0)]
