"""State of streams, stored partial sums, exchanged partitions, buckets, versions and hostile messages."""

import datetime as dt
import shutil

import pytest
from pyspark.sql import functions as F

from vitals.functions import times
from vitals.operators import aggregate, ingest, metrics
from vitals.plans import store_queries
from vitals.schemas import PAYLOAD
from vitals.sources import payloads, tables, versions
from vitals.streaming import calendar, job, partials
from vitals.streaming.clocks import SourceClocks

UTC = dt.timezone.utc
SCHEMA = "sample_id long, user_id long, data_type string, timezone string, start_ts timestamp, value double, start_date long, end_date long"
SF = "/root/testdata/sf0.001"


def rows(n, first=0, day=8):
    start = dt.datetime(2024, 3, day, tzinfo=UTC)
    return [(first + i, i % 3, "heartRate", ["UTC", "Asia/Seoul", "America/New_York"][i % 3], start + dt.timedelta(minutes=97 * i), float(i * 31 % 89), 0, 0) for i in range(n)]


def picked(df):
    cols = ("user_id", "data_type", "timezone", "window_start", "window_end", "count", "sum_value", "min_value", "max_value", "first_value", "last_value")
    return {tuple(r[c] for c in cols): round(r.stddev_value, 6) for r in df.collect()}


# Messages


def test_zones_without_a_slash_are_valid_and_no_zone_stops_the_job(spark, tmp_path):
    names = set(times.zone_names(spark))
    assert {"Japan", "ROK", "Singapore", "GMT", "EST", "PST8PDT", "UTC", "Asia/Seoul"} <= names and not {"Factory", "localtime", "", "Mars/Base"} & names
    spark.createDataFrame([(z,) for z in sorted(names)], "z string").select(F.from_utc_timestamp(F.lit("2024-07-01"), F.col("z"))).collect()  # the engine knows all
    sample = '{"id": "%d", "type": "steps", "value": "1", "startDate": "2024-03-08T10:00:00Z", "endDate": "2024-03-08T10:00:01Z"%s}'
    zones = ['"Mars/Base"', '""', "null", '"Japan"']
    texts = [f'{{"userId": "1", "deviceId": "d", "timestamp": "2024-03-08T10:00:00Z", "samples": [{sample % (i, f", {chr(34)}timezone{chr(34)}: {z}")}]}}' for i, z in enumerate(zones)]
    texts += ['{"userId": "1", "timestamp": "2024-03-08T10:00:00Z", "samples": [{"id": "9"}]}', '{"userId": "1", "deviceId": "d", "timestamp": "2024-03-08T10:00:00Z", "samples": [{"id": "9"}]}']
    batch = spark.createDataFrame([(bytearray(b"\0\0\0\0\1" + t.encode()),) for t in texts], "value binary")
    job.batch_writer(str(tmp_path), payloads=True, now_ms=F.lit(0).cast("long"))(batch, 0)
    got = {r.sample_id: (r.timezone, r.stated_timezone) for r in spark.read.parquet(f"{tmp_path}/raw").collect()}
    assert got == {"0": ("UTC", "Mars/Base"), "1": ("UTC", ""), "2": ("UTC", "UTC"), "3": ("Japan", "Japan")}
    counts = spark.read.schema(job.METRICS).parquet(f"{tmp_path}/metrics").first().asDict()
    assert {k: counts[k] for k in ("records", "errors", "dropped_payloads", "dropped_samples")} == {"records": 4, "errors": 0, "dropped_payloads": 1, "dropped_samples": 1}


def test_keys_that_are_equal_after_trimming(spark):
    text = '{"userId": " u ", "samples": [{"id": "1", "metadata": {"a": "1", " a": "2", "b ": " 3 ", "a": "4 "}}, {"id": "2", "metadata": {}}, {"id": "3"}]}'
    parsed = spark.createDataFrame([(text,)], "t string").select(F.from_json("t", PAYLOAD).alias("p")).select("p.*")
    samples = ingest.sanitise(parsed).first().samples
    assert [s.metadata for s in samples] == [{"a": "4", "b": "3"}, {}, None]


def test_versions_resolve_or_are_refused(spark):
    reader = [versions.ReaderField("n", "bigint", ("old",), required=True), versions.ReaderField("x", "double", default=0.5)]
    body = lambda i, t: (bytearray(b"\0" + i.to_bytes(4, "big") + t),)
    framed = payloads.decode_wire(spark.createDataFrame([body(1, b'{"old": 3}'), body(2, b'{"n": 4, "x": 1}'), body(2, b'{"x": 1}'), body(3, b"{}"), body(1, b"{"), (bytearray(b"x"),), (None,)], "value binary"))
    got = versions.read_versions(framed, {1: "old int", 2: "n bigint, x float"}, reader).select("record", "version_error").collect()
    assert [(tuple(r.record) if r.record else None, r.version_error) for r in got] == [((3, 0.5), None), ((4, 1.0), None), (None, "MISSING_FIELD"), (None, "UNKNOWN_SCHEMA"), (None, "MISSING_FIELD"), (None, "DESERIALIZATION_ERROR"), (None, "DESERIALIZATION_ERROR")]
    for bad in ("n string", "other int"):
        with pytest.raises(versions.Incompatible):
            versions.read_versions(framed, {1: bad}, reader)


# State


def stream(spark, source, batch, start):
    spark.createDataFrame(batch, SCHEMA).coalesce(1).write.mode("append").parquet(source)
    q = start(spark.readStream.schema(SCHEMA).parquet(source))
    q.awaitTermination()
    return q


def sink(df, tmp_path, **trigger):
    return df.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/c").trigger(**(trigger or {"availableNow": True})).start()


def test_windows_fire_again_and_their_state_goes(spark, tmp_path):
    pytest.importorskip("google.protobuf", reason="the state server of Python needs it")
    calendar.rocksdb(spark)
    at = lambda day, hour=0: dt.datetime(2024, 3, day, hour, tzinfo=UTC)
    row = lambda i, when, value, user=1: (i, user, "steps", "UTC", when, value, 0, 0)
    steps = [
        [row(1, at(8, 9), 1.0), row(2, at(8, 8), 2.0)],  # open
        [row(3, at(9, 1), 5.0, 2)],  # the eighth is over: its first firing
        [row(4, at(8, 1), 10.0), row(5, at(8, 2), float("nan"))],  # late, hours before the watermark: second firing
        [row(6, at(9, 3), 1.0, 2)],  # the lateness is over
        [row(7, at(8, 5), 99.0)],  # too late
        [row(8, at(20), 1.0, 3)], [row(9, at(25), 1.0, 4)],
    ]
    for step in steps:
        q = stream(spark, f"{tmp_path}/in", step, lambda s: sink(calendar.refiring_windows(s, "daily"), tmp_path))
    out = spark.read.schema(f"{calendar.OUTPUT}, firing int").parquet(f"{tmp_path}/out")
    assert sorted((r.user_id, r.firing, r["count"], r.sum_value) for r in out.collect()) == [(1, 1, 2, 3.0), (1, 2, 3, 13.0), (2, 1, 2, 6.0), (3, 1, 1, 1.0)]
    assert {(r.user_id, r.firing) for r in calendar.latest_firings(out).collect()} == {(1, 2), (2, 1), (3, 1)}
    state = spark.read.format("statestore").option("stateVarName", "sums").load(f"{tmp_path}/c")
    assert state.count() == 1 and q.lastProgress is not None  # the open window of the last row alone


def test_ids_expire(spark, tmp_path):
    pytest.importorskip("google.protobuf", reason="the state server of Python needs it")
    calendar.rocksdb(spark)
    one = rows(12)
    for lifetime, want in (("1 hour", 12), ("1 millisecond", 24)):
        root = tmp_path / lifetime.replace(" ", "")
        for _ in range(2):
            stream(spark, f"{root}/in", [*one, one[0]], lambda s, r=root, t=lifetime: sink(calendar.without_repeats(s, lifetime=t, buckets=2), r, once=True))
        assert spark.read.schema(SCHEMA).parquet(f"{root}/out").count() == want


def test_clocks(spark, tmp_path):
    clocks = SourceClocks(str(tmp_path), "source", delay_ms=10, idle_ms=100, keep=3)

    def advance(batch_id, now, *events):
        batch = spark.createDataFrame([(s, e, now) for s, e in events], "source string, event long, arrival long")
        out = clocks.advance(batch, batch_id, F.col("event"), F.col("arrival"), F.lit(now))
        late = sorted((r.source or "", r.event) for r in out.where("late").collect())
        return late, clocks.watermarks(spark).where(F.col("batch") == batch_id).first()

    assert advance(0, 1000, ("a", 500), ("b", 300))[1].watermark_ms == 290
    assert advance(1, 1050, ("a", 900))[1].watermark_ms == 290  # b holds it
    late, w = advance(2, 1090, ("a", 950), ("a", 280), (None, 400))
    assert late == [("a", 280)] and (w.watermark_ms, w.sources, w.active_sources) == (290, 3, 3)
    assert advance(3, 1150, ("a", 990))[1].watermark_ms == 390  # b is idle
    for _ in range(2):  # the same again: a batch that is repeated
        late, w = advance(4, 1160, ("b", 310), ("a", 1000))
        assert late == [("b", 310)] and w.watermark_ms == 390  # b holds it again, but it never falls
    assert advance(5, 9999, ("z", 1))[1].watermark_ms == 390


# Partial sums


def test_partial_sums_read_no_raw_row(spark, tmp_path):
    one, two = rows(60), rows(40, first=1000)
    for root, options in ((tmp_path / "a", {"partial_sums": True}), (tmp_path / "b", {})):
        for i, batch in enumerate((one, two)):
            job.batch_writer(str(root), **options)(spark.createDataFrame(batch, SCHEMA), i)
            if options:
                shutil.rmtree(root / "raw")  # nobody reads it
    for kind in ("daily", "weekly", "monthly"):
        assert picked(spark.read.parquet(f"{tmp_path}/a/{kind}")) == picked(spark.read.parquet(f"{tmp_path}/b/{kind}")) != {}


def test_folded_partial_sums(spark, tmp_path):
    root, every = str(tmp_path), []
    for batch in range(6):
        new = rows(30, first=100 * batch, day=2 + 6 * (batch % 3))
        every += new
        for _ in range(2):
            partials.write_delta(spark.createDataFrame(new, SCHEMA), root, batch)
        if batch in (2, 4):
            partials.fold(spark, root, batch, least=2)
            partials.fold(spark, root, batch, least=99)
        with pytest.raises(ValueError, match="batches after"):
            partials.fold(spark, root, batch - 1, least=1) if batch else (_ for _ in ()).throw(ValueError("batches after"))
    want = aggregate.calendar_aggregate(spark.createDataFrame(every, SCHEMA), "weekly")
    assert picked(partials.windows(partials.read(spark, root), "weekly")) == picked(want)
    deltas = {r.batch for r in spark.read.parquet(f"{root}/deltas").select("batch").distinct().collect()}
    assert deltas == {3, 4, 5}  # what the fold before the last held is gone


# Tables


def test_bucketed_tables_join_without_exchange(spark):
    samples, daily = store_queries.bucketed(spark, SF)
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    joined = store_queries.bucketed_join(spark, samples, daily)
    assert "Exchange" not in plan(joined).split("Initial Plan")[-1] and "SortMergeJoin" in plan(joined)
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")  # else the plan doesn't tell what a plain scan prunes
    try:
        assert "SelectedBucketsCount: 1 out of 16" in plan(spark.table(daily).where("user_id = 7"))
    finally:
        spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")
    assert spark.table(daily).where("user_id = 7").count() == spark.table(daily).where("user_id % 150 = 7 and user_id < 8").count()


def test_swap_is_whole_or_nothing(spark, tmp_path):
    name = "swap_of_tests"
    tables.create_tables(spark, name, {"t": ("k long, v long, updated_at long, p string", ["p"])}, str(tmp_path / "db"))
    swap = lambda: tables.Swap(spark, f"{name}.t", str(tmp_path / "parts"), ["k", "p"], ["p"])
    df = lambda *r: spark.createDataFrame(list(r), "k long, v long, updated_at long, p string")
    now = lambda: {(r.k, r.v, r.p) for r in spark.table(f"{name}.t").collect()}
    a = swap()
    a.prepare(df((1, 1, 1, "x"), (2, 1, 1, "x"), (3, 1, 1, "y")))
    assert now() == set()
    a.exchange()
    assert now() == {(1, 1, "x"), (2, 1, "x"), (3, 1, "y")}
    b, c, d = swap(), swap(), swap()
    b.prepare(df((1, 5, 2, "x"), (9, 5, 2, "z")))
    c.prepare(df((2, 7, 3, "x")))
    d.prepare(df((3, 8, 3, "y")))
    assert now() == {(1, 1, "x"), (2, 1, "x"), (3, 1, "y")}
    b.exchange()
    with pytest.raises(tables.ChangedMeanwhile):
        c.exchange()
    d.exchange()  # another partition
    b.forget()
    assert now() == {(1, 5, "x"), (2, 1, "x"), (3, 8, "y"), (9, 5, "z")}
    again = swap()
    again.prepare(df((1, 0, 1, "x")))  # older than what is there
    again.exchange()
    assert (1, 5, "x") in now()


# Metrics


def test_percentiles_with_and_without_ranges(spark):
    df = spark.range(4000).select((F.col("id") % 3).alias("k"), F.when(F.col("id") % 11 != 0, F.col("id") * 7919 % 613).alias("v"))
    shares = {"p0": 0.0, "p50": 0.5, "p99": 0.99, "p100": 1.0}
    one, many = (sorted(map(tuple, metrics.exact_percentiles(df, "v", ["k"], shares, parts).collect())) for parts in (None, 16))
    assert one == many and len(one) == 3


def test_sketches_merge_to_the_same_as_of_all_rows(spark):
    df = spark.range(30_000).select((F.col("id") % 5).alias("k"), (F.col("id") % 7).alias("t"), (F.col("id") * 7919 % 10_007).cast("double").alias("v"), (F.col("id") * 31 % 20_000).alias("u"))
    parts = metrics.latency_sketches(df, "v", "k", "t")
    got = metrics.sketch_quantiles(metrics.merged_sketches(parts, "k"), {"p50": 0.5, "p95": 0.95}).collect()
    for r in got:
        values = sorted(x.v for x in df.where(F.col("k") == r.k).select("v").collect())
        for q, value in ((0.5, r.p50), (0.95, r.p95)):
            below, upto = sum(v < value for v in values) / r.n, sum(v <= value for v in values) / r.n
            assert below - metrics.SKETCH_ERROR <= q <= upto + metrics.SKETCH_ERROR
    users = metrics.united_users(metrics.user_sketches(df, "u", "k", "t")).select(metrics.user_count().alias("n")).first().n
    assert abs(users - 20_000) <= 0.03 * 20_000
