"""Faults that the review of round 3 found."""

import datetime as dt
import json

from pyspark.sql import functions as F

from vitals.operators import aggregate, analytics, metrics
from vitals.sources import tables
from vitals.streaming import calendar, job, partials, profiles

UTC = dt.timezone.utc


def test_closing_windows_pass_no_row_through_python(spark, tmp_path):
    """windows close at their end by the watermark, in the engine; rows without a value give no window."""
    schema = "sample_id long, user_id long, data_type string, timezone string, start_ts timestamp, value double"
    at = lambda day, hour=0: dt.datetime(2024, 3, day, hour, tzinfo=UTC)
    row = lambda i, when, value, user=1: (i, user, "steps", "Asia/Seoul", when, value)
    steps = [
        [row(1, at(8, 16), 1.0), row(2, at(8, 15), 2.0), row(3, at(8, 14), 7.0), row(4, at(8, 17), None, 2)],  # Seoul's ninth begins at 15
        [row(5, at(9, 15), 5.0, 3)],  # the watermark is at 13:50
        [row(6, at(8, 20), 4.0), row(7, at(9, 17), 1.0, 3)],  # the ninth is open still
        [row(8, at(8, 21), 99.0), row(9, at(20), 1.0, 4)],  # it is closed
    ]
    for step in steps:
        spark.createDataFrame(step, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        windows = calendar.closing_windows(spark.readStream.schema(schema).parquet(f"{tmp_path}/in"), "daily")
        assert "Python" not in windows._jdf.queryExecution().analyzed().toString() and "Pandas" not in windows._jdf.queryExecution().analyzed().toString()
        windows.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start().awaitTermination()
    out = spark.read.schema(calendar.OUTPUT).parquet(f"{tmp_path}/out")
    assert sorted((r.user_id, r["count"], r.sum_value, r.first_value, r.last_value) for r in out.collect()) == [(1, 1, 7.0, 7.0, 7.0), (1, 3, 7.0, 2.0, 4.0), (3, 2, 6.0, 5.0, 1.0)]


def test_files_are_full_but_one(spark, tmp_path):
    """a partition that many tasks write has one short file at most."""
    tables.DEAL, deal = 20, tables.DEAL
    try:
        rows = spark.range(0, 1005, 1, 7).select("id", F.when(F.col("id") % 5 > 0, F.col("id") % 2).alias("k"))
        tables.write_partitioned(rows, str(tmp_path / "t"), ["k"], records_per_file=10)
    finally:
        tables.DEAL = deal
    files = spark.read.parquet(str(tmp_path / "t")).groupBy("k", F.col("_metadata.file_path").alias("f")).agg(F.count("*").alias("n"))
    got = {r.k: (r.n, r.files, r.most) for r in files.groupBy("k").agg(F.sum("n").alias("n"), F.count("*").alias("files"), F.max("n").alias("most")).collect()}
    assert got == {None: (201, 21, 10), 0: (402, 41, 10), 1: (402, 41, 10)}


def test_percentiles_by_nearest_rank_are_exact(spark):
    """ranks of many values, where sketches of an accuracy of 10,000 are off."""
    df = spark.range(60_000).select((F.col("id") % 2).alias("k"), (F.col("id") * 7919 % 60_013).alias("v"))
    values = {k: sorted(i * 7919 % 60_013 for i in range(k, 60_000, 2)) for k in (0, 1)}
    for r in metrics.latency(df, "v", "k").collect():
        n = len(values[r.k])
        assert (r.n, r.p50, r.p95, r.p99) == (n, *(values[r.k][-(-n * p // 100) - 1] for p in (50, 95, 99)))
    r = metrics.latency(df.limit(0), "v").first()
    assert (r.n, r.p50) == (0, None)


def test_rows_of_many_users_wait_in_one_bucket(spark, tmp_path):
    """a bucket's rows share a timer, come out in any order and when they are due; a row without a user gets no zone."""
    calendar.rocksdb(spark)
    at = lambda minute: dt.datetime(2024, 3, 8, 10, minute, tzinfo=UTC)
    row, mark = "user_id long, sample_id long, start_ts timestamp", "user_id long, timezone string, updated_at timestamp"
    steps = [([(1, 1, at(5)), (2, 2, at(9)), (None, 3, at(7))], []), ([(2, 4, at(2))], [(1, "A", at(4)), (2, "B", at(9)), (2, "C", at(1))]), ([(9, 5, at(30))], [(1, "D", at(6))]), ([(9, 6, at(59))], [])]
    known = spark.createDataFrame([(1, "K", at(0)), (None, "N", at(0))], mark)
    for new_rows, new_marks in steps:
        spark.createDataFrame(new_rows, row).coalesce(1).write.mode("append").parquet(f"{tmp_path}/rows")
        spark.createDataFrame(new_marks, mark).coalesce(1).write.mode("append").parquet(f"{tmp_path}/marks")
        streams = [spark.readStream.schema(s).parquet(f"{tmp_path}/{n}") for s, n in ((row, "rows"), (mark, "marks"))]
        out = profiles.zone_as_of_stream(*streams, known, delay="10 minutes", buckets=1)
        out.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start().awaitTermination()
    got = {r.sample_id: (r.user_id, r.user_timezone) for r in spark.read.schema(profiles.OUTPUT).parquet(f"{tmp_path}/out").collect()}
    assert got == {1: (1, "A"), 2: (2, "B"), 3: (None, None), 4: (2, "C"), 5: (9, None)}


def test_batches_of_one_file_are_dealt_to_all_tasks(spark, tmp_path):
    """What a batch decodes and keeps isn't the work of as few tasks as its file has row groups."""
    df = spark.range(0, 1000, 1, 1)
    assert job.spread(df).rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert min(job.spread(df).rdd.glom().map(len).collect()) > 200


def test_bitmaps_count_users_exactly(spark):
    """more users than a sketch is exact for, below 0 and beyond a bitmap too."""
    df = spark.range(60_000).select((F.col("id") % 3).alias("w"), (F.col("id") * 7919 % 40_009 - 5).alias("u"), F.lit("x").alias("t"))
    users = {w: {i * 7919 % 40_009 - 5 for i in range(w, 60_000, 3)} for w in range(3)}
    bits = metrics.user_bitmaps(df, "u", "t", "w")
    got = {r.w: (r.users, r.next_users, r.kept) for r in metrics.kept_in_bitmaps(bits, "w", F.col("w") + 1, "t").collect()}
    assert got == {w: (len(users[w]), len(users[w + 1]), len(users[w] & users[w + 1])) for w in (0, 1)}
    assert metrics.counted_bitmaps(metrics.united_bitmaps(bits, "t"), "t").first().users == len(set().union(*users.values()))


def test_means_that_are_one_apart_but_for_rounding(spark):
    """64.1 - 63.1 is more than 1.0 in doubles alone."""
    rows = [(i, "x", dt.date(2024, 3, 8), a, b) for i, (a, b) in enumerate(((x / 100 + 1, x / 100) for x in range(0, 9000)))]
    df = spark.createDataFrame([*rows, (-1, "x", dt.date(2024, 3, 8), 2.01, 1.0)], "user_id long, data_type string, aggregation_date date, a double, b double")
    assert any(a - b > 1.0 for *_, a, b in rows)
    assert [r.user_id for r in analytics.compare_windows(df.withColumnRenamed("a", "avg_value"), df.withColumnRenamed("b", "avg_value")).collect()] == [-1]


def test_a_batch_is_decoded_once_and_its_raw_rows_are_read_once(spark, tmp_path, monkeypatch):
    """JSON and raw rows are read once for all branches; only windows with rows of the batch are written again, redelivered ones among them."""
    calls = []
    for name in ("parse_json_body", "once_each"):
        monkeypatch.setattr(job, name, lambda *a, n=name, f=getattr(job, name): calls.append(n) or f(*a))

    def message(i, user, day, value):
        sample = {"id": i, "type": "steps", "value": value, "unit": "count", "startDate": f"2024-01-{day:02}T12:00:00Z", "endDate": f"2024-01-{day:02}T12:00:05Z", "timezone": "Asia/Seoul"}
        return (bytearray(b"\0\0\0\0\1" + json.dumps({"deviceId": "d", "userId": user, "timestamp": "2024-01-31T00:00:00Z", "samples": [sample]}).encode()),)

    batches = [[message("1", "u", 3, "1"), message("2", "w", 3, "5"), message("3", "x", 9, "7"), (bytearray(b"\1x"),)], [message("4", "u", 3, "3"), message("3", "x", 9, "7")]]
    write = job.batch_writer(str(tmp_path), fixed=True, payloads=True, now_ms=F.lit(0).cast("long"))
    for i, batch in enumerate(batches):
        write(spark.createDataFrame(batch, "value binary"), i)
    assert sorted(calls) == ["once_each", "once_each", "parse_json_body", "parse_json_body"]
    for kind in ("daily", "weekly", "monthly", "fixed"):
        got = sorted((r.user_id, r["count"], r.sum_value, r.first_value, r.updated_at) for r in spark.read.parquet(f"{tmp_path}/{kind}").collect())
        assert got == [("u", 2, 4.0, 1.0, 1), ("w", 1, 5.0, 5.0, 0), ("x", 1, 7.0, 7.0, 1)], kind
    counts = sorted(tuple(r) for r in spark.read.schema(job.METRICS).parquet(f"{tmp_path}/metrics").select("batch", "records", "errors", "upserts").collect())
    assert counts == [(0, 4, 1, 9), (1, 2, 0, 6)]


def test_parts_are_merged_with_one_shuffle_and_without_a_join(spark, tmp_path):
    """days, weeks and months share a shuffle of the parts; spreads around large means stay exact, and a null key is a group."""
    at = lambda day, hour=0: dt.datetime(2024, 1, day, hour, tzinfo=UTC)
    rows = [(i, 1 + i % 2, "steps", "UTC", at(1 + i % 9, i % 5), 1e9 + i % 3) for i in range(60)] + [(99, 3, "steps", "UTC", at(4), float("nan"))]
    df = spark.createDataFrame(rows, "sample_id long, user_id long, data_type string, timezone string, start_ts timestamp, value double")
    for batch in range(3):
        partials.write_delta(df.where(F.col("sample_id") % 3 == batch), str(tmp_path), batch)
    for kind in ("daily", "weekly", "monthly"):
        got = partials.windows(partials.read(spark, str(tmp_path)), kind)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan
        columns = ["user_id", "window_start", "count", "min_value", "max_value", "first_value", "last_value", "record_count"]
        seen = lambda d: sorted((*[r[c] for c in columns], r.avg_value, round(r.stddev_value, 6)) for r in d.where("count > 0").collect())  # noqa: E731,B023
        assert seen(got) == seen(aggregate.calendar_aggregate(df, kind))
        assert got.where("count = 0").select("user_id", "avg_value", "stddev_value", "record_count").first()[:] == (3, None, 0.0, 1)
    parts = spark.createDataFrame([(None, 1, 2.0, 2.0, 0.0, 2.0, 2.0, 1.0, 2.0, 1), (None, 1, 4.0, 4.0, 0.0, 4.0, 4.0, 3.0, 4.0, 1)], "k string, n long, total double, mean double, m2 double, low double, high double, first double, last double, rows long")
    assert [(r.k, r.n, r["mean"], r.m2) for r in aggregate.merged(parts, ["k"]).collect()] == [(None, 2, 3.0, 2.0)]
