import datetime as dt

import pytest
from pyspark.sql import functions as F

from vitals.operators import aggregate
from vitals.streaming import calendar, job

SCHEMA = "sample_id long, user_id long, data_type string, timezone string, start_ts timestamp, value double, start_date long, end_date long"


def rows(days, first=0):
    start = dt.datetime(2024, 3, 8, tzinfo=dt.timezone.utc)
    return [(first + i, i % 3, "heartRate", ["UTC", "Asia/Seoul", "America/New_York"][i % 3], start + dt.timedelta(minutes=97 * i), float(i * 31 % 89), 0, 0) for i in range(days * 15)]


def picked(df):
    cols = ("user_id", "data_type", "timezone", "window_start", "window_end", "count", "sum_value", "min_value", "max_value", "first_value", "last_value")
    return {tuple(r[c] for c in cols): round(r.stddev_value, 6) for r in df.collect()}


def test_timers_give_the_batch_result(spark, tmp_path):
    pytest.importorskip("google.protobuf", reason="the state server of Python needs it")
    calendar.rocksdb(spark)
    data = spark.createDataFrame(rows(6), SCHEMA)
    data.where("sample_id < 50").write.parquet(str(tmp_path / "in/1"))
    data.where("sample_id >= 50").write.parquet(str(tmp_path / "in/2"))
    late = spark.createDataFrame([(999, 9, "heartRate", "UTC", dt.datetime(2024, 4, 1, tzinfo=dt.timezone.utc), 1.0, 0, 0)], SCHEMA)
    late.write.parquet(str(tmp_path / "in/3"))
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 100).parquet(str(tmp_path / "in/*"))
    q = calendar.closing_windows(stream, "daily").writeStream.format("memory").queryName("closed").outputMode("append").option("checkpointLocation", str(tmp_path / "c")).start()
    try:
        q.processAllAvailable()
        want = picked(aggregate.calendar_aggregate(data, "daily"))
        assert picked(spark.table("closed").where("user_id < 9")) == want
    finally:
        q.stop()


def test_job_upserts_late_data_and_repeats(spark, tmp_path):
    one, two = rows(4), rows(2, first=1000)  # the second batch is late data for the first days
    root, source = str(tmp_path / "out"), str(tmp_path / "in")
    bad = (5000, None, "heartRate", "UTC", one[0][4], 1.0, 0, 0)
    for batch in (one, [*two, two[0], bad]):
        spark.createDataFrame(batch, SCHEMA).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(SCHEMA).parquet(source)
        job.start(stream, root, f"{root}/checkpoint", ("daily", "monthly"), fixed=True).awaitTermination()
    everything = spark.createDataFrame([*one, *two], SCHEMA)
    for kind in ("daily", "monthly"):
        assert picked(spark.read.parquet(f"{root}/{kind}")) == picked(job.batch_equivalent(spark, everything, kind))
    assert spark.read.parquet(f"{root}/errors").count() == 1
    assert spark.read.parquet(f"{root}/metrics").agg(F.sum("records"), F.sum("errors")).first()[:] == (len(one) + len(two) + 2, 1)


def test_gate_stops_a_breaking_schema(spark, tmp_path):
    root, source = str(tmp_path / "out"), str(tmp_path / "in")
    spark.createDataFrame(rows(1), SCHEMA).write.parquet(source)
    job.start(spark.readStream.schema(SCHEMA).parquet(source), root, f"{root}/c1", ("daily",)).awaitTermination()
    narrower = SCHEMA.replace("value double", "value string")
    with pytest.raises(ValueError, match="breaking"):
        job.start(spark.readStream.schema(narrower).parquet(source), root, f"{root}/c2", ("daily",))


def test_state_of_several_batches_merges(spark):
    """The timer's running statistics over pandas batches equal those over all rows."""
    import numpy as np
    import pandas as pd

    class Handle:
        def __init__(self):
            self.kept, self.timers = None, []

        def getValueState(self, *_):
            return self

        def exists(self):
            return self.kept is not None

        def get(self):
            return self.kept

        def update(self, kept):
            self.kept = kept

        def clear(self):
            self.kept = None

        def registerTimer(self, at):
            self.timers.append(at)

    rng = np.random.default_rng(0)
    data = pd.DataFrame({"at_ms": rng.integers(0, 50, 300), "sample_id": np.arange(300), "value": 1e6 + rng.random(300)})
    data.loc[::7, "value"] = np.nan
    closer, handle = calendar.WindowCloser(), Handle()
    closer.init(handle)
    key = (1, "heartRate", "UTC", 0, 99)
    for part in (data[:100], data[100:101], data[101:]):
        list(closer.handleInputRows(key, iter([part[:40], part[40:]]), None))
    (out,) = closer.handleExpiredTimer(key, None, None)
    good = data.dropna().sort_values(["at_ms", "sample_id"])
    row = out.iloc[0]
    assert (row["count"], row.min_value, row.max_value, row.first_value, row.last_value) == (len(good), good.value.min(), good.value.max(), good.value.iloc[0], good.value.iloc[-1])
    assert row.sum_value == pytest.approx(good.value.sum()) and row.stddev_value == pytest.approx(good.value.std(ddof=0), rel=1e-6) and set(handle.timers) == {99}
