"""The driver's tables seen as measurements."""

from __future__ import annotations

import datetime as dt
import hashlib
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.aggregate import calendar_aggregate
from ..sources import tables

TYPES = {"view": "heartRate", "click": "steps", "purchase": "bloodGlucose", "signup": "oxygenSaturation"}
ZONES = ("Asia/Seoul", "America/New_York", "Europe/London", "UTC")
AS_OF = dt.date(2024, 1, 31)
AS_OF_MS = 1706659200000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def as_samples(events: DataFrame) -> DataFrame:
    kind = F
    for event, name in TYPES.items():
        kind = kind.when(F.col("event_type") == event, name)
    ts = F.col("ts").cast("timestamp")
    zone = F.element_at(F.array(*map(F.lit, ZONES)), (F.col("user_id") % 4 + 1).cast("int"))
    start = F.unix_millis(ts)
    return events.select(
        F.col("event_id").alias("sample_id"), "user_id", kind.otherwise("bodyTemperature").alias("data_type"), "value", ts.alias("start_ts"),
        start.alias("start_date"), (start + F.col("event_id") % 600 * 1000).alias("end_date"), zone.alias("timezone"), "props",
    )


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_samples(table(spark, sf_dir, "events"))


def purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as measurements over several years."""
    o = table(spark, sf_dir, "orders")
    return o.select(F.col("o_orderkey").alias("sample_id"), F.col("o_custkey").alias("user_id"), F.col("o_orderpriority").alias("data_type"), F.col("o_totalprice").alias("value"), F.col("o_orderdate").cast("timestamp").alias("start_ts"), F.lit("UTC").alias("timezone"))


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calendar_aggregate(samples(spark, sf_dir), "daily")


def weekly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calendar_aggregate(samples(spark, sf_dir), "weekly")


def monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calendar_aggregate(purchases(spark, sf_dir), "monthly")


def payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested payloads: a user's samples of an hour; ids, times and values as text."""
    iso = lambda ms: F.date_format(F.timestamp_millis(ms), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    s = F.struct(
        F.col("sample_id").cast("string").alias("id"), F.col("data_type").alias("type"), F.col("value").cast("string").alias("value"), F.lit(" count ").alias("unit"), iso(F.col("start_date")).alias("startDate"),
        iso(F.col("end_date")).alias("endDate"), F.lit(None).cast("string").alias("createdAt"), F.lit(None).cast("string").alias("sourceBundle"), F.lit(None).cast("boolean").alias("isSynced"), F.col("timezone"), F.lit(None).cast("int").alias("timezoneOffset"),
    )
    hour = F.date_trunc("hour", F.col("start_ts"))
    rows = samples(spark, sf_dir).groupBy("user_id", hour.alias("hour")).agg(F.transform(F.array_sort(F.collect_list(F.struct("sample_id", s.alias("s")))), lambda x: x["s"].withField("metadata", F.create_map(F.lit(" locale "), F.lit(" ko_KR ")))).alias("samples"))  # an hour of one user
    device = F.when(F.col("user_id") % 50 != 7, F.concat(F.lit(" device-"), F.col("user_id").cast("string")))
    return rows.select(device.alias("deviceId"), F.col("user_id").cast("string").alias("userId"), F.date_format("hour", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("timestamp"), F.lit("1.0").alias("appVersion"), "samples")


def work_root(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where that is unset, a temporary one in local mode; on a cluster an error."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir has to name a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="spark-vitals-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def work(spark: SparkSession, name: str) -> str:
    return f"{work_root(spark)}/vitals-{name}-{uuid.uuid4().hex}"


AGGREGATES = {"daily": daily, "weekly": weekly, "monthly": monthly}


#: Schemas of stored tables by their path.
_schemas: dict[str, str] = {}


def _state(spark: SparkSession, sf_dir: str) -> str:
    """Names, sizes and times of the files that stored tables are derived from: what is stored from other files isn't read."""
    out = []
    for name in ("events", "orders"):
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/{name}.parquet")
        files = path.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(path, True)
        while files.hasNext():
            f = files.next()
            out.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return repr(sorted(out))


def _kept(spark: SparkSession, sf_dir: str, name: str, rows: Callable[[], DataFrame], write: Callable[[DataFrame, str], None], more: str = "") -> DataFrame:
    """A table derived from ``sf_dir`` that the first call of an application writes and later ones read, as long as the files there are the same."""
    of = hashlib.md5(f"{sf_dir.rstrip('/')} {_state(spark, sf_dir)}".encode()).hexdigest()[:12]
    path = f"{work_root(spark)}/vitals-stored-{spark.sparkContext.applicationId}-{of}-{name}"
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    if path not in _schemas or not tables.stored(spark, path):
        df = rows()
        write(df, path)
        _schemas[path] = ", ".join([*(f"{n} {t}" for n, t in df.dtypes), *([more] if more and more.split()[0] not in df.columns else [])])
    return spark.read.schema(_schemas[path]).parquet(path)


def stored(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    """The stored aggregates of ``kind`` with their ``year``: queries read them by partition and sorted user."""
    write = lambda df, path: tables.write_aggregates(df, path, kind, "overwrite")
    return _kept(spark, sf_dir, kind, lambda: AGGREGATES[kind](spark, sf_dir), write, "year int")


def stored_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nested payloads, as they would lie in a landing table."""
    return _kept(spark, sf_dir, "payloads", lambda: payloads(spark, sf_dir), lambda df, path: df.write.mode("overwrite").parquet(path))


def stored_days(spark: SparkSession, sf_dir: str, first: dt.date, last: dt.date) -> DataFrame:
    """Stored daily aggregates of the years from ``first`` to ``last``: other partitions are not read."""
    return stored(spark, sf_dir, "daily").where(F.col("year").between(first.year, last.year))


def messages(spark: SparkSession, sf_dir: str, zone: Column | None = None) -> DataFrame:
    """Framed messages (sample_id, value) of one sample each, in ``zone`` if that is given. By sample_id: broken frames and texts, samples without type, number or time, and bad measurements."""
    i = F.col("sample_id")
    iso = lambda ms: F.date_format(F.timestamp_millis(ms), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    start = F.when(i % 17 == 5, -86_400_000).otherwise(F.col("start_date"))
    end = F.when(i % 17 == 4, start - 1000).when(i % 17 == 5, 1000).otherwise(F.col("end_date"))
    value = F.when(i % 17 == 3, -1 - F.col("value")).otherwise(F.col("value"))
    sample = F.struct(
        i.cast("string").alias("id"), F.when(i % 13 != 1, F.col("data_type")).alias("type"), F.when(i % 13 == 0, "n/a").otherwise(value.cast("string")).alias("value"), F.lit("count").alias("unit"),
        F.when(i % 13 == 2, "yesterday").otherwise(iso(start)).alias("startDate"), iso(end).alias("endDate"), (F.col("timezone") if zone is None else zone).alias("timezone"),
    )
    body = F.to_json(F.struct(F.lit("device").alias("deviceId"), F.col("user_id").cast("string").alias("userId"), F.lit("2024-01-31T00:00:00Z").alias("timestamp"), F.array(sample).alias("samples")))
    body = F.when(i % 11 == 1, '{"userId": ').otherwise(body)
    head = F.unhex(F.concat(F.when(i % 11 == 0, "01").otherwise("00"), F.lpad(F.hex(i), 8, "0")))
    return samples(spark, sf_dir).select("sample_id", F.concat(head, body.cast("binary")).alias("value"), body.alias("text"))
