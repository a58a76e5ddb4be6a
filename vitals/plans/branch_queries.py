"""Queries whose rows are changed so that they reach branches that the given tables leave out."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import rules
from ..operators import analytics, quality, query_api, validate
from ..sources import payloads as wire
from ..sources import tables
from ..streaming import job
from . import views as v
from .registry import _PROFILES, RANGE_CASE, USER, _profiles, query
from .storage_queries import _branch_schema, local

DAY_MS = 86_400_000


@query("f5_numeric_and_duration", f""", changed AS (SELECT *, sample_id % 5 AS i, CASE sample_id % 6 WHEN 0 THEN start_date + {8 * DAY_MS} WHEN 1 THEN start_date - 1 WHEN 2 THEN start_date + {7 * DAY_MS} ELSE end_date END AS last FROM samples)
SELECT sample_id,
  CASE WHEN i IN (0, 2) THEN 'not_numeric' WHEN i = 1 OR value < 0 THEN 'negative_value' WHEN start_date > last THEN 'start_after_end' WHEN {RANGE_CASE} THEN 'out_of_range' END AS reject_reason,
  last - start_date > {7 * DAY_MS} AS warn_long_duration
FROM changed""", "samples")
def f5(spark: SparkSession, sf: str) -> DataFrame:
    """Values that are no numbers or below 0, ends before starts, and durations of and over 7 days."""
    i, j, start = F.col("sample_id") % 5, F.col("sample_id") % 6, F.col("start_date")
    value = F.when(i == 0, "n/a").when(i == 1, "-3").when(i == 2, "NaN").otherwise(F.col("value").cast("string"))
    last = F.when(j == 0, start + 8 * DAY_MS).when(j == 1, start - 1).when(j == 2, start + 7 * DAY_MS).otherwise(F.col("end_date"))
    rows = v.samples(spark, sf).withColumns({"value": value, "end_date": last})
    return validate.validate_full(rows, rules.ranges(spark, "record")).select("sample_id", "reject_reason", "warn_long_duration")


_KINDS = ("heartRate", "steps", "sleepAnalysis", "bloodPressureSystolic", "bloodPressureDiastolic", "height")


@query("q11_all_limits", """, changed AS (SELECT sample_id, ['heartRate', 'steps', 'sleepAnalysis', 'bloodPressureSystolic', 'bloodPressureDiastolic', 'height'][CAST(sample_id % 6 AS INTEGER) + 1] AS data_type,
  CASE sample_id % 6 WHEN 1 THEN value * 200 WHEN 2 THEN value / 20 ELSE value END AS value FROM samples)
SELECT sample_id, data_type FROM changed WHERE CASE data_type WHEN 'heartRate' THEN value < 40 OR value > 200 WHEN 'steps' THEN value > 50000 WHEN 'sleepAnalysis' THEN value < 2 OR value > 16
  WHEN 'bloodPressureSystolic' THEN value > 180 WHEN 'bloodPressureDiastolic' THEN value > 120 ELSE false END""", "samples")
def q11(spark, sf):
    """Each of the outlier limits, and a type without any."""
    i, value = F.col("sample_id") % 6, F.col("value")
    kind = F.element_at(F.array(*map(F.lit, _KINDS)), (i + 1).cast("int"))
    rows = v.samples(spark, sf).select("sample_id", kind.alias("data_type"), F.when(i == 1, value * 200).when(i == 2, value / 20).otherwise(value).alias("value"))
    return quality.outliers(rows).select("sample_id", "data_type")


@query("j7_all_sources", f""", {_PROFILES}, q AS (SELECT user_id, arg_max(tz, updated_at) AS z FROM p WHERE user_id % 3 = 0 GROUP BY 1)
SELECT sample_id, CASE WHEN sample_id % 2 = 0 THEN timezone WHEN z IS NOT NULL THEN z WHEN sample_id % 5 = 0 THEN 'Europe/Paris' WHEN sample_id % 3 = 0 THEN 'Asia/Seoul' ELSE 'UTC' END AS zone
FROM samples s LEFT JOIN q ON s.user_id = q.user_id""", "samples")
def j7(spark, sf):
    """Zones of the row, the profile, the device, the locale and the default, each where what comes before is missing."""
    i = F.col("sample_id")
    metadata = F.create_map(F.lit("device_timezone"), F.when(i % 5 == 0, "Europe/Paris"), F.lit("locale"), F.when(i % 3 == 0, "ko_KR").otherwise("xx"))
    rows = v.samples(spark, sf).withColumns({"timezone": F.when(i % 2 == 0, F.col("timezone")), "metadata": metadata})
    return analytics.zone_by_priority(rows, _profiles(spark, sf).where("user_id % 3 = 0"), rules.LOCALE_ZONES).select("sample_id", "zone")


@query("q6_completeness_map", """SELECT user_id, data_type, aggregation_date, concat_ws(',', CASE WHEN count = 1 THEN 'stddev_value' END, CASE WHEN user_id % 2 = 0 THEN 'window_end' END, 'updated_at') AS missing,
  round((11 - CAST(count = 1 AS INTEGER) - CAST(user_id % 2 = 0 AS INTEGER)) / 12, 6) AS completeness FROM daily""", "daily")
def q6(spark, sf):
    """The names of the fields that an aggregate lacks, and the share of those it has."""
    rows = v.daily(spark, sf).withColumns({"stddev_value": F.when(F.col("count") != 1, F.col("stddev_value")), "window_end": F.when(F.col("user_id") % 2 != 0, F.col("window_end"))})
    missing = F.concat_ws(",", F.map_keys(F.map_filter(quality.completeness_map(rows.columns), lambda _, there: ~there)))
    return rows.select("user_id", "data_type", "aggregation_date", missing.alias("missing"), F.round(quality.completeness(rows.columns), 6).alias("completeness"))


@query("s9_tied_versions", "SELECT user_id, max(value) AS value, count(*) > 0 AS one FROM samples GROUP BY 1", "samples")
def s9_ties(spark, sf):
    """Rows of one key and one version: the largest stays, whichever comes first."""
    path = v.work(spark, "ties")
    rows = v.samples(spark, sf).select("user_id", (F.col("user_id") % 4).alias("part"), "value", F.lit(1).alias("updated_at"))
    even = F.col("value") % 2 < 1
    for half in (rows.where(even), rows.where(~even)):
        tables.upsert(spark, f"{path}/t", half, ["user_id"], ["part"], f"{path}/staging")
    return spark.read.schema("user_id long, value double, updated_at int, part long").parquet(f"{path}/t").groupBy("user_id").agg(F.max("value").alias("value"), (F.count("*") == 1).alias("one"))


@query("st16_batch_limit", "SELECT 5 AS batches, count(*) AS records FROM samples", "samples")
def st16(spark, sf):
    """A stream that takes one file at a time: as many batches as there are files, and every message once."""
    root = v.work(spark, "limited")
    v.messages(spark, sf).select("value").withColumn("f", F.pmod(F.xxhash64("value"), F.lit(5))).write.partitionBy("f").parquet(f"{root}/parts")
    for f in range(5):
        spark.read.parquet(f"{root}/parts/f={f}").coalesce(1).write.mode("append").parquet(f"{root}/in")

    def count(batch: DataFrame, batch_id: int) -> None:
        batch.agg(F.count("*").alias("n")).withColumn("batch", F.lit(batch_id)).write.mode("overwrite").parquet(f"{root}/out/{batch_id}")

    stream = wire.read_payload_stream(spark, f"{root}/in", max_files=1)
    stream.writeStream.foreachBatch(count).option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema("n long, batch int").option("recursiveFileLookup", True).parquet(f"{root}/out").agg(F.count_distinct("batch").cast("int").alias("batches"), F.sum("n").alias("records"))


@query("st10_branch_flags", f"SELECT false AS daily_stored, false AS monthly_stored, count(*) AS windows, CAST(sum(record_count) AS BIGINT) AS records FROM ({local('week', 'sound')})", "sound")
def st10(spark, sf):
    """Of the three branches one is enabled; the others store nothing."""
    root = v.work(spark, "branches")
    v.messages(spark, sf).select("value").write.parquet(f"{root}/in")
    stream = wire.read_payload_stream(spark, f"{root}/in")
    job.start(stream, f"{root}/out", f"{root}/checkpoint", branches=("weekly",), payloads=True, now_ms=F.lit(v.AS_OF_MS)).awaitTermination()
    there = {kind: F.lit(tables.stored(spark, f"{root}/out/{kind}")).alias(f"{kind}_stored") for kind in ("daily", "monthly")}
    weeks = spark.read.schema(_branch_schema("weekly")).parquet(f"{root}/out/weekly")
    return weeks.agg(F.count("*").alias("windows"), F.sum("record_count").alias("records")).select(*there.values(), "windows", "records")


_MARCH = dt.date(2024, 3, 1)
#: Parameters of a query of daily aggregates or top records, and what is wrong with them.
_REQUESTS = {
    "sound": {"user_id": USER, "data_type": "heartRate"},
    "blank user": {"user_id": " ", "data_type": "heartRate"},
    "blank type": {"user_id": USER, "data_type": ""},
    "start after end": {"user_id": USER, "data_type": "heartRate", "start": _MARCH, "end": dt.date(2024, 1, 1)},
    "unknown statistic": {"user_id": USER, "data_type": "heartRate", "sort_by": "mood"},
    "unknown order": {"user_id": USER, "data_type": "heartRate", "order": "up"},
    "limit too small": {"user_id": USER, "data_type": "heartRate", "limit": 0},
    "limit too large": {"user_id": USER, "data_type": "heartRate", "limit": 10_001},
    "all sound": {"user_id": USER, "data_type": "heartRate", "start": dt.date(2024, 1, 1), "end": _MARCH, "sort_by": "avg_value", "order": "asc", "limit": 10_000},
}


@query("f22_parameter_checks", f""", own AS (SELECT * FROM daily WHERE user_id = {USER} AND data_type = 'heartRate')
SELECT 'sound' AS request, CAST(NULL AS VARCHAR) AS field, least(10, count(*)) AS n FROM own WHERE aggregation_date BETWEEN DATE '2024-01-01' AND DATE '2024-01-31'
UNION ALL SELECT 'all sound', NULL, count(*) FROM own WHERE aggregation_date BETWEEN DATE '2024-01-01' AND DATE '2024-03-01'
UNION ALL SELECT r, f, 0 FROM (VALUES ('blank user', 'user_id'), ('blank type', 'data_type'), ('start after end', 'range'), ('unknown statistic', 'sort_by'), ('unknown order', 'order'), ('limit too small', 'limit'), ('limit too large', 'limit')) t(r, f)""", "daily")
def f22(spark, sf):
    """Rows of sound requests for top records; of the others the field that is refused before anything runs."""
    table, out = v.stored(spark, sf, "daily"), None
    for name, request in _REQUESTS.items():
        try:
            rows, field = query_api.top_records(table, as_of=v.AS_OF, **request), None
        except query_api.QueryError as e:
            rows, field = table.where("false"), e.field
        row = rows.agg(F.lit(name).alias("request"), F.lit(field).cast("string").alias("field"), F.count("*").alias("n"))
        out = row if out is None else out.unionByName(row)
    return out
