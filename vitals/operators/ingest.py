"""From nested payloads to flat measurements."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.times import iso_to_millis
from ..rules import ALIASES, DATA_TYPES


def filled(c: Column) -> Column:
    return c.isNotNull() & (F.trim(c) != "")


def sanitise(payloads: DataFrame) -> DataFrame:
    """Trims ids, app version and each sample's id, type, unit, and its map's keys and values. Of keys that are equal then, the last one's value stays."""

    def clean_map(m: Column) -> Column:
        entries = F.transform(F.map_entries(m), lambda e: F.struct(F.trim(e["key"]).alias("key"), F.trim(e["value"]).alias("value")))
        keys = F.transform(entries, lambda e: e["key"])
        last = F.filter(entries, lambda e, i: ~F.array_contains(F.slice(keys, i + 2, F.size(keys)), e["key"]))
        return F.map_from_entries(F.when(F.size(F.array_distinct(keys)) == F.size(keys), entries).otherwise(last))

    def clean(s: Column) -> Column:
        for name in ("id", "type", "unit"):
            s = s.withField(name, F.trim(s[name]))
        return s.withField("metadata", clean_map(s["metadata"]))

    return payloads.withColumns({c: F.trim(c) for c in ("deviceId", "userId", "appVersion")} | {"samples": F.transform("samples", clean)})


def accepted_types(payloads: DataFrame, types: list[str] | tuple[str, ...] = tuple(DATA_TYPES)) -> Column:
    """True for payloads with samples, all of known types."""
    return (F.size("samples") > 0) & F.forall("samples", lambda s: s["type"].isin(*types, *ALIASES.values()))


def payload_errors(payloads: DataFrame, ranges: dict[str, tuple]) -> DataFrame:
    """``payloads`` with ``errors``: every fault of every sample with its index; one fault makes the payload invalid."""

    def faults(s: Column, i: Column) -> Column:
        value = s["value"].try_cast("double")
        low = F.create_map(*[x for t, (lo, _) in ranges.items() for x in (F.lit(t), F.lit(float(lo)))])[s["type"]]
        high = F.create_map(*[x for t, (_, hi) in ranges.items() for x in (F.lit(t), F.lit(float(hi)))])[s["type"]]
        fault = lambda bad, text: F.when(bad, F.struct(i.alias("index"), s["type"].alias("type"), F.lit(text).alias("error")))
        return F.array_compact(F.array(fault(value.isNull() | F.isnan(value), "not a number"), fault((value < low) | (value > high), "out of range"), fault((value <= 0) & (s["type"] != "bodyTemperature"), "not positive")))

    return payloads.withColumn("errors", F.flatten(F.transform("samples", faults)))


def flatten(payloads: DataFrame, processing_time: Column) -> DataFrame:
    """One measurement for each sound sample of each sound payload (``MEASUREMENT``). ``processing_time``: epoch milliseconds.

    A payload without ids or a readable timestamp goes, and a sample without id, type, numeric value, start or end.
    """
    sent = payloads.select("deviceId", "userId", "appVersion", iso_to_millis(F.col("timestamp")).alias("sent"), "samples").where(filled(F.col("deviceId")) & filled(F.col("userId")) & F.col("sent").isNotNull())
    rows = sent.select("*", F.explode("samples").alias("s"))
    rows = rows.select(
        F.col("deviceId").alias("device_id"),
        F.col("userId").alias("user_id"),
        F.col("s.id").alias("sample_id"),
        F.col("s.type").alias("data_type"),
        F.col("s.value").try_cast("double").alias("value"),
        F.col("s.unit").alias("unit"),
        iso_to_millis(F.col("s.startDate")).alias("start_date"),
        iso_to_millis(F.col("s.endDate")).alias("end_date"),
        F.col("s.sourceBundle").alias("source_bundle"),
        F.coalesce("s.metadata", F.create_map().cast("map<string,string>")).alias("metadata"),
        F.coalesce("s.isSynced", F.lit(False)).alias("is_synced"),
        F.coalesce(iso_to_millis(F.col("s.createdAt")), processing_time).alias("created_at"),
        F.col("sent").alias("payload_timestamp"),
        F.col("appVersion").alias("app_version"),
        processing_time.alias("processing_time"),
        F.coalesce("s.timezone", F.lit("UTC")).alias("timezone"),
        F.col("s.timezoneOffset").alias("timezone_offset"),
    )
    return rows.where(filled(F.col("sample_id")) & filled(F.col("data_type")) & F.col("value").isNotNull() & F.col("start_date").isNotNull() & F.col("end_date").isNotNull())
