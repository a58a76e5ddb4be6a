"""Calendar windows, time zones and time texts as Column expressions. The session's time zone is UTC."""

from __future__ import annotations

import functools
import zoneinfo
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..rules import small_table

UNITS = {"daily": "day", "weekly": "week", "monthly": "month"}
_STEP = {"daily": "1 day", "weekly": "7 days", "monthly": "1 month"}


@dataclass(frozen=True)
class Window:
    """A calendar window: local dates and instants; ``end`` is exclusive."""

    first_date: Column
    last_date: Column
    start: Column
    end: Column

    @property
    def start_ms(self) -> Column:
        return F.unix_millis(self.start)

    @property
    def end_ms(self) -> Column:
        return F.unix_millis(self.end)

    @property
    def inclusive_end_ms(self) -> Column:
        return F.unix_millis(self.end) - 1


def local_window(ts: Column, zone: Column, kind: str) -> Window:
    """The local day, ISO week or month around an instant, by wall clock: days of clock changes have 23 or 25 hours."""
    first = F.date_trunc(UNITS[kind], F.from_utc_timestamp(ts, zone))
    after = first + F.expr(f"INTERVAL {_STEP[kind]}")
    return Window(F.to_date(first), F.date_sub(F.to_date(after), 1), F.to_utc_timestamp(first, zone), F.to_utc_timestamp(after, zone))


def utc_window(ts: Column, kind: str, aligned: bool = True) -> Window:
    """A fixed UTC window of 1, 7 or 30 days. ``aligned``: from midnight, Monday or the first of the month (30 days on); else from the epoch."""
    days = {"daily": 1, "weekly": 7, "monthly": 30}[kind]
    if aligned:
        start = F.date_trunc(UNITS[kind], ts)
    else:
        start = F.timestamp_seconds(F.floor(F.unix_seconds(ts) / (days * 86400)) * (days * 86400))
    end = start + F.expr(f"INTERVAL {days} DAYS")
    return Window(F.to_date(start), F.date_sub(F.to_date(end), 1), start, end)


def iso_year(d: Column) -> Column:
    return F.extract(F.lit("YEAROFWEEK"), d).cast("int")


def iso_week(d: Column) -> Column:
    return F.weekofyear(d)


def window_key(d: Column, kind: str) -> Column:
    """YYYY-MM-DD, YYYY-Www or YYYY-MM."""
    if kind == "weekly":
        return F.format_string("%d-W%02d", iso_year(d), iso_week(d))
    return F.date_format(d, "yyyy-MM-dd" if kind == "daily" else "yyyy-MM")


def days_in_month(d: Column) -> Column:
    return F.dayofmonth(F.last_day(d))


def millis_to_iso(ms: Column) -> Column:
    return F.date_format(F.timestamp_millis(ms), "yyyy-MM-dd'T'HH:mm:ss.SSS'+00:00'")


def iso_to_millis(text: Column) -> Column:
    """Epoch milliseconds of ISO 8601 text; without an offset it is UTC; null, empty and unreadable text gives null."""
    return F.unix_millis(F.try_to_timestamp(F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}([T ].*)?$"), text)))


def number_or_iso_to_iso(text: Column) -> Column:
    """ISO text of Unix seconds or of ISO text."""
    seconds = F.try_cast(text, "double") if hasattr(F, "try_cast") else text.try_cast("double")
    ts = F.coalesce(F.timestamp_millis(F.round(seconds * 1000).cast("long")), F.timestamp_millis(iso_to_millis(text)))
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def parse_week(text: Column) -> Column:
    """(year, week) of YYYY-Www with a year from 1900 to 2100 and a week from 1 to 53, else null."""
    year, week = (F.regexp_extract(text, r"^(\d{4})-W(\d{2})$", i).try_cast("int") for i in (1, 2))
    return F.when(year.between(1900, 2100) & week.between(1, 53), F.struct(year.alias("year"), week.alias("week")))


def parse_month(text: Column) -> Column:
    year, month = (F.regexp_extract(text, r"^(\d{4})-(\d{2})$", i).try_cast("int") for i in (1, 2))
    return F.when(year.between(1900, 2100) & month.between(1, 12), F.struct(year.alias("year"), month.alias("month")))


def parse_date(text: Column) -> Column:
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.to_date(F.try_to_timestamp(text, F.lit("yyyy-MM-dd"))))


@functools.cache
def zone_names(spark: SparkSession) -> tuple[str, ...]:
    """All names of the zone database, with a slash or not, that the JVM knows too; two of them name no zone."""
    zone = spark._jvm.java.time.ZoneId
    known = set(zone.getAvailableZoneIds()) | set(zone.SHORT_IDS.keySet())
    return tuple(sorted((zoneinfo.available_timezones() - {"Factory", "localtime"}) & known))


def zones(spark: SparkSession) -> DataFrame:
    """(zone): the valid zone names, a few hundred."""
    return small_table(spark, "zone", [(z,) for z in zone_names(spark)])


def with_zone(df: DataFrame, column: str = "timezone", default: str = "UTC", into: str = "resolved_timezone") -> DataFrame:
    """``into``: the zone of ``column`` if it is valid, else ``default``. Must come before any conversion: an unknown zone would stop the job."""
    valid = zones(df.sparkSession).select(F.col("zone").alias("__zone"))
    return df.join(F.broadcast(valid), F.col(column) == F.col("__zone"), "left").withColumn(into, F.coalesce("__zone", F.lit(default))).drop("__zone")


def zone_offset_seconds(ts: Column, zone: Column) -> Column:
    return F.unix_seconds(F.from_utc_timestamp(ts, zone)) - F.unix_seconds(ts)


def zone_offset_minutes(ts: Column, zone: Column) -> Column:
    return (zone_offset_seconds(ts, zone) / 60).cast("int")


def offset_agrees(ts: Column, zone: Column, offset_minutes: Column) -> Column:
    """True if the stated offset is missing, 0 or within an hour of the zone's at that instant."""
    return F.coalesce(offset_minutes == 0, F.lit(True)) | (F.abs(zone_offset_minutes(ts, zone) - offset_minutes) <= 60)
