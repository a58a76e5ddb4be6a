"""Parameterised queries over the aggregate tables."""

from __future__ import annotations

import datetime as dt
import re
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OPERATORS = {"==": "eq", "!=": "ne", ">": "gt", ">=": "ge", "<": "lt", "<=": "le"}
SORTABLE = ("max_value", "avg_value", "sum_value", "count")
MAX_LIMIT = 10_000


class QueryError(ValueError):
    """A structured parameter error."""

    def __init__(self, field: str, message: str) -> None:
        super().__init__(f"{field}: {message}")
        self.field, self.message = field, message


def predicates(filters: list[tuple[str, str, object]]) -> Column:
    """All of (column, operator, value)."""
    parts = []
    for column, op, value in filters:
        if op not in OPERATORS:
            raise QueryError(column, f"unsupported operator {op}")
        parts.append(getattr(F.col(column), f"__{OPERATORS[op]}__")(value))
    return reduce(lambda a, b: a & b, parts, F.lit(True))


def between_dates(column: str, start: dt.date, end: dt.date) -> Column:
    return F.col(column).between(F.lit(start), F.lit(end))


def between_pairs(first: str, second: str, start: tuple[int, int], end: tuple[int, int]) -> Column:
    """(first, second) from start to end, both included, as plain comparisons, so that partitions by ``first`` are pruned."""
    a, b = F.col(first), F.col(second)
    if start[0] == end[0]:
        return (a == start[0]) & b.between(start[1], end[1])
    return ((a == start[0]) & (b >= start[1])) | ((a > start[0]) & (a < end[0])) | ((a == end[0]) & (b <= end[1]))


def default_dates(as_of: dt.date, start: dt.date | None, end: dt.date | None, days: int = 30) -> tuple[dt.date, dt.date]:
    """Both ends, or the last ``days`` if either is missing."""
    return (start, end) if start and end else (as_of - dt.timedelta(days=days), as_of)


def default_weeks(as_of: dt.date, start, end, weeks: int = 12):
    first = as_of - dt.timedelta(weeks=weeks)
    return (start, end) if start and end else (tuple(first.isocalendar()[:2]), tuple(as_of.isocalendar()[:2]))


def default_months(as_of: dt.date, start, end, months: int = 6):
    n = as_of.year * 12 + as_of.month - 1 - months
    return (start, end) if start and end else ((n // 12, n % 12 + 1), (as_of.year, as_of.month))


def check_ids(**ids: object) -> None:
    for name, value in ids.items():
        if value is None or not str(value).strip():
            raise QueryError(name, "must not be blank")


def check_week(text: str) -> tuple[int, int]:
    m = re.fullmatch(r"(\d{4})-W(\d{2})", text)
    if not m or not 1900 <= int(m[1]) <= 2100 or not 1 <= int(m[2]) <= 53:
        raise QueryError("week", f"not YYYY-Www: {text}")
    return int(m[1]), int(m[2])


def check_month(text: str) -> tuple[int, int]:
    m = re.fullmatch(r"(\d{4})-(\d{2})", text)
    if not m or not 1900 <= int(m[1]) <= 2100 or not 1 <= int(m[2]) <= 12:
        raise QueryError("month", f"not YYYY-MM: {text}")
    return int(m[1]), int(m[2])


def check_order(start, end) -> None:
    if start > end:
        raise QueryError("range", "start after end")


def check_top(sort_by: str, order: str, limit: int) -> None:
    if sort_by not in SORTABLE:
        raise QueryError("sort_by", f"not one of {SORTABLE}")
    if order not in ("asc", "desc"):
        raise QueryError("order", "not asc or desc")
    if not 1 <= limit <= MAX_LIMIT:
        raise QueryError("limit", f"not from 1 to {MAX_LIMIT}")


def _own(table: DataFrame, user_id, data_type) -> DataFrame:
    check_ids(user_id=user_id, data_type=data_type)
    return table.where((F.col("user_id") == user_id) & (F.col("data_type") == data_type))


def daily_aggregates(table: DataFrame, user_id, data_type: str, as_of: dt.date, start: dt.date | None = None, end: dt.date | None = None) -> DataFrame:
    start, end = default_dates(as_of, start, end)
    check_order(start, end)
    return _own(table, user_id, data_type).where(between_dates("aggregation_date", start, end))


def weekly_aggregates(table: DataFrame, user_id, data_type: str, as_of: dt.date, start: str | None = None, end: str | None = None) -> DataFrame:
    first, last = default_weeks(as_of, start and check_week(start), end and check_week(end))
    check_order(first, last)
    return _own(table, user_id, data_type).where(between_pairs("year", "week_of_year", first, last))


def monthly_aggregates(table: DataFrame, user_id, data_type: str, as_of: dt.date, start: str | None = None, end: str | None = None) -> DataFrame:
    first, last = default_months(as_of, start and check_month(start), end and check_month(end))
    check_order(first, last)
    return _own(table, user_id, data_type).where(between_pairs("year", "month", first, last))


def _sort(sort_by: str, order: str) -> list[Column]:
    c = F.coalesce(F.col(sort_by), F.lit(0))
    return [c.desc() if order == "desc" else c.asc(), F.col("aggregation_date").asc()]


def top_records(table: DataFrame, user_id, data_type: str, as_of: dt.date, start=None, end=None, sort_by: str = "max_value", order: str = "desc", limit: int = 10) -> DataFrame:
    """The first ``limit`` days by a statistic (null counts as 0, ties by date) with their rank."""
    check_top(sort_by, order, limit)
    rows = daily_aggregates(table, user_id, data_type, as_of, start, end).orderBy(*_sort(sort_by, order)).limit(limit)
    return rows.withColumn("rank", F.row_number().over(Window.orderBy(*_sort(sort_by, order))))  # at most ``limit`` rows


def top_records_each(table: DataFrame, requests: DataFrame, sort_by: str = "max_value", order: str = "desc", limit: int = 10) -> DataFrame:
    """``top_records`` for many (user_id, data_type, start, end) at once."""
    check_top(sort_by, order, limit)
    rows = table.join(requests, ["user_id", "data_type"]).where(F.col("aggregation_date").between(F.col("start"), F.col("end")))
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy("user_id", "data_type", "start", "end").orderBy(*_sort(sort_by, order)))).where(F.col("rank") <= limit)


def envelope(rows: DataFrame, keys: list[str], requested: DataFrame | None = None) -> DataFrame:
    """{keys, records, count}: all records of each of ``keys``, in order. One response holds a date range of one user and type.

    Each of ``requested`` (keys) has a row, an empty result being no records and a count of 0; without it, what has records.
    """
    record = F.struct(*[c for c in rows.columns if c not in keys])
    found = rows.groupBy(*keys).agg(F.sort_array(F.collect_list(record)).alias("records"), F.count("*").alias("count"))
    if requested is None:
        return found
    every = requested.select(*keys).distinct().join(found, keys, "left")
    return every.withColumns({"records": F.coalesce("records", F.array().cast(found.schema["records"].dataType)), "count": F.coalesce("count", F.lit(0)).cast("long")})


def iso_text(c: Column) -> Column:
    """A timestamp as ISO text, with six digits of a second's fraction unless that is zero."""
    whole = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
    return F.when(F.date_format(c, "SSSSSS") == "000000", whole).otherwise(F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))


def as_text(df: DataFrame) -> DataFrame:
    """Dates and timestamps as ISO text."""
    kinds = dict(df.dtypes)
    return df.select(*[F.date_format(c, "yyyy-MM-dd").alias(c) if kinds[c] == "date" else iso_text(F.col(c)).alias(c) if kinds[c].startswith("timestamp") else F.col(c) for c in df.columns])
