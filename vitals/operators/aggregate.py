"""Statistics by calendar or fixed windows, and their merging."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, GroupedData
from pyspark.sql import functions as F
from pyspark.sql.window import Window as Over

from ..functions.times import Window, days_in_month, iso_week, iso_year, local_window, utc_window

PARTIALS = ("n", "total", "mean", "m2", "low", "high", "first", "last")


def statistics(value: str = "value", order: tuple[str, ...] = ("start_ts", "sample_id")) -> list[Column]:
    """count, sum, min, max, avg, population stddev, first and last in time order; null and NaN values don't count."""
    v = F.when(~F.isnan(value), F.col(value))
    at = F.when(v.isNotNull(), F.struct(*order))
    return [
        F.count(v).alias("count"),
        F.sum(v).alias("sum_value"),
        F.min(v).alias("min_value"),
        F.max(v).alias("max_value"),
        F.avg(v).alias("avg_value"),
        F.coalesce(F.stddev_pop(v), F.lit(0.0)).alias("stddev_value"),
        F.min_by(v, at).alias("first_value"),
        F.max_by(v, at).alias("last_value"),
        F.count("*").alias("record_count"),
    ]


def _keys(window: Window, kind: str) -> list[Column]:
    keys = [window.first_date.alias("first_date"), window.last_date.alias("last_date"), window.start_ms.alias("window_start"), window.end_ms.alias("window_end")]
    if kind == "daily":
        return [window.first_date.alias("aggregation_date"), *keys[2:]]
    if kind == "weekly":
        return [iso_year(window.first_date).alias("year"), iso_week(window.first_date).alias("week_of_year"), keys[0].alias("week_start_date"), keys[1].alias("week_end_date"), *keys[2:]]
    return [F.year(window.first_date).alias("year"), F.month(window.first_date).alias("month"), keys[0].alias("month_start_date"), keys[1].alias("month_end_date"), days_in_month(window.first_date).alias("days_in_month"), *keys[2:]]


def calendar_aggregate(df: DataFrame, kind: str, touched: str | None = None) -> DataFrame:
    """One row for each user, type, zone and local day, ISO week or month of ``df`` (user_id, data_type, timezone, start_ts, sample_id, value). One shuffle, after partial sums.

    With ``touched``, a boolean column, only windows that have a row where it is true.
    """
    keys = _keys(local_window(F.col("start_ts"), F.col("timezone"), kind), kind)
    return _touched(df.groupBy("user_id", "data_type", "timezone", *keys), touched)


def fixed_aggregate(df: DataFrame, kind: str, aligned: bool = True, touched: str | None = None) -> DataFrame:
    """The same by fixed UTC windows of 1, 7 or 30 days."""
    return _touched(df.groupBy("user_id", "data_type", *_keys(utc_window(F.col("start_ts"), kind, aligned), kind)), touched)


def _touched(groups: GroupedData, touched: str | None) -> DataFrame:
    if touched is None:
        return groups.agg(*statistics())
    return groups.agg(*statistics(), F.max(touched).alias("__touched")).where("__touched").drop("__touched")


def partials(df: DataFrame, keys: list[Column | str]) -> DataFrame:
    """Mergeable parts of ``df``: n, total, mean, m2 (squared distances from the mean), low, high, first, last; null and NaN values don't count."""
    v = F.when(~F.isnan("value"), F.col("value"))
    at = F.when(v.isNotNull(), F.struct("start_ts", "sample_id", "value"))
    return df.groupBy(*keys).agg(
        F.count(v).alias("n"), F.sum(v).alias("total"), F.avg(v).alias("mean"), (F.var_pop(v) * F.count(v)).alias("m2"), F.min(v).alias("low"), F.max(v).alias("high"), F.min(at).alias("first"), F.max(at).alias("last"), F.count("*").alias("rows"),
    )


def merged(parts: DataFrame, keys: list[Column | str]) -> DataFrame:
    """Parts of coarser keys. Squares are taken around the merged mean, so that nothing cancels.

    One shuffle by key, or none if ``parts`` lie by some of the keys: a key's parts meet in one task, as many as it has
    finer keys and batches, however many rows are behind them.
    """
    parts = parts.select(*keys, *PARTIALS, "rows")
    names = parts.columns[: -len(PARTIALS) - 1]
    key = Over.partitionBy(*names)
    rows = parts.withColumn("__mean", F.try_divide(F.sum(F.col("n") * F.col("mean")).over(key), F.sum("n").over(key)))
    apart = F.col("mean") - F.col("__mean")
    plain = [f(c).alias(c) for f, c in ((F.sum, "n"), (F.sum, "total"), (F.min, "low"), (F.max, "high"), (F.min, "first"), (F.max, "last"), (F.sum, "rows"))]
    return rows.groupBy(*names).agg(*plain, F.max("__mean").alias("mean"), F.sum(F.col("m2") + F.col("n") * apart * apart).alias("m2"))


def finished(parts: DataFrame) -> DataFrame:
    """Statistics of merged parts."""
    return parts.withColumns({
        "count": F.col("n"), "sum_value": F.col("total"), "min_value": F.col("low"), "max_value": F.col("high"), "avg_value": F.col("mean"),
        "stddev_value": F.coalesce(F.sqrt(F.try_divide(F.greatest(F.lit(0.0), "m2"), F.col("n"))), F.lit(0.0)),
        "first_value": F.col("first.value"), "last_value": F.col("last.value"), "record_count": F.col("rows"),
    }).drop(*PARTIALS, "rows")


def mean_of_daily_means(daily: DataFrame, keys: list[Column | str]) -> DataFrame:
    return daily.groupBy(*keys).agg(F.avg("avg_value").alias("daily_avg_of_avg"), F.count("*").alias("days"))
