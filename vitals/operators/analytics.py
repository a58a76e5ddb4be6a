"""Joins, cohorts, trends and outliers over the aggregate tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def daily_summary(daily: DataFrame) -> DataFrame:
    """Heart rate days with steps and sleep of the same day; one shuffle by user and date instead of two self-joins."""
    pick = lambda t, c: F.max(F.when(F.col("data_type") == t, F.col(c)))
    rows = daily.where(F.col("data_type").isin("heartRate", "steps", "sleepAnalysis")).groupBy("user_id", "aggregation_date")
    return rows.agg(pick("heartRate", "avg_value").alias("avg_heart_rate"), pick("steps", "sum_value").alias("total_steps"), pick("sleepAnalysis", "avg_value").alias("avg_sleep_hours"), F.max(F.col("data_type") == "heartRate").alias("__has")).where("__has").drop("__has")


def daily_summary_joined(daily: DataFrame) -> DataFrame:
    """The same with two left joins."""
    part = lambda t, c, name: daily.where(F.col("data_type") == t).select("user_id", "aggregation_date", F.col(c).alias(name))
    on = ["user_id", "aggregation_date"]
    return part("heartRate", "avg_value", "avg_heart_rate").join(part("steps", "sum_value", "total_steps"), on, "left").join(part("sleepAnalysis", "avg_value", "avg_sleep_hours"), on, "left")


def z_scores(daily: DataFrame, least: float = 3.0) -> DataFrame:
    """Days further than ``least`` sample deviations from their user's and type's mean."""
    w = Window.partitionBy("user_id", "data_type")
    rows = daily.withColumns({"mean_value": F.avg("avg_value").over(w), "std_value": F.stddev("avg_value").over(w)})
    z = F.try_divide(F.abs(F.col("avg_value") - F.col("mean_value")), F.col("std_value"))
    return rows.withColumn("z_score", z).where(F.col("z_score") > least)


def z_scores_joined(daily: DataFrame, least: float = 3.0) -> DataFrame:
    """The same as a join of details with statistics."""
    stats = daily.groupBy("user_id", "data_type").agg(F.avg("avg_value").alias("mean_value"), F.stddev("avg_value").alias("std_value"))
    rows = daily.join(stats, ["user_id", "data_type"])
    return rows.withColumn("z_score", F.try_divide(F.abs(F.col("avg_value") - F.col("mean_value")), F.col("std_value"))).where(F.col("z_score") > least)


def compare_windows(fixed: DataFrame, calendar: DataFrame, least: float = 1.0) -> DataFrame:
    """Days whose means by both windows are more than ``least`` apart. A distance that is ``least`` but for the rounding of sums, which depends on their order, isn't more."""
    keys = ["user_id", "data_type", "aggregation_date"]
    rows = fixed.select(*keys, F.col("avg_value").alias("fixed_avg")).join(calendar.select(*keys, F.col("avg_value").alias("calendar_avg")), keys)
    rounding = F.greatest(F.lit(1.0), F.abs("fixed_avg"), F.abs("calendar_avg")) * 1e-12
    return rows.withColumn("diff", F.abs(F.col("fixed_avg") - F.col("calendar_avg"))).where(F.col("diff") > least + rounding)


def zone_as_of(samples: DataFrame, profiles: DataFrame) -> DataFrame:
    """Each sample with its user's last zone set no later than the sample: ``profiles`` (user_id, timezone, updated_at).

    Both sides are dealt by user and ordered by time once; the last zone is carried forward, so nothing multiplies.
    """
    cols = samples.columns
    rows = samples.withColumns({"__at": F.col("start_ts"), "__kind": F.lit(1), "__zone": F.lit(None).cast("string")})
    marks = profiles.select("user_id", F.col("updated_at").alias("__at"), F.lit(0).alias("__kind"), F.col("timezone").alias("__zone"))
    both = rows.unionByName(marks, allowMissingColumns=True)
    w = Window.partitionBy("user_id").orderBy("__at", "__kind").rowsBetween(Window.unboundedPreceding, 0)
    return both.withColumn("user_timezone", F.last("__zone", ignorenulls=True).over(w)).where("__kind = 1").select(*cols, "user_timezone")


def zone_latest(stream: DataFrame, profiles: DataFrame) -> DataFrame:
    """Each row with its user's latest zone: a join with a table of one row a user."""
    latest = profiles.groupBy("user_id").agg(F.max_by("timezone", "updated_at").alias("user_timezone"))
    return stream.join(latest, "user_id", "left")


def zone_by_priority(rows: DataFrame, profiles: DataFrame, locales: dict[str, str], default: str = "UTC") -> DataFrame:
    """``zone``: the row's own, the profile's, the device's, the locale's or the default."""
    table = F.create_map(*[F.lit(x) for kv in locales.items() for x in kv])
    joined = zone_latest(rows, profiles)
    locale = F.try_element_at(table, F.coalesce(F.try_element_at("metadata", F.lit("locale")), F.lit("")))
    return joined.withColumn("zone", F.coalesce("timezone", "user_timezone", F.try_element_at("metadata", F.lit("device_timezone")), locale, F.lit(default)))


def travellers_days(daily: DataFrame, samples: DataFrame, users: int = 10) -> DataFrame:
    """Days of the first ``users`` users with a zone other than UTC."""
    some = samples.where("timezone <> 'UTC'").select("user_id").distinct().orderBy("user_id").limit(users)
    return daily.join(some, "user_id", "left_semi")


def lagged(table: DataFrame, partition: list[str], order: list[str], value: str, offsets: dict[str, int]) -> DataFrame:
    w = Window.partitionBy(*partition).orderBy(*order)
    return table.withColumns({name: F.lag(value, n).over(w) for name, n in offsets.items()})


def percent_change(now: str, before: str):
    return F.try_divide(F.col(now) - F.col(before), F.col(before)) * 100


def moving_average(daily: DataFrame, rows: int = 7) -> DataFrame:
    w = Window.partitionBy("user_id", "data_type").orderBy("aggregation_date").rowsBetween(1 - rows, 0)
    return daily.withColumn("moving_avg", F.avg("avg_value").over(w))


def year_pivot(monthly: DataFrame, years: list[int], keys: list[str]) -> DataFrame:
    return monthly.where(F.col("year").isin(*years)).groupBy(*keys, "month").agg(*[F.max(F.when(F.col("year") == y, F.col("avg_value"))).alias(f"avg_{y}") for y in years])


def cohorts(daily: DataFrame, low: float = 60, high: float = 100) -> DataFrame:
    bucket = F.when(F.col("avg_value") < low, "Low").when(F.col("avg_value") <= high, "Normal").otherwise("High")
    return daily.groupBy(bucket.alias("category")).agg(F.countDistinct("user_id").alias("user_count"), F.avg("avg_value").alias("avg_value"))


def several_zones(samples: DataFrame) -> DataFrame:
    rows = samples.groupBy("user_id").agg(F.array_sort(F.collect_set("timezone")).alias("timezones"))  # zones of a user are few
    return rows.withColumn("timezone_count", F.size("timezones").cast("long")).where("timezone_count > 1")


def duplicates(samples: DataFrame) -> DataFrame:
    return samples.groupBy("sample_id").agg(F.count("*").alias("n")).where("n > 1")
