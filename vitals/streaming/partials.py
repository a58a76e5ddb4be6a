"""Stored partial sums by local day: what a batch adds is written by batch, merged on read and folded now and then.

Days, weeks and months follow from the parts alone, so neither a batch nor a query reads a raw row again. Parts lie by
month; ``deltas`` hold what each batch adds, ``folded`` the merged parts of a month up to a batch. A batch that is run again
replaces its own deltas. Rows must not come twice in different batches: ``calendar.without_repeats`` goes before.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.times import local_window
from ..operators.aggregate import _keys, finished, merged, partials
from ..sources.tables import stored, write_partitioned

DAY = ["user_id", "data_type", "timezone", "day"]
#: Deltas of a month from which it is folded.
FOLD = 16


def delta(rows: DataFrame) -> DataFrame:
    """The parts of ``rows`` (user_id, data_type, timezone, start_ts, sample_id, value) by local day, with their ``month``."""
    day = local_window(F.col("start_ts"), F.col("timezone"), "daily").first_date
    return partials(rows.withColumn("day", day), list(DAY)).withColumn("month", F.trunc("day", "month"))


def write_delta(rows: DataFrame, root: str, batch_id: int) -> None:
    """Stores what a batch adds. Reads the batch alone."""
    write_partitioned(delta(rows).withColumn("batch", F.lit(batch_id).cast("long")), f"{root}/deltas", ["month", "batch"], "overwrite", cluster=["user_id"])


def _schema(spark: SparkSession, user: str, sample: str, more: str) -> str:
    at = f"struct<start_ts:timestamp,sample_id:{sample},value:double>"
    return f"user_id {user}, data_type string, timezone string, day date, n long, total double, mean double, m2 double, low double, high double, first {at}, last {at}, rows long, month date, {more} long"


def read(spark: SparkSession, root: str, user: str = "long", sample: str = "long") -> DataFrame:
    """All parts: of each month the last folded ones and the deltas of later batches. ``user`` and ``sample`` are the types of the ids."""
    deltas = spark.read.schema(_schema(spark, user, sample, "batch")).parquet(f"{root}/deltas")
    if not stored(spark, f"{root}/folded"):
        return deltas.drop("batch")
    folded = spark.read.schema(_schema(spark, user, sample, "upto")).parquet(f"{root}/folded")
    last = folded.groupBy("month").agg(F.max("upto").alias("__upto"))  # from partition values; a row for each month
    old = folded.join(F.broadcast(last), "month").where("upto = __upto").drop("upto", "__upto")
    new = deltas.join(F.broadcast(last), "month", "left").where("__upto is null or batch > __upto").drop("batch", "__upto")
    return old.unionByName(new)


def fold(spark: SparkSession, root: str, upto: int, least: int = FOLD, **ids: str) -> None:
    """Merges the parts of the months that have ``least`` deltas or more up to batch ``upto``.

    Readers take the old parts until a month's new ones are there. Folded parts go when the next fold has replaced them,
    and so do the deltas that they held: a reader that started before has what it listed.
    """
    deltas = spark.read.schema(_schema(spark, ids.get("user", "long"), ids.get("sample", "long"), "batch")).parquet(f"{root}/deltas")
    due = deltas.where(F.col("batch") <= upto).groupBy("month").agg(F.count_distinct("batch").alias("__n")).where(F.col("__n") >= least)
    months = [r.month for r in due.select("month").collect()]  # of stored months
    if not months:
        return
    before = {}
    if stored(spark, f"{root}/folded"):
        folded = spark.read.schema(_schema(spark, ids.get("user", "long"), ids.get("sample", "long"), "upto")).parquet(f"{root}/folded")
        before = {r.month: r.n for r in folded.where(F.col("month").isin(months)).groupBy("month").agg(F.max("upto").alias("n")).collect()}
    parts = read(spark, root, **ids).where(F.col("month").isin(months))
    if deltas.where((F.col("batch") > upto) & F.col("month").isin(months)).isEmpty():
        merged_parts = merged(parts, [*DAY, "month"])
    else:
        raise ValueError(f"there are batches after {upto}")
    columns = [c for c in parts.columns if c != "month"]
    write_partitioned(merged_parts.select(*columns, "month").withColumn("upto", F.lit(upto).cast("long")), f"{root}/folded", ["month", "upto"], "overwrite", cluster=["user_id"])
    for month, n in before.items():
        if n != upto:
            _drop(spark, f"{root}/folded/month={month}/upto={n}")
        for batch in [r.batch for r in deltas.where((F.col("month") == F.lit(month)) & (F.col("batch") <= n)).select("batch").distinct().collect()]:
            _drop(spark, f"{root}/deltas/month={month}/batch={batch}")


def _drop(spark: SparkSession, path: str) -> None:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


def windows(parts: DataFrame, kind: str) -> DataFrame:
    """Statistics by local day, ISO week or month from ``parts``, the same columns as ``aggregate.calendar_aggregate`` gives.

    Parts are dealt by user, type and zone, so the kinds of one query share a shuffle.
    """
    parts = parts.repartition(int(parts.sparkSession.conf.get("spark.sql.shuffle.partitions")), "user_id", "data_type", "timezone")
    at = F.to_utc_timestamp(F.col("day").cast("timestamp"), F.col("timezone"))
    return finished(merged(parts, ["user_id", "data_type", "timezone", *_keys(local_window(at, F.col("timezone"), kind), kind)]))


def touched(spark: SparkSession, root: str, batch: DataFrame, kind: str, **ids: str) -> DataFrame:
    """Statistics of the windows that ``batch`` touches, from the parts of the months around them."""
    unit = {"daily": "day", "weekly": "week", "monthly": "month"}[kind]
    day = local_window(F.col("start_ts"), F.col("timezone"), "daily").first_date
    first = lambda d: F.to_date(F.date_trunc(unit, d))
    keys = batch.select("user_id", "data_type", "timezone", first(day).alias("__first")).distinct()
    spans = keys.select(F.trunc("__first", "month").alias("low"), F.trunc(F.date_add("__first", 6 if kind == "weekly" else 0), "month").alias("high")).distinct()
    months = spans.select(F.explode(F.array("low", "high")).alias("month")).distinct()
    parts = read(spark, root, **ids).join(F.broadcast(months), "month", "left_semi").withColumn("__first", first(F.col("day")))
    return windows(parts.join(keys, ["user_id", "data_type", "timezone", "__first"], "left_semi").drop("__first"), kind)
