"""The whole job: payloads are decoded, flattened, validated, split, stored and aggregated, batch by batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.times import iso_to_millis, with_zone
from ..operators.aggregate import calendar_aggregate, fixed_aggregate
from ..operators.ingest import filled, flatten, sanitise
from ..operators.validate import error_records, split, validate_light
from ..schemas import ERROR
from ..sources.payloads import decode_wire, parse_json_body
from ..sources.tables import drift, fields, gate, stored, upsert, write_errors, write_partitioned
from . import partials as parts
from .calendar import once_each, touched_days
from .clocks import SourceClocks

BRANCHES = ("daily", "weekly", "monthly")
#: A batch's counts: rows and messages taken, faulty ones, windows written, payloads and samples that flattening leaves out.
METRICS = "batch long, records long, errors long, upserts long, dropped_payloads long, dropped_samples long"
PARTITION = {"daily": ["data_type", "aggregation_date"], "weekly": ["data_type", "year", "week_of_year"], "monthly": ["data_type", "year", "month"]}
KEY = {"daily": ["user_id", "data_type", "timezone", "aggregation_date"], "weekly": ["user_id", "data_type", "timezone", "year", "week_of_year"], "monthly": ["user_id", "data_type", "timezone", "year", "month"]}


def timed(df: DataFrame) -> DataFrame:
    """``validate_light``, and rows without a time above 0 are rejected as well.

    ``timezone`` becomes a valid name, UTC for unknown and missing ones, so that no conversion behind can stop;
    ``stated_timezone`` keeps what was there.
    """
    rows = validate_light(df)
    if "timezone" in df.columns:
        rows = with_zone(rows.withColumn("stated_timezone", F.col("timezone")), "stated_timezone", into="timezone")
    return rows.withColumn("reject_reason", F.coalesce("reject_reason", F.when(~F.coalesce(F.unix_millis("start_ts") > 0, F.lit(False)), "invalid_timestamp")))


def parsed(stream: DataFrame) -> DataFrame:
    """Framed messages (value) as sanitised payloads with a ``fault``, and the ``value`` of those that have one.

    Kept, a batch's JSON is read and cleaned once; behind filters both would be done again for each that names a field.
    """
    rows = parse_json_body(decode_wire(stream)).withColumn("fault", F.coalesce("wire_error", F.when(F.coalesce("payload.userId", "payload.deviceId").isNull(), "DESERIALIZATION_ERROR")))
    return sanitise(rows.select("payload.*", "fault", F.when(F.col("fault").isNotNull(), F.col("value")).alias("value")))


def message_counts(messages: DataFrame) -> DataFrame:
    """One row for ``parsed`` messages: messages, unreadable, dropped_payloads (readable ones without both ids and a time, or without samples), samples (of the others)."""
    sound = filled(F.col("userId")) & filled(F.col("deviceId")) & iso_to_millis(F.col("timestamp")).isNotNull() & (F.size("samples") > 0)
    rows = messages.select("fault", F.coalesce(sound, F.lit(False)).alias("sound"), F.size("samples").alias("n"))
    return rows.agg(F.count("*").alias("messages"), F.count("fault").alias("unreadable"), F.count_if(F.col("fault").isNull() & ~F.col("sound")).alias("dropped_payloads"), F.coalesce(F.sum(F.when(F.col("fault").isNull() & F.col("sound"), F.col("n"))), F.lit(0)).alias("samples"))


def decoded(stream: DataFrame, now_ms: Column) -> tuple[DataFrame, DataFrame]:
    """Measurements with ``start_ts`` of framed payloads (value), and error rows of the messages that can't be read."""
    return measured(parsed(stream), now_ms)


def measured(messages: DataFrame, now_ms: Column) -> tuple[DataFrame, DataFrame]:
    """The same of ``parsed`` messages."""
    flat = flatten(messages.where("fault is null"), now_ms).withColumn("start_ts", F.timestamp_millis("start_date"))
    bad = messages.where("fault is not null").select(F.hex("value").alias("message"), F.lit("message can't be read").alias("reason"))
    return flat, error_records(bad, "DESERIALIZATION_ERROR", now_ms, "reason")


def spread(batch: DataFrame) -> DataFrame:
    """``batch`` dealt evenly to the tasks of a shuffle: a file of few row groups would else be decoded, kept and sorted by as few tasks."""
    return batch.repartition(int(batch.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def batch_writer(root: str, branches: tuple[str, ...] = BRANCHES, fixed: bool = False, payloads: bool = False, now_ms: Column | None = None, partial_sums: bool = False, clocks: SourceClocks | None = None) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function. A batch that is run again writes the same: raw and error rows are stored by batch id, windows are recomputed and upserted.

    Raw rows are stored by UTC day, and a batch reads only the days that its windows reach. With ``partial_sums`` it reads
    no raw rows: what it adds is stored as partial sums (``partials``), from which the windows that it touches are merged;
    samples must then come once, see ``calendar.without_repeats``. ``clocks`` move with each batch, by its sound rows.
    """
    now = now_ms if now_ms is not None else F.unix_millis(F.current_timestamp())

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, seen = batch.sparkSession, Observation(f"batch-{batch_id}")
        batch = parsed(spread(batch)).persist() if payloads else spread(batch)  # kept: a filter behind would be moved before the deal, and the decoding with it
        flat, unreadable = measured(batch, now) if payloads else (batch, None)
        rows, near = timed(flat).persist(), None
        try:
            good, bad = split(rows)
            in_batch = lambda df: df.withColumn("batch", F.lit(batch_id))
            counted = rows.observe(seen, F.count("*").alias("records"), F.count("reject_reason").alias("errors"))
            stored_rows = counted.where("reject_reason is null").drop("reject_reason").withColumn("start_day", F.to_date("start_ts"))
            write_partitioned(in_batch(stored_rows), f"{root}/raw", ["start_day", "batch"], "overwrite", cluster=["user_id"])
            errors = error_records(bad, "VALIDATION_ERROR", now)
            errors = errors if unreadable is None else errors.unionByName(unreadable)
            write_errors(in_batch(errors), f"{root}/errors", "overwrite", more=["batch"])
            upserts = 0
            if clocks is not None:
                event = F.unix_millis("start_ts")
                clocks.advance(good, batch_id, event, now, F.max(now))
            once = good.dropDuplicates(["sample_id"])
            if partial_sums and branches:
                parts.write_delta(once, f"{root}/partials", batch_id)
            kinds = (() if partial_sums else branches) + (("daily",) if fixed else ())
            if kinds:
                raw = spark.read.schema(f"{batch_schema(good)}, start_day date, batch long").parquet(f"{root}/raw")
                near = once_each(raw.join(F.broadcast(touched_days(good, *kinds)), "start_day", "left_semi"), F.col("batch") == batch_id).persist()  # for all branches
            ids = {"user": dict(good.dtypes)["user_id"], "sample": dict(good.dtypes)["sample_id"]}
            for kind in branches:
                new = parts.touched(spark, f"{root}/partials", once, kind, **ids) if partial_sums else calendar_aggregate(near, kind, "fresh")
                new = new.withColumn("updated_at", F.lit(batch_id).cast("long")).persist()
                upserts += new.count()
                upsert(spark, f"{root}/{kind}", new, KEY[kind], PARTITION[kind])
                new.unpersist()
            if fixed:
                new = fixed_aggregate(near, "daily", touched="fresh").withColumn("updated_at", F.lit(batch_id).cast("long"))
                upsert(spark, f"{root}/fixed", new, ["user_id", "data_type", "aggregation_date"], ["data_type", "aggregation_date"])
            sent = message_counts(batch).first().asDict() if payloads else {"unreadable": 0, "dropped_payloads": 0, "samples": seen.get["records"]}
            counts = (batch_id, seen.get["records"] + sent["unreadable"], seen.get["errors"] + sent["unreadable"], upserts, sent["dropped_payloads"], sent["samples"] - seen.get["records"])
            table = spark.createDataFrame([counts], METRICS)
            table.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(f"{root}/metrics")
        finally:
            for kept in (rows, near, batch if payloads else None):
                if kept is not None:
                    kept.unpersist()

    return write


def batch_schema(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name != "reject_reason")


def checked_schema(spark: SparkSession, root: str, schema: DataFrame, allow_breaking: bool = False) -> None:
    """The gate at the start: stops if ``schema`` (its columns) breaks the stored raw table."""
    if stored(spark, f"{root}/raw"):
        old = spark.read.parquet(f"{root}/raw").drop("start_day", "batch", "stated_timezone")
        gate(drift(fields(spark, old.schema), fields(spark, schema.schema)), allow_breaking)


def start(stream: DataFrame, root: str, checkpoint: str, branches: tuple[str, ...] = BRANCHES, fixed: bool = False, interval: str | None = None, payloads: bool = False, now_ms: Column | None = None, allow_breaking: bool = False, partial_sums: bool = False, clocks: SourceClocks | None = None) -> StreamingQuery:
    """Starts the job on measurements, or with ``payloads`` on framed messages (value); without an ``interval`` it works through what is there and ends."""
    spark = stream.sparkSession
    if payloads:
        checked_schema(spark, root, decoded(stream, F.lit(0).cast("long"))[0], allow_breaking)
    else:
        checked_schema(spark, root, stream, allow_breaking)
    writer = stream.writeStream.foreachBatch(batch_writer(root, branches, fixed, payloads, now_ms, partial_sums, clocks)).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)).start()


def errors(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(f"{ERROR}, error_day date, batch long").parquet(f"{root}/errors")


def batch_equivalent(spark: SparkSession, rows: DataFrame, kind: str) -> DataFrame:
    good, _ = split(timed(rows))
    return calendar_aggregate(good.dropDuplicates(["sample_id"]), kind)
