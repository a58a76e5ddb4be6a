"""Payload sources and sinks: JSON files, Kafka options, wire framing, dead-letter envelopes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import PAYLOAD

OFFSETS = {"earliest": "earliest", "latest": "latest"}


def kafka_options(servers: str, topic: str, offset_reset: str = "earliest", security: dict[str, str] | None = None, max_offsets: int | None = None) -> dict[str, str]:
    """Options of ``readStream.format("kafka")``. "committed" starts from the checkpoint, and so does any later run; unknown means earliest."""
    out = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": OFFSETS.get(offset_reset, "earliest"), "failOnDataLoss": "false"}
    out |= {f"kafka.{k}": v for k, v in (security or {}).items()}
    return out | ({"maxOffsetsPerTrigger": str(max_offsets)} if max_offsets else {})


def read_kafka(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    return spark.readStream.format("kafka").options(**options).load()


def decode_wire(df: DataFrame, value: str = "value") -> DataFrame:
    """``df`` with schema_id and body of framed messages: a zero byte, four bytes of id, the body; ``wire_error`` for others."""
    raw = F.col(value)
    good = (F.length(raw) >= 5) & (F.hex(F.substring(raw, 1, 1)) == "00")
    number = F.conv(F.hex(F.substring(raw, 2, 4)), 16, 10).cast("long")
    body = F.expr(f"substring({value}, 6)")
    return df.withColumns({"schema_id": F.when(good, number), "body": F.when(good, body), "wire_error": F.when(~F.coalesce(good, F.lit(False)), "DESERIALIZATION_ERROR")})


def parse_json_body(df: DataFrame, body: str = "body") -> DataFrame:
    """``df`` with ``payload``; null where the JSON is malformed."""
    return df.withColumn("payload", F.from_json(F.col(body).cast("string"), PAYLOAD, {"mode": "PERMISSIVE"}))


def read_payload_json(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Payloads of JSON lines, and the malformed lines (value): two views of one scan of the lines."""
    schema = f"{PAYLOAD}, _corrupt_record string"
    parsed = F.from_json("value", schema, {"columnNameOfCorruptRecord": "_corrupt_record"})
    rows = spark.read.text(path).where(F.trim("value") != "").withColumn("payload", parsed)
    return rows.where("payload._corrupt_record is null").select("payload.*").drop("_corrupt_record"), rows.where("payload._corrupt_record is not null").select("value")


def read_payload_stream(spark: SparkSession, path: str, max_files: int = 1000) -> DataFrame:
    """A stream of framed messages (value) from Parquet files, at most ``max_files`` in a batch."""
    return spark.readStream.schema("value binary").option("maxFilesPerTrigger", max_files).parquet(path)


def publish_payloads(payloads: DataFrame, options: dict[str, str], format: str = "kafka") -> None:
    """Sends payloads with their keys and headers; ``format`` and ``options`` name the sink."""
    kafka_columns(payloads).write.format(format).options(**options).save()


def kafka_columns(payloads: DataFrame) -> DataFrame:
    """key, value and headers of outgoing payloads."""
    header = lambda name, c: F.struct(F.lit(name).alias("key"), c.cast("string").cast("binary").alias("value"))
    value = F.to_json(F.struct(*payloads.columns))
    headers = F.array(header("request-id", F.sha2(value, 256)), header("device-id", F.col("deviceId")), header("app-version", F.col("appVersion")), header("sample-count", F.size("samples")))
    return payloads.select(F.col("userId").cast("binary").alias("key"), value.cast("binary").alias("value"), headers.alias("headers"))


def dlq_envelope(df: DataFrame, value: str, error_type: Column, message: Column, at: Column, metadata: Column, retries: int = 0) -> DataFrame:
    """``envelope``: JSON with the original message in hexadecimal digits, the error, retries and metadata."""
    body = F.struct(
        F.lower(F.hex(value)).alias("originalMessage"),
        F.struct(error_type.alias("type"), message.alias("message"), at.alias("timestamp")).alias("error"),
        F.lit(retries).alias("retryCount"),
        metadata.alias("metadata"),
        at.alias("dlqTimestamp"),
    )
    return df.withColumn("envelope", F.to_json(body))
