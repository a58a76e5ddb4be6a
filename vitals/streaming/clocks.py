"""Watermarks from a clock of each source: a source that is silent for too long no longer holds the others back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import stored

CLOCKS = "source string, newest_ms long, heard_ms long, batch long"
WATERMARKS = "now_ms long, watermark_ms long, sources long, active_sources long, batch long"


class SourceClocks:
    """Clocks of sources, kept in tables under ``root`` from batch to batch.

    A clock is the newest event time of its source. The watermark is the least clock of the sources that were heard of
    within ``idle_ms``, less ``delay_ms``; it never falls, and stays where it is while all are silent. An idle source that
    comes back holds it again. Rows are late by the watermark that the batches before have left. A batch that is run again
    starts from the same clocks and writes the same. Tables have a row for each source and batch, of the last ``keep``
    batches, and a row for each batch.
    """

    def __init__(self, root: str, source: str, delay_ms: int = 600_000, idle_ms: int = 300_000, keep: int = 100) -> None:
        self.root, self.source, self.delay_ms, self.idle_ms, self.keep = root, source, delay_ms, idle_ms, keep

    def watermarks(self, spark: SparkSession) -> DataFrame:
        """The watermark that each batch leaves behind (``WATERMARKS``)."""
        return spark.read.schema(WATERMARKS).parquet(f"{self.root}/watermarks")

    def _before(self, spark: SparkSession, batch_id: int) -> tuple[DataFrame, int | None]:
        empty = spark.createDataFrame([], "source string, newest_ms long, heard_ms long")
        if not stored(spark, f"{self.root}/watermarks"):
            return empty, None
        last = self.watermarks(spark).where(F.col("batch") < batch_id).agg(F.max_by("watermark_ms", "batch"), F.max("batch")).first()
        if last[1] is None:
            return empty, None
        return spark.read.schema(CLOCKS).parquet(f"{self.root}/clocks").where(F.col("batch") == last[1]).drop("batch"), last[0]

    def advance(self, batch: DataFrame, batch_id: int, event_ms: Column, arrival_ms: Column, now_ms: Column | None = None) -> DataFrame:
        """``batch`` with ``late``; the clocks move. ``now_ms`` is an aggregate of the batch, by default the present."""
        spark = batch.sparkSession
        old, watermark = self._before(spark, batch_id)
        source = F.coalesce(F.col(self.source).cast("string"), F.lit(""))
        now = batch.agg((F.unix_millis(F.current_timestamp()) if now_ms is None else now_ms).alias("now")).first()[0]
        heard = batch.groupBy(source.alias("source")).agg(F.max(event_ms).alias("newest_ms"), F.max(arrival_ms).alias("heard_ms"))
        clocks = old.unionByName(heard).groupBy("source").agg(F.max("newest_ms").alias("newest_ms"), F.max("heard_ms").alias("heard_ms"))
        self._write(clocks, "clocks", batch_id)
        clocks = spark.read.schema(CLOCKS).parquet(f"{self.root}/clocks").where(F.col("batch") == batch_id)
        active = F.col("heard_ms") >= F.lit(now) - self.idle_ms
        least = F.min(F.when(active, F.col("newest_ms"))) - self.delay_ms
        moved = F.greatest(least, F.lit(watermark).cast("long"))
        self._write(clocks.agg(F.lit(now).cast("long").alias("now_ms"), moved.alias("watermark_ms"), F.count("*").alias("sources"), F.count_if(active).alias("active_sources")), "watermarks", batch_id)
        self._forget(spark, batch_id - self.keep)
        return batch.withColumn("late", F.coalesce(event_ms < F.lit(watermark).cast("long"), F.lit(False)))

    def _write(self, df: DataFrame, name: str, batch_id: int) -> None:
        df.coalesce(1).withColumn("batch", F.lit(batch_id).cast("long")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(f"{self.root}/{name}")  # a row for each source

    def _forget(self, spark: SparkSession, batch_id: int) -> None:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/clocks/batch={batch_id}")
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
