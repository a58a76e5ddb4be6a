"""What streams report of themselves while they run, as a table of metrics."""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

PROGRESS = "query string, batch long, at string, input_rows long, rows_per_second double, watermark string, state_rows long, dropped_rows long"


class ProgressTable(StreamingQueryListener):
    """A row for each progress of each stream of the session: input rows and rate, watermark, rows in state, rows dropped as later than the watermark.

    Rows wait on the driver, a few numbers a batch, until ``flush`` appends them to the table at ``path``; ``every`` of
    them flush by themselves. Rows that an operator drops are counted as they reach it: before it, an aggregate has
    already merged those of one key and task.
    """

    def __init__(self, spark: SparkSession, path: str, every: int = 1000) -> None:
        self.spark, self.path, self.every = spark, path, every
        self.rows: list[tuple] = []
        self.over: set[str] = set()
        self.lock = threading.Condition()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        state = p.stateOperators
        row = (p.name or str(p.id), p.batchId, p.timestamp, p.numInputRows, p.inputRowsPerSecond, p.eventTime.get("watermark") if p.eventTime else None, sum(s.numRowsTotal for s in state), sum(s.numRowsDroppedByWatermark for s in state))
        with self.lock:
            self.rows.append(row)
            full = len(self.rows) >= self.every
        if full:
            self.flush()

    def onQueryTerminated(self, event) -> None:
        with self.lock:
            self.over.add(str(event.runId))
            self.lock.notify_all()

    def wait(self, run_id: str, seconds: float = 60.0) -> bool:
        """Until the end of a run has been reported, and so all its progress."""
        with self.lock:
            return self.lock.wait_for(lambda: str(run_id) in self.over, seconds)

    def flush(self) -> None:
        with self.lock:
            rows, self.rows = self.rows, []
        if rows:
            self.spark.createDataFrame(rows, PROGRESS).coalesce(1).write.mode("append").parquet(self.path)

    def table(self) -> DataFrame:
        self.flush()
        return self.spark.read.schema(PROGRESS).parquet(self.path)


def late_totals(progress: DataFrame) -> DataFrame:
    """Input rows, rows dropped as late and the share of them, for each stream of ``ProgressTable.table``."""
    dropped, rows = F.sum("dropped_rows"), F.sum("input_rows")
    return progress.groupBy("query").agg(rows.alias("input_rows"), dropped.alias("late_rows"), (F.try_divide(dropped, rows) * 100).alias("late_percent"))
