"""Calendar aggregates in streams: keyed state with event-time timers, or recomputation of touched windows."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..functions.times import local_window
from ..operators.aggregate import statistics
from ..sources.tables import newest

#: Watermark delay and allowed lateness by kind.
DELAY = "10 minutes"
LATENESS = {"daily": "1 hour", "weekly": "6 hours", "monthly": "12 hours"}
OUTPUT = "user_id long, data_type string, timezone string, window_start long, window_end long, count long, sum_value double, min_value double, max_value double, avg_value double, stddev_value double, first_value double, last_value double"


class WindowCloser(StatefulProcessor):
    """Running statistics of a local window; a timer at the window's end emits and clears them."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("sums", "n long, total double, mean double, m2 double, low double, high double, first_at long, first_id long, first double, last_at long, last_id long, last double")  # the timer clears it, at the latest a month and the delay later

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        n, total, mean, m2, low, high, fa, fi, fv, la, li, lv = self.state.get() if self.state.exists() else (0, 0.0, 0.0, 0.0, float("inf"), float("-inf"), None, None, None, None, None, None)
        for part in rows:
            part = part[part["value"].notna()]
            if part.empty:
                continue
            v = part["value"].astype(float)
            k, there, apart = len(v), float(v.mean()), float(v.mean()) - mean
            m2 += float(((v - there) ** 2).sum()) + apart * apart * n * k / (n + k)
            mean += apart * k / (n + k)
            n, total = n + k, total + float(v.sum())
            low, high = min(low, float(v.min())), max(high, float(v.max()))
            order = part.sort_values(["at_ms", "sample_id"])
            head, tail = ((int(r["at_ms"]), int(r["sample_id"]), float(r["value"])) for r in (order.iloc[0], order.iloc[-1]))
            if fa is None or head[:2] < (fa, fi):
                fa, fi, fv = head
            if la is None or tail[:2] > (la, li):
                la, li, lv = tail
        if n:
            self.state.update((n, total, mean, m2, low, high, fa, fi, fv, la, li, lv))
            self.handle.registerTimer(int(key[4]))
        yield pd.DataFrame()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.state.exists():
            n, total, mean, m2, low, high, _, _, fv, _, _, lv = self.state.get()
            self.state.clear()
            yield pd.DataFrame({"user_id": [key[0]], "data_type": [key[1]], "timezone": [key[2]], "window_start": [key[3]], "window_end": [key[4]], "count": [n], "sum_value": [total], "min_value": [low], "max_value": [high], "avg_value": [mean], "stddev_value": [max(0.0, m2 / n) ** 0.5], "first_value": [fv], "last_value": [lv]})

    def close(self) -> None:
        pass


class RefiringWindow(WindowCloser):
    """Statistics of a local window that is emitted at its end and again with each batch of late rows, until the lateness is over.

    Two timers: at the window's end the first result is emitted, and when the allowed lateness has passed the state is
    cleared. ``firing`` numbers the results. Rows that come after that go.
    """

    def __init__(self, lateness_ms: int) -> None:
        self.lateness_ms = lateness_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.fired = handle.getValueState("fired", "n int")

    def _result(self, key) -> Iterator[pd.DataFrame]:
        n, total, mean, m2, low, high, _, _, fv, _, _, lv = self.state.get()
        firing = (self.fired.get()[0] if self.fired.exists() else 0) + 1
        self.fired.update((firing,))
        yield pd.DataFrame({"user_id": [key[0]], "data_type": [key[1]], "timezone": [key[2]], "window_start": [key[3]], "window_end": [key[4]], "count": [n], "sum_value": [total], "min_value": [low], "max_value": [high], "avg_value": [mean], "stddev_value": [max(0.0, m2 / n) ** 0.5], "first_value": [fv], "last_value": [lv], "firing": [firing]})

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        now, before = timerValues.getCurrentWatermarkInMs(), self.state.get()[0] if self.state.exists() else 0
        if now >= key[4] + self.lateness_ms:
            return
        yield from super().handleInputRows(key, rows, timerValues)
        if not self.state.exists():
            return
        self.handle.registerTimer(int(key[4]) + self.lateness_ms)
        if now >= key[4] and self.fired.exists() and self.state.get()[0] > before:
            yield from self._result(key)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        over = expiredTimerInfo.getExpiryTimeInMs() >= key[4] + self.lateness_ms
        if self.state.exists() and not self.fired.exists():
            yield from self._result(key)
        if over:
            self.state.clear()
            self.fired.clear()


def refiring_windows(stream: DataFrame, kind: str, delay: str = DELAY, lateness: str | None = None) -> DataFrame:
    """Statistics of each local window of ``stream``, ``firing`` 1 once the watermark passes its end, and then again with each batch of late rows.

    ``lateness``: how long after its end a window stays open, by default that of ``kind``. Rows of an open window count
    however late they are, others go; ``latest_firings`` or an upsert by the window's key gives the last results. Needs the
    RocksDB state store.
    """
    lateness_ms = int(pd.Timedelta(lateness or LATENESS[kind]).total_seconds() * 1000)
    w = local_window(F.col("start_ts"), F.col("timezone"), kind)
    # the event time itself isn't handed on: else Spark would drop rows before the watermark whose windows are open
    rows = stream.withWatermark("start_ts", delay).select("user_id", "data_type", "timezone", w.start_ms.alias("window_start"), w.end_ms.alias("window_end"), F.unix_millis("start_ts").alias("at_ms"), "sample_id", "value")
    return rows.groupBy("user_id", "data_type", "timezone", "window_start", "window_end").transformWithStateInPandas(RefiringWindow(lateness_ms), f"{OUTPUT}, firing int", "append", "EventTime")


def latest_firings(results: DataFrame) -> DataFrame:
    """The last result of each window of ``refiring_windows``."""
    return newest(results, ["user_id", "data_type", "timezone", "window_start", "window_end"], "firing")


def watermark_delay(kind: str) -> str:
    """The watermark's delay and the lateness that windows of ``kind`` allow: rows up to that late still count."""
    return f"{DELAY} {LATENESS[kind]}"


def closing_windows(stream: DataFrame, kind: str, delay: str | None = None) -> DataFrame:
    """Final statistics of each local window of ``stream`` (user_id, data_type, timezone, start_ts, sample_id, value), once the watermark passes its end.

    ``delay``: by default the bounded disorder and the allowed lateness of ``kind`` together, so a window closes once, with
    all rows that are no later. Spark's own session windows, so no key and no row passes through Python.
    """
    w = local_window(F.col("start_ts"), F.col("timezone"), kind)
    keys = ["user_id", "data_type", "timezone", "window_start", "window_end"]
    rows = stream.withWatermark("start_ts", delay or watermark_delay(kind)).select("user_id", "data_type", "timezone", w.start_ms.alias("window_start"), w.end_ms.alias("window_end"), "start_ts", "sample_id", "value")
    # a session from each row to its window's end: those of one window overlap and become one, which the watermark closes at that end
    left = F.make_interval(secs=(F.col("window_end") * 1000 - F.unix_micros("start_ts")).cast("decimal(20,0)") / F.lit(1_000_000).cast("decimal(7,0)"))
    windows = rows.groupBy(*keys, F.session_window("start_ts", left)).agg(*statistics())
    return windows.where("count > 0").select(*[c.split()[0] for c in OUTPUT.split(", ")])


def touched_days(batch: DataFrame, *kinds: str) -> DataFrame:
    """(start_day): the UTC days that can hold rows of the windows of ``kinds`` that ``batch`` touches: at most a row for each day there is."""
    days = batch.select(local_window(F.col("start_ts"), F.col("timezone"), "daily").first_date.alias("day")).distinct()
    windows = [local_window(F.col("day").cast("timestamp"), F.lit("UTC"), k) for k in kinds]
    spans = F.array(*[F.sequence(F.date_sub(w.first_date, 1), F.date_add(w.last_date, 1)) for w in windows])
    return days.select(F.explode(F.flatten(spans)).alias("start_day")).distinct()


def once_each(raw: DataFrame, fresh: Column) -> DataFrame:
    """One row of each sample id of ``raw`` with what statistics need, and ``fresh``: whether ``fresh`` holds for any of its rows."""
    columns = ["user_id", "data_type", "timezone", "start_ts", "value"]
    return raw.groupBy("sample_id").agg(*[F.first(c).alias(c) for c in columns], F.max(fresh).alias("fresh"))


def without_redelivered(stream: DataFrame, delay: str = DELAY) -> DataFrame:
    """One row of each sample id within the watermark."""
    return stream.withWatermark("start_ts", delay).dropDuplicatesWithinWatermark(["sample_id"])


class Repeats(StatefulProcessor):
    """Rows whose id hasn't come within the lifetime of the ids kept; an id's lifetime starts anew with each row that passes.

    The ids of a slot lie in one value with the times they passed, so calls grow with slots and batches, not with rows.
    """

    def __init__(self, key: str, lifetime_ms: int) -> None:
        self.key, self.lifetime_ms = key, lifetime_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "ids array<string>, times array<long>", ttlDurationMs=self.lifetime_ms)  # the last that passed outlives the others

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentProcessingTimeInMs()
        before = zip(*self.seen.get(), strict=True) if self.seen.exists() else ()
        kept = {i: at for i, at in before if at + self.lifetime_ms > now}
        known = len(kept)
        for part in rows:
            fresh = []
            for i in part[self.key].astype(str):
                fresh.append(i not in kept)
                kept.setdefault(i, now)
            yield part[fresh].drop(columns=["__bucket", "__slot"], errors="ignore")
        if len(kept) > known:
            self.seen.update((list(kept), list(kept.values())))

    def close(self) -> None:
        pass


#: Values that hold the ids of a bucket.
SLOTS = 1024


def without_repeats(stream: DataFrame, key: str = "sample_id", lifetime: str = "48 hours", buckets: int = 64) -> DataFrame:
    """One row of each ``key`` within a ``lifetime`` in processing time, whatever the event times are.

    Ids are kept in ``buckets`` times ``SLOTS`` groups by hash, so no group is hot, and expire by themselves. Rows without
    the key are one id. Needs the RocksDB state store. Such state asks for one more batch without end, so an availableNow
    trigger does not come to its end with it: take an interval or a single batch.
    """
    hashed = F.xxhash64(key)
    own = {"__bucket": F.pmod(hashed, F.lit(buckets)).cast("int"), "__slot": F.pmod(F.xxhash64(hashed), F.lit(SLOTS)).cast("int")}
    lifetime_ms = int(pd.Timedelta(lifetime).total_seconds() * 1000)
    return stream.withColumns(own).groupBy("__bucket", "__slot").transformWithStateInPandas(Repeats(key, lifetime_ms), stream.schema, "append", "ProcessingTime")


def rocksdb(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
