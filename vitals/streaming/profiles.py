"""Streams joined with users' profiles as of each measurement, by keyed state."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: Groups of users by hash that share a state; raise it with the users.
BUCKETS = 64
#: Stands for a missing user in state.
NOBODY = -(2**63)
OUTPUT = "user_id long, sample_id long, at_ms long, user_timezone string"


class ZoneAsOf(StatefulProcessor):
    """The zones of a bucket of users by the time they were set, and rows that wait until the watermark has passed them.

    So a profile that comes after the measurements it holds for, or out of order, still counts as long as the watermark
    allows; a measurement that is later than the watermark takes what is known then. Both lie in chunks of many rows, and
    one timer, at the next time that is due, stands for all that wait: calls grow with batches, not with rows.
    """

    ROWS, ZONES = ["user_id", "sample_id", "at_ms"], ["user_id", "at_ms", "zone"]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.zones = handle.getListState("zones", "users array<long>, times array<long>, zones array<string>")
        self.waiting = handle.getListState("waiting", "users array<long>, ids array<long>, times array<long>")

    def _add(self, state, rows: pd.DataFrame) -> None:
        if len(rows):
            state.appendValue(tuple(rows[c].tolist() for c in rows.columns))

    def _all(self, state, columns: list[str]) -> pd.DataFrame:
        chunks = list(state.get()) if state.exists() else []
        return pd.DataFrame({c: [x for chunk in chunks for x in chunk[i]] for i, c in enumerate(columns)}).astype({c: "object" if c == "zone" else "int64" for c in columns})

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        self._add(self.zones, initialState[self.ZONES])

    def _found(self, rows: pd.DataFrame) -> pd.DataFrame:
        known = self._all(self.zones, self.ZONES).drop_duplicates(["user_id", "at_ms"], keep="last").rename(columns={"zone": "user_timezone"})
        out = pd.merge_asof(rows.sort_values("at_ms", kind="stable"), known.sort_values("at_ms", kind="stable"), on="at_ms", by="user_id")
        return out[["user_id", "sample_id", "at_ms", "user_timezone"]]

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        now, late, due = timerValues.getCurrentWatermarkInMs(), [], None
        for part in rows:
            self._add(self.zones, part.loc[part["mark"], self.ZONES])
            found = part.loc[~part["mark"], self.ROWS]
            late.append(found[found["at_ms"] < now])
            found = found[found["at_ms"] >= now]
            self._add(self.waiting, found)
            if len(found):
                due = int(found["at_ms"].min()) + 1 if due is None else min(due, int(found["at_ms"].min()) + 1)
        if due is not None:
            timers = [int(t) for t in self.handle.listTimers()]
            if not timers or due < min(timers):
                for t in timers:
                    self.handle.deleteTimer(t)
                self.handle.registerTimer(due)
        late = pd.concat(late) if late else pd.DataFrame()
        yield self._found(late) if len(late) else pd.DataFrame()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now, rows = timerValues.getCurrentWatermarkInMs(), self._all(self.waiting, self.ROWS)
        over = rows["at_ms"] < now
        self.waiting.clear()
        rest = rows[~over]
        self._add(self.waiting, rest)
        if len(rest):
            self.handle.registerTimer(int(rest["at_ms"].min()) + 1)
        if over.any():
            yield self._found(rows[over])

    def close(self) -> None:
        pass


def zone_as_of_stream(samples: DataFrame, profiles: DataFrame, known: DataFrame | None = None, delay: str = "10 minutes", buckets: int = BUCKETS) -> DataFrame:
    """Each row of the stream ``samples`` (user_id, sample_id, start_ts) with its user's last zone set no later: ``OUTPUT``.

    ``profiles`` (user_id, timezone, updated_at) is a stream, ``known`` a table of those set before it starts. Of zones set
    at one time the last that came counts; without any the zone is null. One watermark goes over both streams. A user's rows
    wait in state for at most ``delay`` of event time. Rows without a user get no zone. Needs the RocksDB state store.
    """
    ms = lambda c: F.unix_millis(c).alias("at_ms")
    bucket = F.pmod(F.xxhash64("user_id"), F.lit(buckets)).cast("int").alias("bucket")
    user = F.coalesce("user_id", F.lit(NOBODY)).alias("user_id")
    rows = samples.select(user, "start_ts", ms("start_ts"), "sample_id", F.lit(None).cast("string").alias("zone"), F.lit(False).alias("mark"))
    marks = profiles.where("user_id is not null").select("user_id", F.col("updated_at").alias("start_ts"), ms("updated_at"), F.lit(0).cast("long").alias("sample_id"), F.col("timezone").alias("zone"), F.lit(True).alias("mark"))
    both = rows.unionByName(marks).withWatermark("start_ts", delay).select(bucket, "user_id", "at_ms", "sample_id", "zone", "mark")  # without the event time no row is dropped as late
    first = None if known is None else known.where("user_id is not null").select(bucket, "user_id", ms("updated_at"), F.col("timezone").alias("zone")).groupBy("bucket")
    out = both.groupBy("bucket").transformWithStateInPandas(ZoneAsOf(), OUTPUT, "append", "EventTime", first)
    return out.withColumn("user_id", F.nullif("user_id", F.lit(NOBODY)))
