"""Pipeline metrics as aggregates."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def rejection(df: DataFrame, *keys: str) -> DataFrame:
    """processed, rejected and the rate of ``df`` (reject_reason)."""
    bad = F.count("reject_reason")
    return df.groupBy(*keys).agg(F.count("*").alias("processed"), bad.alias("rejected"), F.try_divide(bad, F.count("*")).alias("rejection_rate"))


def failures(df: DataFrame) -> DataFrame:
    return df.where("reject_reason is not null").groupBy("reject_reason", "data_type").agg(F.count("*").alias("failures"))


def throughput(df: DataFrame, ts: str = "start_ts", width: str = "5 minutes", *keys: str) -> DataFrame:
    return df.groupBy(F.window(ts, width).start.alias("window_start"), *keys).agg(F.count("*").alias("records"))


def latency(df: DataFrame, column: str, *keys: str) -> DataFrame:
    """Distribution of latencies from 0, with exact percentiles by nearest rank."""
    rows = df.where(F.col(column) >= 0)
    stats = rows.groupBy(*keys).agg(F.count("*").alias("n"), F.min(column).alias("least"), F.avg(column).alias("mean"), F.max(column).alias("most"))
    return with_percentiles(stats, rows, column, list(keys), {"p50": 0.5, "p95": 0.95, "p99": 0.99})


def with_percentiles(stats: DataFrame, rows: DataFrame, column: str, keys: list[str], shares: dict[str, float]) -> DataFrame:
    """``stats`` (a row for each of ``keys``) with the exact percentiles of ``rows`` by nearest rank; null where a key has no values."""
    cuts = exact_percentiles(rows, column, keys, shares, nearest=True)
    if not keys:
        return stats.crossJoin(cuts)
    same = [F.col(f"s.{k}").eqNullSafe(F.col(f"c.{k}")) for k in keys]
    return stats.alias("s").join(cuts.alias("c"), same, "left").select("s.*", *shares)


#: Values of a range of ``exact_percentiles``, about; up to so many in all are sorted by key at once.
RANGE = 500_000


def exact_percentiles(df: DataFrame, column: str, keys: list[str], shares: dict[str, float], parts: int | None = None, nearest: bool = False) -> DataFrame:
    """Values at index min(floor(n q), n - 1) of each key's sorted values, or with ``nearest`` at the nearest rank, ceil(n q) from 1.

    Equal values are counted first. A key's distinct values are cut into about ``parts`` ranges at approximate quantiles,
    which are merged from sketches; sums by range tell which ranges hold the wanted ranks, and only those are sorted. So
    a key with many values is the work of many tasks. By default the number of ranges follows the number of values, which
    are counted; where all fit in one range, each key's are sorted without cutting.
    """
    names = [*keys, column]
    if nearest:  # in decimals: a share such as 0.95 is no sum of powers of two
        at = lambda q: F.greatest(F.lit(1), F.ceil(F.col("__all").cast("decimal(20,0)") * F.lit(Decimal(str(q)))))
    else:
        at = lambda q: F.least(F.floor(F.col("__all") * q), F.col("__all") - 1) + 1
    values = df.where(F.col(column).isNotNull()).groupBy(*names).agg(F.count("*").alias("__n"))
    if parts is None:
        parts = min(4096, -(-df.where(F.col(column).isNotNull()).count() // RANGE))
    if parts <= 1:
        w = Window.partitionBy(*keys)
        rows = values.withColumns({"__upto": F.sum("__n").over(w.orderBy(column)), "__all": F.sum("__n").over(w)})
        return rows.groupBy(*keys).agg(*[F.min(F.when(F.col("__upto") >= at(q), F.col(column))).alias(name) for name, q in shares.items()])
    cuts = values.groupBy(*keys).agg(F.percentile_approx(column, [i / parts for i in range(1, parts)], 20 * parts).alias("__cuts"))
    same = lambda a, b: [F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}")) for k in keys]
    ranged = values.alias("v").join(cuts.alias("c"), same("v", "c")).select(*[f"v.{c}" for c in names], "__n", F.size(F.filter("__cuts", lambda x: x < F.col(column))).alias("__range"))
    sums = ranged.groupBy(*keys, "__range").agg(F.sum("__n").alias("__size"))
    w = Window.partitionBy(*keys)
    sums = sums.withColumns({"__before": F.sum("__size").over(w.orderBy("__range")) - F.col("__size"), "__all": F.sum("__size").over(w)})
    holds = F.lit(False)
    for q in shares.values():
        holds = holds | ((F.col("__before") < at(q)) & (at(q) <= F.col("__before") + F.col("__size")))
    held = sums.where(holds)
    rows = ranged.alias("r").join(held.alias("h"), [*same("r", "h"), F.col("r.__range") == F.col("h.__range")]).select(*[f"r.{c}" for c in names], "r.__range", "__n", "__before", "__size", "__all")
    upto = F.col("__before") + F.sum("__n").over(Window.partitionBy(*keys, "__range").orderBy(column))
    rows = rows.withColumn("__upto", upto)
    pick = lambda q: F.min(F.when((F.col("__before") < at(q)) & (at(q) <= F.col("__before") + F.col("__size")) & (F.col("__upto") >= at(q)), F.col(column)))
    return rows.groupBy(*keys).agg(*[pick(q).alias(name) for name, q in shares.items()])


def window_summary(aggregates: DataFrame, latency_column: str = "latency_ms") -> DataFrame:
    """Windows, records and latencies by window type and in all (null type)."""
    rows = aggregates.rollup("window_type").agg(
        F.count("*").alias("windows"), F.sum("record_count").alias("records"), F.avg("record_count").alias("avg_records"),
        F.min(latency_column).alias("min_latency"), F.avg(latency_column).alias("avg_latency"), F.max(latency_column).alias("max_latency"),
    )
    twice = aggregates.select("window_type", latency_column).unionByName(aggregates.select(F.lit(None).cast("string").alias("window_type"), latency_column))
    cuts = exact_percentiles(twice, latency_column, ["window_type"], {"p50": 0.5, "p95": 0.95, "p99": 0.99})
    return rows.join(cuts.withColumnRenamed("window_type", "__type"), rows["window_type"].eqNullSafe(F.col("__type")), "left").drop("__type")


def late_events(df: DataFrame, arrival: Column, ts: str, delay_seconds: int, source: str, span: Column | None = None) -> DataFrame:
    """``df`` with ``watermark`` (of the events that arrived before from the same ``source``), ``late`` and ``lateness`` in seconds.

    ``span`` cuts a source's arrivals into ranges, the hour of arrival say, and must not fall as ``arrival`` grows. The
    largest time of all ranges before is carried from one row a range, so events are sorted within a range alone.
    """
    rows = df.withColumn("__span", F.lit(0) if span is None else span)
    ahead = Window.partitionBy(source).orderBy("__span").rowsBetween(Window.unboundedPreceding, -1)
    spans = rows.groupBy(source, "__span").agg(F.max(F.unix_seconds(ts)).alias("__max"))
    spans = spans.withColumn("__before", F.max("__max").over(ahead)).drop("__max")
    same = F.col(f"e.{source}").eqNullSafe(F.col(f"s.{source}")) & F.col("e.__span").eqNullSafe(F.col("s.__span"))
    rows = rows.alias("e").join(spans.alias("s"), same).select("e.*", "__before")
    inside = Window.partitionBy(source, "__span").orderBy(arrival).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("watermark", F.greatest(F.col("__before"), F.max(F.unix_seconds(ts)).over(inside)) - delay_seconds).drop("__span", "__before")
    return rows.withColumns({"late": F.coalesce(F.unix_seconds(ts) < F.col("watermark"), F.lit(False)), "lateness": F.greatest(F.lit(0), F.coalesce(F.col("watermark") - F.unix_seconds(ts), F.lit(0)))})


def late_summary(rows: DataFrame, *keys: str) -> DataFrame:
    late = F.count_if("late")
    return rows.groupBy(*keys).agg(F.count("*").alias("events"), late.alias("late_events"), (F.try_divide(late, F.count("*")) * 100).alias("late_percent"), F.max("lateness").alias("max_lateness"))


def window_bookkeeping(rows: DataFrame, width_seconds: int, lateness_seconds: int) -> DataFrame:
    """For each window of ``late_events`` rows: events in time, late updates within the allowed lateness, dropped ones."""
    start = F.floor(F.unix_seconds("start_ts") / width_seconds) * width_seconds
    closed = F.coalesce(F.col("watermark") >= start + width_seconds, F.lit(False))
    gone = F.coalesce(F.col("watermark") >= start + width_seconds + lateness_seconds, F.lit(False))
    return rows.groupBy(start.cast("long").alias("window_start")).agg(F.count_if(~closed).alias("on_time"), F.count_if(closed & ~gone).alias("late_updates"), F.count_if(gone).alias("dropped"))


def sink_statistics(batches: DataFrame) -> DataFrame:
    """Totals of a job's metric rows (batch, records, errors, upserts)."""
    return batches.agg(F.count("*").alias("batches"), F.sum("records").alias("records"), F.sum("errors").alias("errors"), F.sum("upserts").alias("upserts"))


def rates(df: DataFrame, ts: str = "start_ts", width: str = "5 minutes", seconds: int = 300) -> DataFrame:
    """By window of ``df`` (reject_reason, late): records a second, errors in percent of the valid, windows' records, late share in percent."""
    n, bad = F.count("*"), F.count("reject_reason")
    return df.groupBy(F.window(ts, width).start.alias("window_start")).agg(
        (n / seconds).alias("per_second"), F.try_divide(bad * 100, n - bad).alias("error_percent"), n.alias("records_per_window"), (F.count_if("late") * 100 / n).alias("late_percent"),
    )


def windows_per_minute(windows: DataFrame, at: str) -> DataFrame:
    """How many of ``windows`` were emitted in each minute, by the time ``at``; minutes without any have no row."""
    return windows.groupBy(F.date_trunc("minute", F.col(at)).alias("minute")).agg(F.count("*").alias("windows"))


#: Size of quantile sketches, and the rank error that one of that size keeps to, whatever it is merged from.
SKETCH_K, SKETCH_ERROR = 800, 0.005


def latency_sketches(df: DataFrame, column: str, *keys: Column | str, k: int = SKETCH_K) -> DataFrame:
    """n, least, most and a quantile sketch of a few kilobytes for each of ``keys``: what is stored with a window. Null, NaN and negative values don't count."""
    value = F.col(column).cast("double")
    rows = df.where((value >= 0) & ~F.isnan(value))
    return rows.groupBy(*keys).agg(F.count("*").alias("n"), F.min(value).alias("least"), F.max(value).alias("most"), F.kll_sketch_agg_double(value, k).alias("sketch"))


def merged_sketches(sketches: DataFrame, *keys: Column | str) -> DataFrame:
    """The same for coarser keys, from the stored sketches alone; without keys one row."""
    return sketches.groupBy(*keys).agg(F.sum("n").alias("n"), F.min("least").alias("least"), F.max("most").alias("most"), F.kll_merge_agg_double("sketch").alias("sketch"))


def sketch_quantiles(sketches: DataFrame, shares: dict[str, float]) -> DataFrame:
    """``sketches`` with a column for each of ``shares``, in place of the sketch."""
    return sketches.withColumns({name: F.kll_sketch_get_quantile_double("sketch", F.lit(float(q))) for name, q in shares.items()}).drop("sketch")


def user_sketches(df: DataFrame, user: str, *keys: Column | str) -> DataFrame:
    """A sketch of the distinct users of each of ``keys``: exact up to some thousands, then within a few percent."""
    return df.groupBy(*keys).agg(F.theta_sketch_agg(F.col(user)).alias("users"))


def united_users(sketches: DataFrame, *keys: Column | str) -> DataFrame:
    """The users of coarser keys, counted once, from the stored sketches alone."""
    return sketches.groupBy(*keys).agg(F.theta_union_agg("users").alias("users"))


def user_count(sketch: str = "users") -> Column:
    return F.theta_sketch_estimate(sketch)


def kept_users(sketches: DataFrame, at: str, after: Column, *keys: str) -> DataFrame:
    """For each of ``keys`` and ``at``: users, those of ``after`` (the next ``at``), and how many are in both."""
    later = sketches.select(*keys, F.col(at).alias("__at"), F.col("users").alias("__users"))
    same = [F.col(f"s.{k}") == F.col(f"l.{k}") for k in keys]
    rows = sketches.withColumn("__next", after).alias("s").join(later.alias("l"), [*same, F.col("__next") == F.col("__at")])
    both = F.theta_sketch_estimate(F.theta_intersection(F.col("s.users"), F.col("__users")))
    return rows.select(*[f"s.{k}" for k in keys], at, user_count("s.users").alias("users"), F.theta_sketch_estimate("__users").alias("next_users"), both.alias("kept"))


def user_bitmaps(df: DataFrame, user: str, *keys: Column | str) -> DataFrame:
    """The exact set of the distinct users (whole numbers) of each of ``keys``: bitmaps (bucket, users) of 32,768 neighbouring numbers, of 4 kilobytes each. Null users don't count."""
    rows = df.where(F.col(user).isNotNull())
    return rows.groupBy(*keys, F.bitmap_bucket_number(F.col(user)).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(F.col(user))).alias("users"))


def united_bitmaps(bitmaps: DataFrame, *keys: Column | str) -> DataFrame:
    """The users of coarser keys, from the stored bitmaps alone."""
    return bitmaps.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("users").alias("users"))


def counted_bitmaps(bitmaps: DataFrame, *keys: Column | str) -> DataFrame:
    """``users``: how many users each of ``keys`` has, from bitmaps of the same keys."""
    return bitmaps.groupBy(*keys).agg(F.sum(F.bitmap_count("users")).alias("users"))


def kept_in_bitmaps(bitmaps: DataFrame, at: str, after: Column, *keys: str) -> DataFrame:
    """``kept_users`` from bitmaps, exactly."""
    sizes = counted_bitmaps(bitmaps, *keys, at)
    later = lambda df: df.withColumnsRenamed({at: "__at", "users": "__users"})
    paired = lambda df, *more: df.withColumn("__at", after).join(later(df), [*keys, "__at", *more])
    shared = paired(bitmaps, "bucket").select(*keys, at, "bucket", F.explode(F.array("users", "__users")).alias("users"))
    shared = shared.groupBy(*keys, at, "bucket").agg(F.bitmap_and_agg("users").alias("users"))
    kept = counted_bitmaps(shared, *keys, at).withColumnRenamed("users", "kept")
    rows = paired(sizes).select(*keys, at, "users", F.col("__users").alias("next_users"))
    return rows.join(kept, [*keys, at], "left").withColumn("kept", F.coalesce("kept", F.lit(0)))
