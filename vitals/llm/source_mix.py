"""Mixing sources to target weights with DataFrame operations only.

Each source's budget comes from its weight, filled like communicating vessels up to a cap. Documents get hash-random keys
whose leading digits name ranges of keys; sums by range give each range its offset, so a prefix sum over a source never
needs one task for the source. Whole epochs are taken first; in the last one, documents are taken in key order up to the
exact budget.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, free_name, written

#: Rows of a range of keys, about; the number of ranges a source is a power of 16 that follows the number of rows.
RANGE_ROWS = 4096


def targets(sizes: DataFrame, weights: tuple[int, ...], share: float, cap: float) -> DataFrame:
    """(source, source_size, target) of ``sizes`` (source, size); a row for each source, null being one.

    With level L, a source gets min(cap x size, L x weight). The levels that result from capping the k sources of the
    smallest cap for their weight rise up to the true one and fall after it, so L is their maximum. All sums are of
    integers. The two windows below hold one row for each source.
    """
    rows = sizes.groupBy("source").agg(F.coalesce(F.sum("size"), F.lit(0)).cast("long").alias("source_size"))
    nth = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.pmod(F.row_number().over(nth) - 1, F.lit(len(weights))) + 1).cast("int"))
    rows = rows.withColumn("w", weight).withColumn("full", F.col("source_size") * F.lit(cap))
    everything = Window.partitionBy(F.lit(0))
    before = Window.partitionBy(F.lit(0)).orderBy(F.col("full") / F.col("w"), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    earlier = lambda c: F.coalesce(F.sum(c).over(before), F.lit(0))
    level = (F.sum("source_size").over(everything) * F.lit(share) - earlier("full")) / (F.sum("w").over(everything) - earlier("w"))
    rows = rows.withColumn("level", level).withColumn("level", F.max("level").over(everything))
    return rows.select("source", "source_size", F.least("full", F.col("level") * F.col("w")).cast("double").alias("target"))


def mix(docs: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, cap: float = 2.0, range_rows: int = RANGE_ROWS) -> DataFrame:
    """doc_id, text_hash, size, source, source_size, target, taken, copies: one row for each row of ``docs`` (doc_id, text, source).

    ``taken``: words that the mix takes of the document, repeats counted; ``copies``: how often it occurs in the mix, a
    partly taken document counting in full, and a document without words as its neighbours in key order. A null text has
    size 0, a null source is a source, a null doc_id a key. Repeated rows are taken in turn. The key is md5 of the
    doc_id, so reruns agree. An empty table gives no rows.
    """
    key = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    rows = docs.select("doc_id", "source", F.xxhash64("text").alias("text_hash"), F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"), key.alias("key"))
    rows = written(rows, "sized")
    n = rows.count()
    digits = next((d for d in range(1, 16) if 16**d * range_rows >= n), 16)
    rows = rows.withColumn("range", F.substring("key", 1, digits))
    goals = written(targets(rows, weights, share, cap), "targets")
    same = lambda x, y: F.col(f"{x}.source").eqNullSafe(F.col(f"{y}.source"))

    ranges = rows.groupBy("source", "range").agg(F.sum("size").alias("range_size"))
    ahead = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.withColumn("offset", F.coalesce(F.sum("range_size").over(ahead), F.lit(0)))
    ranges = ranges.alias("r").join(goals.alias("g"), same("r", "g")).select("r.source", "range", "offset", "source_size", "target")

    inside = Window.partitionBy("d.source", "d.range").orderBy("key", "doc_id", "size", "text_hash").rowsBetween(Window.unboundedPreceding, -1)
    joined = rows.alias("d").join(ranges.alias("r"), same("d", "r") & (F.col("d.range") == F.col("r.range")))
    joined = joined.select("doc_id", "text_hash", "d.source", "size", "source_size", "target", (F.col("offset") + F.coalesce(F.sum("size").over(inside), F.lit(0))).alias("prefix"))
    budget = F.floor("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0).cast("long")
    rest = F.greatest(F.lit(0), F.least(F.col("size"), F.col("budget") - F.col("epochs") * F.col("source_size") - F.col("prefix")))
    in_last = (F.col("budget") - F.col("epochs") * F.col("source_size") > F.col("prefix")).cast("long")
    joined = joined.withColumn("budget", budget).withColumn("epochs", epochs)
    return joined.select("doc_id", "text_hash", "size", "source", "source_size", "target", (F.col("epochs") * F.col("size") + rest).alias("taken"), (F.col("epochs") + in_last).alias("copies"))


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` as often as ``mix`` takes them (``copies``), with all their columns.

    Rows that share doc_id, source and text are as often there in all as ``mix`` takes them together, none more than once
    more often than another.
    """
    name, nth, n_rows, copies = (free_name(docs, x) for x in ("__key", "__nth", "__rows", "__copies"))
    key = lambda text_hash: F.to_json(F.struct("doc_id", "source", text_hash.alias("text_hash")))  # noqa: E731  one key for the join and the window
    taken = mix(docs, **options).groupBy(key(F.col("text_hash")).alias(name)).agg(F.sum("copies").alias(copies), F.count("*").alias(n_rows))
    rows = docs.withColumn(name, key(F.xxhash64("text"))).join(taken.where(F.col(copies) > 0), name)
    rows = rows.withColumn(nth, F.row_number().over(Window.partitionBy(name).orderBy("text")))
    times = F.floor(F.col(copies) / F.col(n_rows)) + (F.col(nth) <= F.col(copies) % F.col(n_rows)).cast("long")
    return rows.where(times > 0).withColumn(nth, F.explode(F.sequence(F.lit(1), times.cast("int")))).select(*docs.columns)
