"""What several operators share: tables in the cluster's shared folder, word patterns, integer names and graph components."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: ASCII white space and words, as the query contracts state them.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where that is unset, a temporary one in local mode; on a cluster an error."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir has to name a folder that driver and executors share")
        path = tempfile.mkdtemp(prefix="spark-llm-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


#: Folders written inside each open ``scratch``, the innermost last. A thread has its own, so jobs of two threads keep apart.
_scratches: ContextVar[tuple[list[str], ...]] = ContextVar("scratches", default=())


def written(df: DataFrame, tag: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder. It cuts the lineage and survives lost executors."""
    path = f"{shared_dir(df.sparkSession)}/llm-{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    for paths in _scratches.get()[-1:]:
        paths.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Deletes at its end what ``written`` wrote inside. What is returned from inside has to be written elsewhere before."""
    before, paths = _scratches.get(), []
    _scratches.set((*before, paths))
    try:
        yield
    finally:
        _scratches.set(before)
        for path in paths:
            hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
            hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


def outside(df: DataFrame, tag: str) -> DataFrame:
    """As ``written``, but kept when the ``scratch`` around it ends."""
    out = written(df, tag)
    within = _scratches.get()
    if within:
        (within[-2] if len(within) > 1 else []).append(within[-1].pop())
    return out


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, UPPER.lower())


#: Edges of a node that are joined in one task.
HUB = 100_000
#: A key is hot with more than this share of all rows, so no more than 1 / HOT keys are.
HOT = 1e-4


def with_hot_keys(rows: DataFrame, table: DataFrame, keys: list[str], n: str, total: int) -> DataFrame:
    """``rows`` joined with ``table``, which has a row for each of ``keys`` and in ``n`` how many rows have them.

    Rows of hot keys meet a broadcast table of at most 1 / HOT rows, so that no task gets all rows of one; the others are
    shuffled. ``table`` should be written.
    """
    hot, rest = table.where(F.col(n) > HOT * total), table.where(F.col(n) <= HOT * total)
    few = F.broadcast(hot)
    return rows.join(few, keys).unionByName(rows.join(few, keys, "left_anti").join(rest, keys))


def hot_deals(pairs: DataFrame, key: str, total: int, most: int) -> DataFrame:
    """(key, __deals), to be broadcast: into how many tasks the pairs of each ``key`` with many of ``total`` are dealt.

    Many is more than ``most`` and HOT of all, so there are at most 1 / HOT rows.
    """
    many = max(most, HOT * total)
    hot = pairs.groupBy(key).agg(F.count("*").alias("__m")).where(F.col("__m") > many)
    return F.broadcast(hot.select(key, F.ceil(F.col("__m") / many).cast("int").alias("__deals")))


def dealt(pairs: DataFrame, hot: DataFrame, key: str, other: str) -> DataFrame:
    """``pairs`` with ``__deal``: which of the tasks of ``hot_deals`` a pair goes to, by ``other``; 0 for keys that aren't hot."""
    return pairs.join(hot, key, "left").withColumn("__deal", F.coalesce(F.pmod(F.xxhash64(other), F.col("__deals")).cast("int"), F.lit(0))).drop("__deals")


def met(pairs: DataFrame, side: DataFrame, key: str, other: str, total: int, most: int, counted: DataFrame | None = None) -> DataFrame:
    """``pairs`` joined with ``side``, which has a row for each ``key``; a key with many of the ``total`` pairs is dealt to several tasks by ``other``.

    ``counted``: what pairs are counted by, where that is cheaper; it should be written.
    """
    hot = hot_deals(pairs if counted is None else counted, key, total, most)
    right = side.join(hot, key, "left").withColumn("__deal", F.explode(F.sequence(F.lit(0), F.coalesce("__deals", F.lit(1)) - 1))).drop("__deals")
    return dealt(pairs, hot, key, other).join(right, [key, "__deal"]).drop("__deal")


def integer_names(df: DataFrame, columns: list[str], tag: str) -> DataFrame:
    """Each distinct tuple of the integer ``columns`` with ``name``, a dense integer from 0, and ``n_rows``, its number of rows.

    Tuples go to hash buckets, are sorted inside, and a name is the bucket's offset plus the rank: a function of the set
    of tuples and the number of buckets alone. Tuples are distinct before they are dealt, so no bucket is hot.
    """
    buckets = 4 * shuffle_partitions(df.sparkSession)
    tuples = df.groupBy(*columns).agg(F.count("*").alias("n_rows")).withColumn("__bucket", F.pmod(F.xxhash64(*columns), F.lit(buckets)))
    ranks = written(tuples.withColumn("__rank", F.row_number().over(Window.partitionBy("__bucket").orderBy(*columns))), tag)
    ahead = Window.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = ranks.groupBy("__bucket").agg(F.max("__rank").alias("__size"))  # a row for each bucket, whatever the input
    offsets = sizes.select("__bucket", F.coalesce(F.sum("__size").over(ahead), F.lit(0)).alias("__offset"))
    return ranks.join(F.broadcast(offsets), "__bucket").select(*columns, (F.col("__offset") + F.col("__rank") - 1).cast("long").alias("name"), "n_rows")


def components(edges: DataFrame, tag: str) -> DataFrame:
    """(node, component): the smallest node that is reachable over ``edges`` (a, b: long), for each node with an edge.

    Large-star and small-star steps alternate until the edges no longer change; each step is a grouped minimum and a join,
    and its edges are written to the shared folder. No neighbour list is ever gathered, and the edges of a node with very
    many are dealt to several tasks (``met``).
    """
    least_of = lambda edges: edges.groupBy("a").agg(F.min("b").alias("m"))
    joined = lambda edges, n: met(edges, least_of(edges), "a", "b", n, HUB)
    tree, before = written(edges.where("a != b").select("a", "b").distinct(), tag), None
    while True:
        both = tree.unionByName(tree.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
        edges = 2 * tree.count()
        large = joined(both, edges).withColumn("m", F.least("m", "a")).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct()
        down = written(large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")), tag)
        small = joined(down, edges).select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))).alias("e")).select("e.*")
        tree = written(small.where("a != b").distinct(), tag)
        now = tree.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    return tree.groupBy("a").agg(F.min("b").alias("component")).withColumnRenamed("a", "node").unionByName(tree.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
