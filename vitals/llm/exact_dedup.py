"""Exact dedup by deterministic block naming.

A text, with its white space runs made one space, is cut into blocks of a fixed number of characters. Equal blocks get
equal integer names: blocks are dealt by a 64-bit hash and, where several texts share a hash, sorted inside it; hash and
rank become one dense integer. Then adjacent names are paired and the pairs named anew, level by level, until one name is
left for each document. Names are never shared by different contents, so documents of one level and name are equal.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE, free_name, integer_names, with_hot_keys, written

BLOCK = 2048
KEY = ["doc_id", "sha"]


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " ")


def _blocks(docs: DataFrame, block: int) -> DataFrame:
    cut = F.regexp_extract_all("norm", F.lit(f"(?s)(.{{1,{block}}})"), F.lit(1))
    rows = docs.select("doc_id", normalised(F.col("text")).alias("norm")).select("doc_id", F.unhex(F.sha2("norm", 256)).alias("sha"), cut.alias("cut"))
    rows = rows.select(*KEY, F.greatest(F.size("cut"), F.lit(1)).alias("n"), F.posexplode_outer("cut").alias("pos", "block"))
    return rows.select(*KEY, "n", F.coalesce("pos", F.lit(0)).alias("pos"), F.coalesce("block", F.lit("")).alias("block")).withColumn("hash", F.xxhash64("block"))


def identities(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """(doc_id, sha, copies, level, name): one row for each doc_id and text, with the number of such rows; equal texts have equal level and name.

    Texts cross the network once, to find blocks that share a hash without being equal (``collided``, empty but for one
    pair in about 2^64); all else moves integers only. Null text counts as empty; null doc_ids are kept as a value.
    """
    blocks = _blocks(docs, block)
    distinct = blocks.select("hash", "block").distinct()
    shared = written(distinct.groupBy("hash").count().where("count > 1").select("hash"), "shared-hash")
    if shared.isEmpty():
        ranked = blocks.withColumn("rank", F.lit(0))
    else:
        collided = distinct.join(shared, "hash").withColumn("rank", F.row_number().over(Window.partitionBy("hash").orderBy("block")) - 1)
        ranked = blocks.join(written(collided, "ranked-hash"), ["hash", "block"], "left").withColumn("rank", F.coalesce("rank", F.lit(0)))
    first = written(ranked.groupBy(*KEY, "n", "pos", "hash", "rank").agg(F.count("*").alias("copies")), "blocks")
    copies = first.where("pos = 0").select(*KEY, "copies")
    names = integer_names(first, ["hash", "rank"], "names-0")
    total, most = first.agg(F.count("*"), F.coalesce(F.max("n"), F.lit(0))).first()
    depth = 0
    level = with_hot_keys(first, names, ["hash", "rank"], "n_rows", total).select(*KEY, "n", "pos", "name")
    found = level.where("n = 1").select(*KEY, F.lit(0).alias("level"), "name")
    while most > 1:
        depth, most = depth + 1, (most + 1) // 2
        half = lambda odd: F.max(F.when(F.col("pos") % 2 == odd, F.col("name")))
        pairs = level.where("n > 1").groupBy(*KEY, "n", F.floor(F.col("pos") / 2).cast("int").alias("p")).agg(half(0).alias("l"), F.coalesce(half(1), F.lit(-1)).alias("r"))
        pairs = written(pairs.select(*KEY, F.floor((F.col("n") + 1) / 2).cast("int").alias("n"), F.col("p").alias("pos"), "l", "r"), f"pairs-{depth}")
        named = with_hot_keys(pairs, integer_names(pairs, ["l", "r"], f"names-{depth}"), ["l", "r"], "n_rows", pairs.count())
        level = written(named.select(*KEY, "n", "pos", "name"), f"level-{depth}")
        found = found.unionByName(level.where("n = 1").select(*KEY, F.lit(depth).alias("level"), "name"))
    one = [F.col(f"c.{k}").eqNullSafe(F.col(f"f.{k}")) for k in KEY]
    return written(found.alias("f").join(copies.alias("c"), one[0] & one[1]).select("f.*", "copies"), "identities")


def exact_dedup(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256: one row for each row of ``docs``.

    ``keep_id``: the smallest doc_id among equal texts (null only if all are null); of repeated rows with that doc_id one
    is kept. Empty and null texts are equal. An empty table gives no rows. Other columns of ``docs`` are not read.
    """
    rows = identities(docs, block)
    groups = rows.groupBy("level", "name").agg(F.min("doc_id").alias("keep_id"), F.sum("copies").alias("group_size"), F.count("*").alias("n_rows"))
    rows = with_hot_keys(rows, written(groups, "groups"), ["level", "name"], "n_rows", rows.count()).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)
    return rows.select("doc_id", "keep_id", "group_size", kept.alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"))


def keep_first(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """The rows of ``docs`` that ``exact_dedup`` keeps, with all their columns."""
    # one string key, so that the join and the window share one exchange of the texts
    name, nth = free_name(docs, "__key"), free_name(docs, "__nth")
    key = lambda sha: F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), sha)
    kept = exact_dedup(docs, block).where("kept").select(key(F.col("text_sha256")).alias(name))
    rows = docs.withColumn(name, key(F.sha2(normalised(F.col("text")), 256))).join(kept, name, "left_semi")
    order = Window.partitionBy(name).orderBy("text")
    return rows.withColumn(nth, F.row_number().over(order)).where(F.col(nth) == 1).select(*docs.columns)
