"""Approximate nearest neighbours with balanced posting lists.

Centroids are fitted on a bounded sample with a penalty on full lists. They are searched through an in-memory graph of
their neighbours. A vector near a border goes to every list whose centroid is almost as near as its nearest; a query visits
the lists whose centroids are within a wider ratio of its nearest one's distance, however many they are. That ratio is
measured: it is the least one at which a bounded sample of vectors finds the wanted share of its exact neighbours among all
rows. A query visits more where its lists hold too few vectors. Long lists are cut into blocks, and so are the queries of a list, so a task holds a
bounded number of either. Distances are exact, on the original vectors.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .bytewords import tidy
from .common import written

#: Vectors that centroids are fitted on, at most: those of the smallest hash of their id.
SAMPLE = 32_768
#: Vectors of a list, on average, and lists at most, so that graph and centroids stay small in each task; beyond that lists grow.
LIST, LISTS = 250, 8192
#: A vector's lists: centroids within this ratio of its nearest one's distance, at most so many.
COPY_RATIO, COPIES = 1.04, 3
#: The share of exact neighbours that a query's ratio is fitted to find, the vectors that it is fitted on, and lists that are always visited.
RECALL, FITTED, LEAST = 0.96, 128, 4
#: Rows of a block of a list, and of its queries.
BLOCK = 4096
#: Neighbours of a centroid in the graph, and centroids that a walk holds beyond those that are asked for.
DEGREE, BEAM = 24, 24


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1).astype(np.float64)


def usable(vectors: DataFrame, length: int | None = None) -> DataFrame:
    """(vec_id, embedding as doubles): without null ids, and vectors that are null, empty, zero or hold null or non-finite components.

    Of several rows with one vec_id the smallest vector stays. Of vectors of several lengths those of ``length`` stay, by
    default of the commonest one, as there is no distance between others.
    """
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    rows = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding")).where(F.col("vec_id").isNotNull() & F.forall("embedding", finite) & F.exists("embedding", lambda x: x != 0))
    if length is None:
        lengths = rows.groupBy(F.size("embedding").alias("n")).count().orderBy(F.desc("count"), "n").first()
        length = lengths.n if lengths else 0
    rows = rows.where(F.size("embedding") == length)
    return rows.groupBy("vec_id").agg(F.min("embedding").alias("embedding"))


@dataclass(frozen=True)
class Index:
    """``radius``: the median distance of a vector to its centroid; a nearer query, one at a centroid say, selects lists as if it were as far."""

    centroids: np.ndarray
    graph: np.ndarray
    entries: np.ndarray
    radius: float

    def nearest(self, x: np.ndarray, keep: int) -> tuple[np.ndarray, np.ndarray]:
        """The nearest centroids of each row of ``x`` that a walk over the graph finds, nearest first, and their distances."""
        n, lists = len(x), len(self.centroids)
        beam = min(lists, keep + BEAM)
        distance = lambda rows, ids: np.sqrt(np.maximum(0, (x[rows][:, None] - self.centroids[ids]).__pow__(2).sum(-1)))
        ids = np.tile(self.entries, (n, 1))
        dist = distance(np.arange(n), ids)
        seen = np.zeros((n, lists), bool)
        np.put_along_axis(seen, ids, True, 1)
        opened = np.zeros((n, lists), bool)
        while True:
            order = np.argsort(dist, 1, kind="stable")[:, :beam]
            ids, dist = np.take_along_axis(ids, order, 1), np.take_along_axis(dist, order, 1)
            fresh = ~np.take_along_axis(opened, ids, 1) & np.isfinite(dist)
            rows = np.flatnonzero(fresh.any(1))
            if not len(rows):
                return ids[:, :keep], dist[:, :keep]
            first = np.argsort(~fresh[rows], 1, kind="stable")[:, : max(4, beam // 64)]  # the nearest that are not opened yet, more at a time on a long walk
            take = np.take_along_axis(ids[rows], first, 1)
            np.logical_or.at(opened, (rows[:, None], take), True)
            more = self.graph[take].reshape(len(rows), -1)
            ranked = np.sort(more, 1)
            known = seen[rows[:, None], ranked]
            known[:, 1:] |= ranked[:, 1:] == ranked[:, :-1]
            far = np.where(known, np.inf, distance(rows, ranked))
            seen[rows[:, None], ranked] = True
            ids = np.concatenate([ids, np.zeros((n, ranked.shape[1]), ids.dtype)], 1)
            dist = np.concatenate([dist, np.full((n, ranked.shape[1]), np.inf)], 1)
            ids[rows, -ranked.shape[1] :], dist[rows, -ranked.shape[1] :] = ranked, far


    def within(self, x: np.ndarray, ratio: float, least: int) -> list[np.ndarray]:
        """For each row of ``x`` its lists within ``ratio``, ``least`` at least, nearest first: walks go on until they have left the ratio."""
        out: list[np.ndarray] = [np.zeros(0, int)] * len(x)
        rows, keep, lists = np.arange(len(x)), min(32, len(self.centroids)), len(self.centroids)
        while len(rows):
            ids, dist = self.nearest(x[rows], keep)
            edge = ratio * np.maximum(dist[:, 0], self.radius)
            fits = (dist <= edge[:, None]) | (np.arange(ids.shape[1]) < least) & np.isfinite(dist)
            over = (dist[:, -1] > edge) & (keep > least) | (keep >= lists)
            for i in np.flatnonzero(over):
                out[rows[i]] = ids[i, fits[i]]
            rows, keep = rows[~over], min(2 * keep, lists)
        return out


def fit(vectors: DataFrame, sample: int = SAMPLE, list_size: int = LIST, lists: int = LISTS, rounds: int = 12) -> Index | None:
    """Centroids and their graph from at most ``sample`` vectors of ``usable``; None without vectors. The number of lists follows the count of all vectors."""
    total = vectors.count()
    if not total:
        return None
    x = _matrix(vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).select("embedding").toArrow().column(0))
    k = max(1, min(lists, math.ceil(total / list_size), len(x)))
    centroids = x[np.linspace(0, len(x) - 1, k).astype(int)].copy()
    load = np.full(k, 1 / k)
    for _ in range(rounds):
        square = (centroids**2).sum(1)
        near = np.concatenate([np.argmin((square - 2 * part @ centroids.T + (part**2).sum(1)[:, None]) * (0.75 + 0.25 * load * k), 1) for part in np.array_split(x, max(1, len(x) // 2000))])
        count = np.bincount(near, minlength=k)
        load = 0.5 * load + 0.5 * count / len(x)
        sums = np.zeros_like(centroids)
        np.add.at(sums, near, x)
        centroids = np.where(count[:, None] > 0, sums / np.maximum(1, count)[:, None], centroids)
    square = (centroids**2).sum(1)
    parts = np.array_split(np.arange(k), max(1, k // 1000))
    graph = np.concatenate([np.argsort(square - 2 * centroids[p] @ centroids.T, 1, kind="stable")[:, : min(k, DEGREE + 1)] for p in parts])
    radius = float(np.median(np.sqrt(((x - centroids[near]) ** 2).sum(1))))
    return Index(centroids, graph, np.linspace(0, k - 1, min(k, max(8, int(k**0.5)))).astype(int), radius)


def _listed(rows: DataFrame, index: Index, ratio: float, most: int | None, tag: str, least: int = 1, wanted: int = 0, sizes: np.ndarray | None = None) -> DataFrame:
    """(lists, id, embedding) of ``rows`` (id, embedding): the lists within ``ratio``, nearest first, at most ``most`` (copies), or all (queries).

    ``least`` lists are always there, and with ``sizes`` of the lists as many as hold ``wanted`` vectors, all lists if
    need be. The walks are done once: the rows are written.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                x = _matrix(part.column(1))
                if most is None:
                    lists = index.within(x, ratio, least)
                else:
                    ids, dist = index.nearest(x, most)
                    fits = (dist <= ratio * dist[:, :1]) | (np.arange(ids.shape[1]) < least) & np.isfinite(dist)
                    lists = [i[f] for i, f in zip(ids, fits, strict=True)]
                if sizes is not None:
                    for i in [i for i, own in enumerate(lists) if sizes[own].sum() < wanted]:  # too few vectors there
                        every = np.argsort(((index.centroids - x[i]) ** 2).sum(1), kind="stable")
                        enough = int(np.searchsorted(np.cumsum(sizes[every]), wanted)) + 1
                        lists[i] = np.concatenate([lists[i], np.setdiff1d(every[:enough], lists[i])])
                ends = np.concatenate([[0], np.cumsum(list(map(len, lists)))]).astype(np.int32)
                column = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(lists).astype(np.int32)))
                yield pa.RecordBatch.from_arrays([column, part.column(0), part.column(1)], names=["lists", "id", "embedding"])

    return written(rows.mapInArrow(tidy(task), "lists array<int>, id long, embedding array<double>"), tag)


def fitted_ratio(rows: DataFrame, postings: DataFrame, index: Index, k: int, recall: float = RECALL, sample: int = FITTED) -> float:
    """The least ratio at which ``sample`` of ``rows`` (those of the smallest hash) visit lists with the share ``recall`` of their ``k`` exact neighbours among all rows."""
    picked = rows.orderBy(F.xxhash64("vec_id", F.lit(1)), "vec_id").limit(sample).toArrow()
    q, own = _matrix(picked.column("embedding")), picked.column("vec_id").to_numpy()

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, ids = np.full((len(q), k), np.inf), np.full((len(q), k), -1, np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                here, x = part.column(0).to_numpy(), _matrix(part.column(1))
                dist = np.maximum(0, (q**2).sum(1)[:, None] - 2 * q @ x.T + (x**2).sum(1))
                dist[own[:, None] == here] = np.inf
                best, ids = np.concatenate([best, dist], 1), np.concatenate([ids, np.broadcast_to(here, dist.shape)], 1)
                order = np.argsort(best, 1, kind="stable")[:, :k]
                best, ids = np.take_along_axis(best, order, 1), np.take_along_axis(ids, order, 1)
        there = np.isfinite(best)
        yield pa.RecordBatch.from_arrays([pa.array(np.nonzero(there)[0].astype(np.int32)), pa.array(ids[there]), pa.array(best[there])], names=["q", "id", "far"])

    order = Window.partitionBy("q").orderBy("far", "id")
    near = rows.select("vec_id", "embedding").mapInArrow(tidy(task), "q int, id long, far double").withColumn("r", F.row_number().over(order)).where(F.col("r") <= k)
    found = postings.select("id", "lists").join(F.broadcast(near.select("q", "id")), "id").collect()  # sample * k rows at most
    if not found:
        return 1.0
    dist = np.sqrt(((q[:, None] - index.centroids) ** 2).sum(-1)) if len(index.centroids) <= 256 else np.stack([np.sqrt(((index.centroids - x) ** 2).sum(1)) for x in q])
    edge = np.maximum(dist.min(1), index.radius)
    ratios = np.sort([dist[r.q, r.lists].min() / edge[r.q] for r in found])
    return float(ratios[min(len(ratios) - 1, math.ceil(recall * len(ratios)) - 1)]) * (1 + 1e-9)


def search(vectors: DataFrame, is_query: Column, k: int = 10, copy_ratio: float = COPY_RATIO, copies: int = COPIES, probe_ratio: float | None = None, recall: float = RECALL, block: int = BLOCK, length: int | None = None, **options) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest of the other vectors found for each of ``vectors`` (vec_id, embedding) that ``is_query`` holds for.

    ``score`` is the Euclidean distance in double precision; nearest first, ties to the smaller vec_id; each query has k
    rows, or all candidates if there are fewer. Rows that ``usable`` leaves out take no part. Without queries, or without vectors, no rows.
    """
    rows = usable(vectors, length)
    index = fit(rows, **options)
    if index is None:
        return rows.select(F.col("vec_id").alias("query_id"), F.lit(1).alias("rank"), "vec_id", F.lit(0.0).alias("score")).limit(0)
    postings = _listed(rows.select("vec_id", "embedding"), index, copy_ratio, copies, "postings")
    # vectors by their nearest list, so none counts twice; a row for each list
    sizes = np.zeros(len(index.centroids), np.int64)
    for row in postings.groupBy(F.get("lists", F.lit(0)).alias("list")).count().collect():
        sizes[row["list"]] = row["count"]
    ratio = fitted_ratio(rows, postings, index, k, recall) if probe_ratio is None else probe_ratio
    queries = _listed(rows.where(is_query).select("vec_id", "embedding"), index, ratio, None, "probes", LEAST, k + 1, sizes)
    postings, queries = (x.select(F.explode("lists").alias("list"), "id", "embedding") for x in (postings, queries))

    # both sides of a list in blocks; the counts have a row for each list, whatever the input
    parts = lambda rows, name: rows.groupBy("list").agg(F.ceil(F.count("*") / block).cast("int").alias(name))
    sizes = F.broadcast(parts(postings, "list_blocks").join(parts(queries, "query_blocks"), "list"))
    upto = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    own = lambda c: F.pmod(F.xxhash64("id"), F.col(c)).cast("int")
    keys = ["list", "x", "y"]
    postings = postings.join(sizes, "list").withColumn("x", own("list_blocks")).withColumn("y", upto("query_blocks")).select(*keys, "id", "embedding")
    queries = queries.join(sizes, "list").withColumn("y", own("query_blocks")).withColumn("x", upto("list_blocks")).select(*keys, "id", "embedding")

    def nearest(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[list] = [[], [], []]
        if left.num_rows and right.num_rows:
            q, v = _matrix(left.column("embedding")), _matrix(right.column("embedding"))
            ids = right.column("id").to_numpy()
            for query, x in zip(left.column("id").to_numpy(), q, strict=True):
                dist = np.sqrt(((v - x) ** 2).sum(1))
                dist[ids == query] = np.inf
                best = np.lexsort((ids, dist))[: k + 1] if len(ids) <= 64 else None
                if best is None:
                    edge = np.partition(dist, min(k, len(dist) - 1))[min(k, len(dist) - 1)]
                    best = np.flatnonzero(dist <= edge)
                    best = best[np.lexsort((ids[best], dist[best]))]
                best = best[ids[best] != query][:k]
                out[0] += [query] * len(best)
                out[1] += ids[best].tolist()
                out[2] += dist[best].tolist()
        return pa.table([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.float64())], names=["query_id", "vec_id", "score"])

    found = queries.groupBy(*keys).cogroup(postings.groupBy(*keys)).applyInArrow(nearest, "query_id long, vec_id long, score double").dropDuplicates(["query_id", "vec_id"])
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
