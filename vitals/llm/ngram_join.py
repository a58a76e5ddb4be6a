"""Similarity join of documents on the Jaccard similarity of their word n-grams, with count-vector R-trees.

N-grams are hashed into groups; a document's counts by group are a point, and the sum of the coordinate minima of two
points bounds the overlap of their sets from above. Points are indexed in R-trees, whose boxes give the same bound for all
points inside, and only pairs that pass are verified on the sets.

One tree over a corpus can't prune: random texts of n words differ by about sqrt(n x groups) and linked ones by up to
0.16 n, so every leaf would meet a constant share of the others. So trees are built by cell. Each set has a short list of
cells, its first n-grams in an order that puts the corpus' commonest last. Two sets that reach the threshold share a share
of their cells whatever that order is (``needed``), so sets that share fewer with all others together go, and nothing is
lost. Each set goes first to a tree under the most central member of its cells, that whose own cells are most often shared
(the text that others were copied from), and that member searches the tree; cells whose members that has brought together
need no tree of their own. So every link is a pair that a tree's search has let pass.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bytewords import IS_SPACE, LOWER, mixed, runs, slices, span_hashes, tidy
from .common import HOT, components, dealt, free_name, hot_deals, met, shuffle_partitions, written

WORDS = 4
PERCENT = 85
GROUPS = 256
#: The commonest n-grams that go last in the order of cells, at most; which these are never changes the result.
COMMON = 200_000
#: Percent of a set's size that two linked sets have as common cells; the list of cells is longer by as much.
MARGIN = 5
#: Members of a cell that one task joins at once; larger cells are joined block by block.
BLOCK = 8192
FANOUT = 16
#: Pairs of one leader or set that one task takes.
LED = 512
#: Rows and nodes that a search of the trees compares at once.
PIECE = 20_000
#: Bits of the filter of candidates for each key, and of the largest filter; beyond that texts are joined with the candidates' ids.
KEY_BITS, MOST_BITS = 16, 1 << 27
#: Pairs that a task of the trees holds before it sends them on.
HELD = 2_000_000
_FACTORS = mixed(np.arange(1, 4097, dtype=np.uint64)) | np.uint64(1)


def ngram_sets(data: np.ndarray, offsets: np.ndarray, words: int, seed: int = 0) -> list[np.ndarray]:
    """The sorted distinct n-gram hashes of each row of a slice; with fewer words, that of them all; without, none."""
    low = LOWER[data]
    starts, ends, first = runs(~IS_SPACE[low], offsets)
    h = span_hashes(low, starts, ends, seed)
    grams = sum((h[k : len(h) - words + 1 + k] * _FACTORS[k] for k in range(words)), np.zeros(max(0, len(h) - words + 1), np.uint64)) if len(h) >= words else np.zeros(0, np.uint64)
    grams = mixed(grams)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= words:
            out.append(np.unique(grams[a : b - words + 1]))
        elif b > a:
            out.append(mixed((h[a:b] * _FACTORS[: b - a]).sum(keepdims=True, dtype=np.uint64) + np.uint64(b - a)))
        else:
            out.append(h[:0])
    return out


def least_overlap(n_a, n_b, percent: int):
    """The smallest overlap with which sets of these sizes link: 100 x overlap >= percent x union."""
    return -(-percent * (n_a + n_b) // (100 + percent))


def n_cells(n: int, percent: int) -> int:
    """The length of the list of cells of a set of size n."""
    return n - -(-percent * n // 100) + max(1, -(-MARGIN * n // 100))


def needed(n, percent: int):
    """Cells that a set of size n shares with each set that it links to, at least: MARGIN percent of the smaller of the two.

    Sets that link have percent % of the larger in common. Of these, in the order of cells, the first k stand in a set's
    list if it holds n - percent % of n + k of its n-grams.
    """
    return -(-MARGIN * -(-percent * n // 100) // 100)


def _common(docs: DataFrame, words: int, seed: int, most: int) -> tuple[np.ndarray, dict[int, int]]:
    """The n-grams that occur most often, from counts over all texts, at most ``most``, and of these the hot ones with the tasks that each is dealt to. A task sends on what it meets often.

    An n-gram is hot with more than BLOCK and HOT of all rows; at most 1 / HOT are named.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def counted(parts: list[np.ndarray]) -> pa.RecordBatch:
            grams, n = np.unique(np.concatenate(parts), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(grams[n > 3].view(np.int64)), pa.array(n[n > 3])], names=["gram", "n"])

        parts, held = [], 0
        for batch in batches:
            for _, data, offsets in slices(batch.column(0)):
                parts += ngram_sets(data, offsets, words, seed)
                held += sum(map(len, parts[-len(offsets) + 1 :]))
                if held > 3_000_000:
                    yield counted(parts)
                    parts, held = [], 0
        if parts:
            yield counted(parts)

    rows = docs.select("text").mapInArrow(tidy(task), "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).where("n >= 32")
    rows = rows.orderBy(F.desc("n"), "gram").limit(most).collect()
    many = max(BLOCK, HOT * docs.count()) if rows and rows[0].n > BLOCK else float("inf")
    hot = {r.gram: int(r.n // many) + 1 for r in rows[: int(1 / HOT)] if r.n > many}
    return np.sort(np.array([r.gram for r in rows], np.int64).view(np.uint64)), hot


def _point(grams: np.ndarray) -> bytes:
    """The counts by group, each up to 255, and what that cuts off in all; the sum of minima of all of these still bounds the overlap from above."""
    counts = np.bincount((grams % np.uint64(GROUPS)).astype(np.int64), minlength=GROUPS)
    held = np.minimum(counts, 255)
    return held.astype(np.uint8).tobytes() + (counts - held).sum().astype("<u4").tobytes()


def _points(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    rows = np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, GROUPS + 4)
    return rows[:, :GROUPS], np.ascontiguousarray(rows[:, GROUPS:]).view("<u4").ravel().astype(np.int64)


def _bound(p: np.ndarray, rest_p: np.ndarray, q: np.ndarray, rest_q: np.ndarray) -> np.ndarray:
    """At least the overlap of the sets with these points."""
    return np.minimum(p, q).sum(-1, dtype=np.int64) + np.minimum(rest_p, rest_q)


def _digest(grams: np.ndarray) -> bytes:
    return hashlib.blake2b(grams.tobytes(), digest_size=24).digest()


def _key(digest: bytes) -> int:
    return int.from_bytes(digest[:8], "little", signed=True)


def _sets(docs: DataFrame, words: int, seed: int) -> DataFrame:
    """(doc_id, text_hash, key, digest, n) of each row: key and digest name the set."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, data, offsets in slices(batch.column(2)):
                sets = ngram_sets(data, offsets, words, seed)
                digests = list(map(_digest, sets))
                new = [pa.array(list(map(_key, digests)), pa.int64()), pa.array([d[8:] for d in digests], pa.binary()), pa.array(list(map(len, sets)), pa.int64())]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(sets)), batch.column(1).slice(at, len(sets)), *new], names=["doc_id", "text_hash", "key", "digest", "n"])

    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    return rows.mapInArrow(tidy(task), "doc_id long, text_hash long, key long, digest binary, n long")


def _cells(texts: DataFrame, words: int, percent: int, seed: int, common: np.ndarray) -> DataFrame:
    """(cell, key): the list of cells of each row's set."""

    def first(grams: np.ndarray) -> np.ndarray:
        if len(common) and len(grams):
            at = np.minimum(np.searchsorted(common, grams), len(common) - 1)
            often = common[at] == grams
            grams = np.concatenate([grams[~often], grams[often]])
        return grams[: n_cells(len(grams), percent)]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, data, offsets in slices(batch.column(0)):
                sets = {_key(_digest(s)): s for s in ngram_sets(data, offsets, words, seed) if len(s)}
                cells = [first(s).view(np.int64) for s in sets.values()]
                if cells:
                    keys = np.repeat(np.array(list(sets), np.int64), list(map(len, cells)))
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(cells)), pa.array(keys)], names=["cell", "key"])

    return texts.select("text").mapInArrow(tidy(task), "cell long, key long")


def _shared_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows with each cell's and in it each key's rows together: (cell, key, leader) of the cells with several keys; the leader is the first key.

    Of a hot cell, whose keys several tasks have (``deal`` from 0), each key is told, and the leader is the deal's.
    """
    cell = leader = last = deal = None
    told = False
    for batch in batches:
        c, k, d = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1, 2))
        if not len(c):
            continue
        new = np.ones(len(c), bool)
        new[1:] = (c[1:] != c[:-1]) | (d[1:] != d[:-1])
        new[0] = cell is None or c[0] != cell or d[0] != deal
        again = np.zeros(len(c), bool)
        again[1:] = (k[1:] == k[:-1]) & ~new[1:]
        again[0] = not new[0] and k[0] == last
        end = (c[-1], k[-1], d[-1])
        c, k, d, new = c[~again], k[~again], d[~again], new[~again]
        group = np.cumsum(new)
        firsts = np.concatenate([[leader if leader is not None else 0], k[new]]).astype(np.int64)
        cells = np.concatenate([[cell if cell is not None else 0], c[new]]).astype(np.int64)
        grown = np.zeros(len(firsts), bool)
        grown[group[~new]] = True
        grown[1:] |= d[new] >= 0
        heads = grown.copy()
        heads[0] &= not told
        out = [np.concatenate([cells[heads], c[~new]]), np.concatenate([firsts[heads], k[~new]]), np.concatenate([firsts[heads], firsts[group[~new]]])]
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], names=["cell", "key", "leader"])
        told = bool(grown[-1]) or (len(firsts) == 1 and told)
        cell, last, deal, leader = *end, firsts[-1]


def _by_cell(pairs: DataFrame, hot: dict[int, int], *order: str) -> DataFrame:
    """(cell, key, leader) of ``pairs`` (cell, key, ``order``) of the cells that several keys share, each once; keys of a hot cell are dealt to several tasks."""
    if hot:
        deals = F.broadcast(pairs.sparkSession.createDataFrame(list(hot.items()), "cell long, __deals int"))
        pairs = pairs.join(deals, "cell", "left").withColumn("deal", F.coalesce(F.pmod(F.xxhash64("key"), F.col("__deals")).cast("int"), F.lit(-1)))
    else:
        pairs = pairs.withColumn("deal", F.lit(-1))
    rows = pairs.select("cell", "key", "deal", *order).repartition(shuffle_partitions(pairs.sparkSession), "cell", "deal").sortWithinPartitions("cell", "deal", *order, "key")
    return rows.mapInArrow(tidy(_shared_cells), "cell long, key long, leader long")


def _one_leader(cells: DataFrame, apart: DataFrame, hot: dict[int, int]) -> DataFrame:
    """``cells`` (written) in which the deals of each hot cell have one leader: the first of theirs by ``apart`` (key, apart)."""
    if not hot:
        return cells
    named = F.broadcast(cells.sparkSession.createDataFrame([(c,) for c in hot], "cell long"))
    leaders = cells.join(named, "cell").select("cell", F.col("leader").alias("key")).distinct().join(apart, "key")
    first = F.broadcast(leaders.groupBy("cell").agg(F.min_by("key", F.struct("apart", "key")).alias("__first")))  # at most 1 / HOT cells
    return cells.join(first, "cell", "left").select("cell", "key", F.coalesce("__first", "leader").alias("leader"))


def _slots(key: np.ndarray, doc_id: np.ndarray, bits: int) -> np.ndarray:
    return (mixed(key.astype(np.int64).view(np.uint64) + mixed(doc_id.astype(np.int64).view(np.uint64))) & np.uint64((1 << bits) - 1)).astype(np.int64)


def _filter_bits(keys: DataFrame, bits: int) -> np.ndarray:
    """A bitmap of 2^bits with a bit for each (key, doc_id): a filter that lets all of these pass, and few others."""
    page = 15

    def slot(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, doc = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(_slots(key, doc, bits)))], names=["slot"])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pages: dict[int, np.ndarray] = {}
        for batch in batches:
            slot = batch.column(0).to_numpy(zero_copy_only=False)
            for p in np.unique(slot >> page).tolist():
                pages.setdefault(p, np.zeros(1 << page, bool))[slot[slot >> page == p] & ((1 << page) - 1)] = True
        yield pa.RecordBatch.from_arrays([pa.array(list(pages), pa.int64()), pa.array([np.packbits(x).tobytes() for x in pages.values()], pa.binary())], names=["page", "bits"])

    slots = keys.select("key", F.coalesce("least_id", F.lit(-1)).alias("doc")).mapInArrow(tidy(slot), "slot long").distinct()
    slots = slots.repartition(F.shiftright("slot", page)).mapInArrow(tidy(task), "page long, bits binary")
    out = np.zeros((1 << (bits - page), 1 << (page - 3)), np.uint8)
    for row in slots.collect():  # pages differ between tasks: at most 2^bits bits in all
        out[row.page] = np.frombuffer(row.bits, np.uint8)
    return out.ravel()


def _members(docs: DataFrame, keys: DataFrame, words: int, seed: int, most: int | None = None) -> DataFrame:
    """(key, n, point, grams) of each set of ``keys``, from the text of its smallest doc_id, without moving texts.

    Others that pass the filter may be among them, and repeated rows are there as often; neither changes a link. The
    filter grows with the number of keys; where it would be larger than ``most`` bits, texts are joined with the doc_ids
    of the keys instead, so that only theirs pass.
    """
    bits = max(16, (KEY_BITS * keys.count() - 1).bit_length())
    passing = _filter_bits(keys, bits) if 1 << bits <= (MOST_BITS if most is None else most) else None
    if passing is None:
        named = keys.select(F.coalesce("least_id", F.lit(-1)).alias("__id")).distinct()
        docs = docs.join(named, F.coalesce("doc_id", F.lit(-1)) == F.col("__id"), "left_semi")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc_id = batch.column(0).fill_null(-1).to_numpy(zero_copy_only=False)
            for at, data, offsets in slices(batch.column(1)):
                sets = ngram_sets(data, offsets, words, seed)
                keys = np.array([_key(_digest(s)) for s in sets], np.int64)
                slot = _slots(keys, doc_id[at : at + len(sets)], bits)
                passed = [True] * len(sets) if passing is None else (passing[slot >> 3] >> (7 - (slot & 7)).astype(np.uint8) & 1).tolist()
                out = {k: s for k, s, good in zip(keys.tolist(), sets, passed, strict=True) if good and len(s)}
                points = list(map(_point, out.values()))
                columns = [pa.array(list(out), pa.int64()), pa.array(list(map(len, out.values())), pa.int64()), pa.array(points, pa.binary()), pa.array([s.tobytes() for s in out.values()], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["key", "n", "point", "grams"])

    return docs.select("doc_id", "text").mapInArrow(tidy(task), "key long, n long, point binary, grams binary")


def _verified(pairs: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """The ``pairs`` (a, b; written) whose sets link. A set of many pairs goes to several tasks, and what is joined last isn't moved again: ``a`` is the one with more pairs."""

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = np.concatenate([x, y])
                both.sort(kind="stable")
                good.append(int((both[1:] == both[:-1]).sum()) >= least_overlap(len(x), len(y), percent))
            yield batch.filter(pa.array(good, pa.bool_())).select([0, 1])

    side = lambda x: members.select(F.col("key").alias(x), F.col("grams").alias(f"grams_{x}"))
    total = pairs.count()
    found = met(met(pairs, side("b"), "b", "a", total, LED), side("a"), "a", "b", total, LED, pairs).select("a", "b", "grams_a", "grams_b")
    return written(found.mapInArrow(tidy(exact), "a long, b long").distinct(), "links")


def _led(best: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of ``best`` (a leads b; written) that trees let pass: each leader's followers are trees that its own point searches, a block of them at a time."""
    deals = dealt(best, hot_deals(best, "a", best.count(), LED), "a", "b").withColumnRenamed("__deal", "x")
    points = members.groupBy("key").agg(F.min("n").alias("n"), F.min("point").alias("point"))
    follow = deals.join(points, F.col("b") == F.col("key")).select("a", "x", F.lit(1).alias("part"), "key", "n", "point")
    lead = deals.select("a", "x").distinct().join(points, F.col("a") == F.col("key")).select("a", "x", F.lit(0).alias("part"), "key", "n", "point")
    rows = lead.unionByName(follow).repartition(shuffle_partitions(best.sparkSession), "a", "x").sortWithinPartitions("a", "x", "part", "key")

    def found(cols: list[np.ndarray], cuts: np.ndarray) -> Iterator[pa.RecordBatch]:
        a, _, part, key, n, points, rests = cols
        run = np.repeat(np.arange(len(cuts) - 1), np.diff(cuts))
        own, rest = np.flatnonzero(part == 0), np.flatnonzero(part == 1)
        tree = _Tree(n[rest], points[rest], rests[rest], run[rest])
        for q, at in tree.find(run[own], n[own], points[own], rests[own], percent):
            yield pa.RecordBatch.from_arrays([pa.array(a[own[q]]), pa.array(key[rest[at]])], names=["a", "b"])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[np.ndarray] | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            cols = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(5)]
            cols += _points(batch.column(5))
            if kept is not None:
                cols = [np.concatenate([k, c]) for k, c in zip(kept, cols, strict=True)]
            cuts = np.concatenate([[0], np.flatnonzero((cols[0][1:] != cols[0][:-1]) | (cols[1][1:] != cols[1][:-1])) + 1])
            if cuts[-1]:
                yield from found([c[: cuts[-1]] for c in cols], cuts)
            kept = [c[cuts[-1] :] for c in cols]  # the last run may go on
        if kept is not None:
            yield from found(kept, np.array([0, len(kept[0])]))

    return rows.mapInArrow(tidy(task), "a long, b long")


class _Tree:
    """R-trees over points (counts by group) and sizes, one for each of ``runs``: leaves of neighbours in order of size and heaviest groups.

    Each level holds, for each node, the span of sizes, the box of points, the largest rest, the span of components and the
    first of its children. All trees grow and are searched together; a tree's root is its only node of a level.
    """

    def __init__(self, sizes: np.ndarray, points: np.ndarray, rests: np.ndarray | None = None, runs: np.ndarray | None = None, components: np.ndarray | None = None) -> None:
        n = len(sizes)
        runs = np.zeros(n, np.int64) if runs is None else runs
        components = np.arange(n) if components is None else components
        # members of one component side by side, if they fill a leaf, so that nodes hold one component alone
        _, home, often = np.unique(components, return_inverse=True, return_counts=True)
        large = np.where(often[home] > FANOUT, home + 1, 0)
        self.order = np.lexsort((points[:, 1], points[:, 0], sizes // 8, large, runs)) if n else np.zeros(0, int)
        self.levels: list[tuple[np.ndarray, ...]] = []
        low = high = sizes[self.order]
        first = last = components[self.order]
        box, rest, run = points[self.order], (np.zeros(n, np.int64) if rests is None else rests[self.order]), runs[self.order]
        child = end = np.arange(n)
        while True:
            self.levels.append((low, high, box, rest, first, last, run, child, end))
            new = np.ones(len(run), bool)
            new[1:] = run[1:] != run[:-1]
            if new.all():
                break
            starts = np.flatnonzero(new)
            nth = np.arange(len(run)) - np.repeat(starts, np.diff(np.append(starts, len(run))))
            child = np.flatnonzero(nth % FANOUT == 0)
            low, high = np.minimum.reduceat(low, child), np.maximum.reduceat(high, child)
            box, rest = np.maximum.reduceat(box, child), np.maximum.reduceat(rest, child)
            first, last, run = np.minimum.reduceat(first, child), np.maximum.reduceat(last, child), run[child]
            end = end[np.append(child[1:], len(end)) - 1]  # the last row below

    def _children(self, level: int, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nodes below, and how many each has."""
        child = np.append(self.levels[level][7], len(self.levels[level - 1][0]))
        n = child[nodes + 1] - child[nodes]
        return np.repeat(child[nodes] - np.cumsum(n) + n, n) + np.arange(n.sum()), n

    def search(self, size: int, point: np.ndarray, percent: int, rest: int = 0) -> np.ndarray:
        """Members whose size and bound allow a link."""
        nodes = np.arange(len(self.levels[-1][0]))
        for level in range(len(self.levels) - 1, -1, -1):
            low, high, box, more = (x[nodes] for x in self.levels[level][:4])
            fits = (100 * high >= percent * size) & (100 * size >= percent * low) & (_bound(box, more, point, rest) >= least_overlap(low, size, percent))
            nodes = nodes[fits]
            if level:
                nodes, _ = self._children(level, nodes)
        return self.order[nodes]

    def find(self, runs: np.ndarray, sizes: np.ndarray, points: np.ndarray, rests: np.ndarray, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query, member): members whose size and bound allow a link with the query of their run. ``runs``: each query's run, ascending; each run has one."""
        todo, begun = [], np.zeros(len(runs), bool)
        for level, (*_, run, _, _) in enumerate(self.levels):  # each query starts at the root of its run
            alone = np.ones(len(run), bool)
            alone[1:] &= run[1:] != run[:-1]
            alone[:-1] &= run[1:] != run[:-1]
            nodes = np.flatnonzero(alone)
            query = np.searchsorted(runs, run[nodes])
            nodes, query = nodes[~begun[query]], query[~begun[query]]
            begun[query] = True
            if len(nodes):
                todo.append((level, query, nodes))
        while todo:
            level, query, nodes = todo.pop()
            if len(query) > PIECE:
                todo.append((level, query[PIECE:], nodes[PIECE:]))
                query, nodes = query[:PIECE], nodes[:PIECE]
            low, high, box, more = self.levels[level][:4]
            n = sizes[query]
            fits = (100 * high[nodes] >= percent * n) & (100 * n >= percent * low[nodes])
            query, nodes = query[fits], nodes[fits]
            fits = _bound(box[nodes], more[nodes], points[query], rests[query]) >= least_overlap(low[nodes], sizes[query], percent)
            query, nodes = query[fits], nodes[fits]
            if not len(query):
                continue
            if level == 0:
                yield query, self.order[nodes]
            else:
                nodes, n = self._children(level, nodes)
                todo.append((level - 1, np.repeat(query, n), nodes))

    def pairs(self, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of members of one run and different components whose sizes and bound allow a link, each pair once."""
        sizes, _, points, rests, components = self.levels[0][:5]
        todo, below = [], np.zeros(len(sizes), bool)
        for level in range(1, len(self.levels)):  # each row starts at the root of its run
            run = self.levels[level][6]
            alone = np.ones(len(run), bool)
            alone[1:] &= run[1:] != run[:-1]
            alone[:-1] &= run[1:] != run[:-1]
            node = np.searchsorted(self.levels[level][7], np.arange(len(sizes)) if level == 1 else above, "right") - 1
            rows = np.flatnonzero(alone[node] & ~below)
            below[rows] = True
            above = node
            if len(rows):
                todo.append((level, rows, node[rows]))
        while todo:  # the deepest first, in pieces, so that few pairs are held
            level, rows, nodes = todo.pop()
            if len(rows) > PIECE:
                todo.append((level, rows[PIECE:], nodes[PIECE:]))
                rows, nodes = rows[:PIECE], nodes[:PIECE]
            low, high, box, rest, first, last, _, _, end = self.levels[level]
            n, own = sizes[rows], components[rows]
            fits = (end[nodes] > rows) & ((first[nodes] != own) | (last[nodes] != own)) & (100 * high[nodes] >= percent * n) & (100 * n >= percent * low[nodes])
            rows, nodes = rows[fits], nodes[fits]
            fits = _bound(box[nodes], rest[nodes], points[rows], rests[rows]) >= least_overlap(low[nodes], sizes[rows], percent)
            rows, nodes = rows[fits], nodes[fits]
            if not len(rows):
                continue
            if level == 0:
                yield self.order[rows], self.order[nodes]
            else:
                nodes, n = self._children(level, nodes)
                todo.append((level - 1, np.repeat(rows, n), nodes))


def _tree_pairs(cells: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b), a < b, of different components that share a cell and pass the bound. ``cells``: cell, key, component.

    A cell of up to BLOCK keys is one tree, however few they are. A larger one is cut into blocks; each key goes to a tree
    for each pair of blocks with its own.
    """
    mixed_cells = cells.groupBy("cell").agg(F.count("*").alias("m"), F.min("component").alias("least"), F.max("component").alias("most")).where("least != most")
    blocks = F.ceil(F.col("m") / BLOCK).cast("int")
    rows = cells.join(mixed_cells.select("cell", blocks.alias("blocks")), "cell").withColumn("own", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select("cell", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), "own", "key", "component")
    points = members.groupBy("key").agg(F.min("n").alias("n"), F.min("point").alias("point"))
    rows = rows.join(points, "key").select("cell", "x", "y", "own", "key", "component", "n", "point")
    rows = rows.repartition(shuffle_partitions(cells.sparkSession), "cell", "x", "y").sortWithinPartitions("cell", "x", "y", "key")

    def joined(cols: list[np.ndarray], cuts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Rows a, b of the pairs inside each run between ``cuts``, by a tree for each run."""
        _, x, y, own, key, component, n, points, rests = cols
        tree = _Tree(n, points, rests, np.repeat(np.arange(len(cuts) - 1), np.diff(cuts)), component)
        for a, b in tree.pairs(percent):
            good = (key[a] != key[b]) & ((own[a] != own[b]) | (x[a] == y[a]))
            yield a[good], b[good]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[np.ndarray] | None = None
        met, held = [], 0  # pairs that the task has met since it last sent some on

        def counted() -> pa.RecordBatch:
            a, b = (np.concatenate([m[i] for m in met]) for i in (0, 1))
            order = np.lexsort((b, a))
            a, b = a[order], b[order]
            first = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]))
            return pa.RecordBatch.from_arrays([pa.array(a[first]), pa.array(b[first]), pa.array(np.diff(np.append(first, len(a))))], names=["a", "b", "cells"])

        def out(cols: list[np.ndarray], cuts: np.ndarray) -> Iterator[pa.RecordBatch]:
            nonlocal met, held
            for a, b in joined(cols, cuts):
                if len(a):
                    met.append((np.minimum(cols[4][a], cols[4][b]), np.maximum(cols[4][a], cols[4][b])))
                    held += len(a)
                if held > HELD:
                    yield counted()
                    met, held = [], 0

        for batch in batches:
            if not batch.num_rows:
                continue
            cols = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(7)]
            cols += _points(batch.column(7))
            if kept is not None:
                cols = [np.concatenate([k, c]) for k, c in zip(kept, cols, strict=True)]
            new = np.flatnonzero(np.any([c[1:] != c[:-1] for c in cols[:3]], axis=0)) + 1
            cuts = np.concatenate([[0], new])
            yield from out([c[: cuts[-1]] for c in cols], cuts)
            kept = [c[cuts[-1] :] for c in cols]  # the last run may go on
        if kept is not None:
            yield from out(kept, np.array([0, len(kept[0])]))
        if met:
            yield counted()

    pairs = rows.mapInArrow(tidy(task), "a long, b long, cells long")
    pairs = pairs.groupBy("a", "b").agg(F.sum("cells").alias("cells"))
    size = members.groupBy("key").agg(F.min("n").alias("n"))
    pairs = pairs.join(size.select(F.col("key").alias("a"), F.col("n").alias("n_a")), "a").join(size.select(F.col("key").alias("b"), F.col("n").alias("n_b")), "b")
    return pairs.where(F.col("cells") >= F.ceil(F.least("n_a", "n_b") * MARGIN / 100)).select("a", "b")


def linked(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, common: int = COMMON) -> DataFrame:
    """doc_id, text_hash, n_shingles, component, component_id: one row for each row of ``docs`` (doc_id, text).

    Rows link when the Jaccard similarity of their sets reaches ``percent``; equal sets always do. ``component_id``: the
    smallest doc_id that links reach; rows without words stand alone, with their own doc_id. Null texts count as empty;
    a null doc_id is never the smallest if another is there. Repeated rows stay. An empty table gives no rows.

    N-grams are known by 64-bit hashes, so two different ones of a pair of texts are taken for one with a probability of
    about 2^-64. Sets are told apart by 64 bits of a digest; 128 further bits are compared, and all is done again with
    another hash if two sets should share a key.
    """
    docs = docs.select("doc_id", "text")
    for seed in range(8):
        rows = written(_sets(docs, words, seed), "sets")
        keys = rows.groupBy("key").agg(F.min("doc_id").alias("least_id"), F.max("n").alias("n"), (F.min("digest") != F.max("digest")).alias("clash"))
        if keys.where("clash").isEmpty():
            break
    often, hot = _common(docs, words, seed, common)
    cells = written(_by_cell(_cells(docs, words, percent, seed, often), hot), "shared-cells")
    few = F.ceil(MARGIN * F.ceil(percent * F.col("n") / 100) / 100)
    many = cells.groupBy("key").agg(F.count("*").alias("shared")).join(keys, "key").where(F.col("shared") >= few)
    length = F.col("n") - F.ceil(percent * F.col("n") / 100) + F.greatest(F.lit(1), F.ceil(MARGIN * F.col("n") / 100))
    many = written(many.select("key", "least_id", (1000 - F.floor(1000 * F.col("shared") / length)).alias("apart")), "candidates")
    cells = written(_by_cell(cells.join(many, "key").select("cell", "key", "apart"), hot, "apart"), "cells")
    cells = _one_leader(cells, many.select("key", "apart"), hot)
    members = written(_members(docs, many, words, seed), "members")

    # each key with the leader it shares most cells with
    votes = cells.where("key != leader").groupBy("key", "leader").agg(F.count("*").alias("votes"))
    best = votes.groupBy("key").agg(F.max_by("leader", F.struct("votes", "leader")).alias("a")).select("a", F.col("key").alias("b"))
    best = written(best.where("a is not null"), "leaders")
    links = _verified(written(_led(best, members, percent), "led"), members, percent)
    labels = written(components(links, "stars"), "labels")

    # what that leaves apart
    apart = cells.join(labels.withColumnRenamed("node", "key"), "key", "left").select("cell", "key", F.coalesce("component", "key").alias("component"))
    more = _verified(written(_tree_pairs(apart, members, percent), "tree-pairs"), members, percent)
    if not more.isEmpty():
        labels = written(components(links.unionByName(more), "stars"), "labels")
    keys = keys.where("n > 0").join(labels.withColumnRenamed("node", "key"), "key", "left").select("key", F.coalesce("component", "key").alias("component"), "least_id")
    least = keys.groupBy("component").agg(F.min("least_id").alias("component_id"))
    named = keys.join(least, "component").select("key", "component", "component_id")
    out = rows.select("doc_id", "text_hash", "key", "n").join(named, "key", "left")
    return out.select("doc_id", "text_hash", F.col("n").alias("n_shingles"), "component", F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def one_of_each(docs: DataFrame, **options) -> DataFrame:
    """One row of each component of ``docs``, with all its columns: one whose doc_id is the component's smallest. Rows without words all stay, but repeated ones once."""
    key = lambda text_hash: F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.coalesce(text_hash.cast("string"), F.lit("null")))
    kept = linked(docs, **options).where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    kept = kept.groupBy("component", F.when(F.col("n_shingles") == 0, F.struct("doc_id", "text_hash")).alias("alone"), "doc_id").agg(F.min("text_hash").alias("text_hash"))
    name, nth = free_name(docs, "__key"), free_name(docs, "__nth")
    rows = docs.withColumn(name, key(F.xxhash64("text"))).join(kept.select(key(F.col("text_hash")).alias(name)).distinct(), name, "left_semi")
    order = Window.partitionBy(name).orderBy("text")
    return rows.withColumn(nth, F.row_number().over(order)).where(F.col(nth) == 1).select(*docs.columns)
