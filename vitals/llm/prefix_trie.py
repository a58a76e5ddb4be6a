"""The trie of conversations' common beginnings, from union-find over the edges between sorted neighbours.

A conversation is the sequence of its turns' 16-byte fingerprints. Sorted, the conversations that share a beginning are
neighbours, and the number of turns that two neighbours share is an edge. Edges are taken in descending depth: each that
joins two components makes a branching node, or adds to one of its depth. The order is cut into ranges; each is a task
that makes the forest of its part, with its two outer neighbours as members without weight. What lies inside of a range is
final; the nodes that a neighbouring range shares are contracted to one row of sums each and merged across the boundaries
by the fingerprint of their beginning. All that a node says is a sum, a count or a minimum over its members, so the order of
merging doesn't matter. No range, group of copies or popular beginning is ever gathered.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bytewords import tidy
from .common import shuffle_partitions, with_hot_keys, written

#: Bytes of a turn's fingerprint.
TURN = 16
#: Bytes of sequences and conversations in a range, about.
RANGE_BYTES, RANGE_ROWS = 32 << 20, 100_000
#: Ids of a node's own conversations in one row, where they cross ranges.
CHUNK = 50_000
NOTHING = hashlib.sha256(b"").hexdigest()

#: kind: 0 a final node, 1 a part of a shared node, 2 ids of conversations that end in a shared node.
PARTS = (
    "kind int, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string, "
    "node binary, parent binary, part int, chunk int, ids string"
)
NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def sequences(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns: array of (turn, role, print, chars)) of ``conversations`` (conv_id, turn, role, text), in order.

    Turns are ordered by turn, null first, ties by role and fingerprint; a null role or text is empty. Repeated rows are
    turns of their own. Rows without conv_id take no part. A conversation's fingerprints, not its texts, have to fit in a row.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turn = F.struct(F.col("turn").cast("long").alias("turn"), role.alias("role"), F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)).alias("print"), F.length(text).cast("long").alias("chars"))
    rows = conversations.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("t"))
    return rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))


def rebuilt(chats: DataFrame, family: int = 100, most: int = 6) -> DataFrame:
    """``chats`` (conv_id, turns) in which each conversation c begins with the first h turns of conversation c - c % ``family``, h = crc32(c as text) % ``most``.

    Its own turns after its first h follow. Without that conversation, or with fewer turns there, what is there is taken.
    """
    base = chats.where(F.col("conv_id") % family == 0).select(F.col("conv_id").alias("__base"), F.slice("turns", 1, most - 1).alias("__first"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int")
    rows = chats.withColumns({"__of": F.col("conv_id") - F.col("conv_id") % family, "__h": h})
    rows = rows.join(base, F.col("__of") == F.col("__base"), "left")
    begun = F.when(F.col("__first").isNull(), F.slice("turns", 1, 0)).otherwise(F.slice("__first", F.lit(1), F.col("__h")))
    return rows.select("conv_id", F.concat(begun, F.slice("turns", F.col("__h") + 1, F.size("turns"))).alias("turns"))


def shared_turns(a: bytes, b: bytes) -> int:
    """How many turns the two sequences begin with in common."""
    low, high = 0, min(len(a), len(b)) // TURN
    if a[: high * TURN] == b[: high * TURN]:
        return high
    while low < high:  # low are shared, high aren't beyond
        mid = (low + high + 1) // 2
        if a[low * TURN : mid * TURN] == b[low * TURN : mid * TURN]:
            low = mid
        else:
            high = mid - 1
    return low


class Forest:
    """Nodes over the sorted distinct ``keys``: ``depth``, ``kids``, and the keys from ``low`` to ``high`` below each. The first nodes are the keys' own."""

    def __init__(self, keys: list[bytes]) -> None:
        n = len(keys)
        self.depth = [len(k) // TURN for k in keys]
        self.kids: list[list[int]] = [[] for _ in keys]
        self.low, self.high = list(range(n)), list(range(n))
        above, top = list(range(n)), list(range(n))

        def find(x: int) -> int:
            while above[x] != x:
                above[x] = above[above[x]]
                x = above[x]
            return x

        shared = [shared_turns(a, b) for a, b in zip(keys, keys[1:], strict=False)]
        for i in sorted(range(n - 1), key=lambda i: (-shared[i], i)):
            left, right = find(i), find(i + 1)
            node, other = top[left], top[right]
            if self.depth[node] == shared[i]:
                self.kids[node].append(other)
                self.high[node] = self.high[other]
            else:
                node = self._add(shared[i], [node, other])
            above[right] = left
            top[left] = node
        self.root = top[find(0)]
        if self.depth[self.root]:
            self.root = self._add(0, [self.root])

    def _add(self, depth: int, kids: list[int]) -> int:
        self.depth.append(depth)
        self.kids.append(kids)
        self.low.append(self.low[kids[0]])
        self.high.append(self.high[kids[-1]])
        return len(self.depth) - 1


def _prints(key: bytes) -> list[bytes]:
    """The fingerprint of each beginning of ``key``, from the empty one on."""
    state, out = hashlib.blake2b(digest_size=TURN), []
    for at in range(0, len(key) + 1, TURN):
        out.append(state.copy().digest())
        state.update(key[at : at + TURN])
    return out


def range_nodes(rows: list[tuple[bytes, int, list[int]]], before: bytes | None, after: bytes | None, part: int) -> Iterator[tuple]:
    """Rows of ``PARTS`` of one range: ``rows`` (sequence, conv_id, characters of each turn), the last sequence before the range and the first one after it."""
    rows.sort(key=lambda r: r[:2])
    keys, members = [], []
    for key, conv, chars in rows:
        if not keys or keys[-1] != key:
            keys.append(key)
            members.append(([], [0, *accumulate(chars)]))
        members[-1][0].append(conv)
    if before is not None and before != keys[0]:
        keys.insert(0, before)
        members.insert(0, ([], []))
    if after is not None and after != keys[-1]:
        keys.append(after)
        members.append(([], []))
    own = [i for i, m in enumerate(members) if m[0]]
    first, last = own[0], own[-1]
    tree = Forest(keys)
    sums = [0, *accumulate(len(m[0]) for m in members)]
    n_nodes = len(tree.depth)
    n = [sums[tree.high[v] + 1] - sums[tree.low[v]] for v in range(n_nodes)]
    shared_left = [before is not None and tree.low[v] == 0 for v in range(n_nodes)]
    shared_right = [after is not None and tree.high[v] == len(keys) - 1 for v in range(n_nodes)]
    begins = [int(n[v] > 0 and not shared_left[v]) for v in range(n_nodes)]
    is_open = [shared_left[v] or shared_right[v] or v == tree.root for v in range(n_nodes)]
    parent = [-1] * n_nodes
    for v, kids in enumerate(tree.kids):
        for k in kids:
            parent[k] = v
    least, leaves, below = [0] * n_nodes, [0] * n_nodes, [0] * n_nodes
    chars = [members[min(max(tree.low[v], first), last)][1] for v in range(n_nodes)]  # of a member of the range, if the node has one
    for v in sorted(range(n_nodes), key=lambda v: -tree.depth[v]):
        if not n[v]:
            continue
        kids = [k for k in tree.kids[v] if n[k]]
        least[v] = min([least[k] for k in kids] + (members[v][0][:1] if v < len(keys) else []))
        leaves[v] = sum(leaves[k] for k in kids) if tree.kids[v] else int(not shared_right[v])
        below[v] = sum(below[k] + (n[k] - begins[k]) * (chars[k][tree.depth[k]] - chars[k][tree.depth[v]]) for k in kids)
    left, right = _prints(keys[first]), _prints(keys[last])
    for v in range(n_nodes):
        if not n[v]:
            continue
        up, here, conv = parent[v], tree.depth[v], least[v]
        top = tree.depth[up] if up >= 0 else -1
        prints = left if shared_left[v] or v == tree.root else right
        ids = members[v][0] if v < len(keys) else []
        sha = NOTHING
        if ids and is_open[v]:
            for chunk, at in enumerate(range(0, len(ids), CHUNK)):
                yield (2, None, None, None, None, None, None, None, None, prints[here], None, part, chunk, ",".join(map(str, ids[at : at + CHUNK])))
        elif ids:
            sha = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        for depth in range(top + 1, here + 1):
            at_end = depth == here
            children = sum(begins[k] for k in tree.kids[v]) if at_end else begins[v]
            saved = below[v] + ((n[v] - begins[v]) * (chars[v][here] - chars[v][depth - 1]) if depth else 0)
            if is_open[v]:
                yield (1, conv, depth, None, n[v], children, leaves[v], saved, None, prints[depth], prints[depth - 1] if depth else None, None, None, None)
            else:
                inside = depth > top + 1
                known = conv if inside else least[up] if not is_open[up] else None
                above = None if known is not None else (left if shared_left[up] or up == tree.root else right)[top]
                yield (0, conv, depth, known, n[v], children, leaves[v], saved, sha if at_end else NOTHING, None, above, None, None, None)


_SCHEMA = pa.schema([(f, {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary()}[t]) for f, t in (x.split() for x in PARTS.split(", "))])


def _range(rows: pa.Table, edge: pa.Table) -> pa.Table:
    of = list(zip(rows.column("key").to_pylist(), rows.column("conv_id").to_pylist(), rows.column("chars").to_pylist(), strict=True))
    if not of:
        return _SCHEMA.empty_table()
    part, before, after = (edge.column(c)[0].as_py() for c in ("part", "before", "after"))
    columns = list(zip(*range_nodes(of, before, after, part), strict=True))
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, _SCHEMA, strict=True)], schema=_SCHEMA)


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of nodes' ids from sorted chunks, one chunk at a time."""
    node, state = None, None
    for batch in batches:
        done: list[tuple[bytes, str]] = []
        for at, ids in zip(batch.column("node").to_pylist(), batch.column("ids").to_pylist(), strict=True):
            if at != node:
                if state is not None:
                    done.append((node, state.hexdigest()))
                node, state = at, hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in done], pa.binary()), pa.array([x[1] for x in done])], names=["node", "ends"])
    if state is not None:
        yield pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([state.hexdigest()])], names=["node", "ends"])


def trie(chats: DataFrame, range_bytes: int = RANGE_BYTES, range_rows: int = RANGE_ROWS) -> DataFrame:
    """One row for each node of the trie of ``chats`` (conv_id, turns: array of (print, chars)): ``NODE``.

    A node of depth d is a distinct sequence of d turns that conversations begin with, the root that of none; members are
    all conversations that begin with it. conv_id: the smallest member's; parent_conv_id: the parent's conv_id (root: null);
    n_convs, n_children, n_leaves; saved_tokens: over the subtree, the characters of each node's last turn times its members
    but one; ends_sha256: of the ids of the conversations that end in the node, in order. One row a conv_id is expected.
    Without conversations there are no rows. A node's ids are hashed one after another by one task, a chunk at a time.
    """
    spark = chats.sparkSession
    turns = lambda f: F.transform("turns", f)
    rows = written(chats.select("conv_id", F.unhex(F.array_join(turns(lambda t: t["print"]), "")).alias("key"), turns(lambda t: t["chars"]).alias("chars")), "trie-keys")
    size, count = rows.agg(F.coalesce(F.sum(F.length("key")), F.lit(0)), F.count("*")).first()
    if not count:
        return spark.createDataFrame([], "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string")
    parts = max(min(shuffle_partitions(spark), count), math.ceil(size / range_bytes), math.ceil(count / range_rows))
    ranges = written(rows.repartitionByRange(parts, "key", "conv_id").withColumn("part", F.spark_partition_id()), "trie-ranges")
    order = Window.orderBy("part")  # a row for each range
    edges = ranges.groupBy("part").agg(F.min("key").alias("first"), F.max("key").alias("last"))
    edges = edges.select("part", F.lag("last").over(order).alias("before"), F.lead("first").over(order).alias("after"))
    nodes = written(ranges.groupBy("part").cogroup(edges.groupBy("part")).applyInArrow(_range, PARTS), "trie-nodes")

    pieces = nodes.where("kind = 2").select("node", "part", "chunk", "ids").repartition("node").sortWithinPartitions("node", "part", "chunk")
    ends = pieces.select("node", "ids").mapInArrow(tidy(_ends), "node binary, ends string")
    shared = nodes.where("kind = 1").groupBy("node", "depth").agg(F.min("conv_id").alias("conv_id"), *[F.sum(c).alias(c) for c in NODE[3:7]], F.max("parent").alias("parent"))
    shared = written(shared.join(ends, "node", "left").withColumn("ends_sha256", F.coalesce("ends", F.lit(NOTHING))).drop("ends"), "trie-shared")

    below = nodes.where("kind = 0 and parent is not null").select(*[c for c in NODE if c != "parent_conv_id"], "parent").unionByName(shared.where("depth > 0").drop("node"))
    above = shared.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"), F.col("n_children").alias("__n"))
    named = with_hot_keys(below, above, ["parent"], "__n", nodes.where("kind < 2").count())
    root = shared.where("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("long"))
    return nodes.where("kind = 0 and parent is null").select(NODE).unionByName(named.select(NODE)).unionByName(root.select(NODE))
