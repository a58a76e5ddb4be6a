"""Hard negatives by threshold joins with an inverted index that leaves out what bounds cover.

Scores are integer inner products. For a threshold, a row's last components whose norm times an anchor's norm there stays
below it can't make a result alone, so the index of a block of rows leaves them out: its posting list of a dimension holds
the rows that need it. A block of anchors adds up partial scores along the lists, drops rows whose partial score plus the
product of the remaining norms stays below every threshold, and only for pairs that may still reach theirs the components
left out are added. Anchors start at a high threshold, and those whose windows aren't full come again with a lower one, at
last with the window's own end. Dimensions go by their energy over all rows, so the norms that remain shrink soon.

Rows and anchors meet in blocks of both, so a task holds a bounded number of either, and of a block each window gets no
more than it asks for: nothing grows with the number of copies or with the rows above a threshold.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

#: Rows of a block, anchors of a block and of a step within it, dimensions of a step.
BLOCK, ANCHORS, STEP, DIMENSIONS = 32_768, 32_768, 64, 16
#: Thresholds of the rounds: shares of the product of the anchor's norm and the largest norm, then the window's own end.
POSITIVE_SHARES = (0.6, 0.35)
#: The same for negatives: shares of the positive's score.
NEGATIVE_SHARES = (0.93,)
_LEAST, _MOST = -(1 << 62), 1 << 62
#: Sums of squares up to this are exact as doubles; beyond, scores are added up as 64-bit integers.
_EXACT = float(1 << 52)


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, x: array<long>) of ``vectors`` (vec_id, embedding, label): without null ids and labels, and vectors that are null, empty or hold null or non-finite components.

    Components become floor(256 * x), x as double, within 64 bits. Of several rows with one vec_id the smallest vector and
    label stays; of vectors of several lengths shorter ones count as if zeros followed.
    """
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("e"), "label")
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size("e") > 0) & F.forall("e", finite))
    rows = rows.groupBy("vec_id").agg(F.min(F.struct("e", "label")).alias("r"))
    return rows.select("vec_id", F.col("r.label").alias("label"), F.transform("r.e", lambda x: F.floor(x * 256.0).cast("long")).alias("x"))


def _matrix(column: pa.ChunkedArray, order: np.ndarray) -> np.ndarray:
    """Vectors as rows of doubles, or of integers where doubles aren't exact, dimensions in ``order``; zeros behind short ones."""
    column = column.combine_chunks()
    offsets = np.asarray(column.offsets)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    width, size = len(order), np.diff(offsets)
    if (size == width).all():
        return flat.reshape(len(size), width)[:, order]
    out = np.zeros((len(size), width), np.int64)
    out[np.arange(width) < size[:, None]] = flat
    return out[:, order]


def _tails(x: np.ndarray) -> np.ndarray:
    """The norm of each row from each dimension on; a last column of zeros."""
    squares = x.astype(np.float64) ** 2
    return np.sqrt(np.concatenate([np.cumsum(squares[:, ::-1], 1)[:, ::-1], np.zeros((len(x), 1))], 1))


class BlockIndex:
    """An inverted index of a block of rows for thresholds: posting lists of the dimensions, longest first, without what bounds cover."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray) -> None:
        self.ids, self.labels, self.x, self.tails = ids, labels, x, _tails(x)

    def pairs(self, a: np.ndarray, tails: np.ndarray, least: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(anchor, row, score) of all pairs that are ``wanted`` and score ``least`` of their anchor or more."""
        width, whole, least = self.x.shape[1], least, least.astype(np.float64)
        slack = 1e-9 * float(tails[:, 0].max(initial=0)) * float(self.tails[:, 0].max(initial=0)) + 1e-6  # rounding of the norms
        # the first dimension, a step's multiple, from which on a row can't reach the least threshold of these anchors alone
        steps = np.arange(0, width + DIMENSIONS, DIMENSIONS).clip(max=width)
        covered = self.tails[:, steps] * tails[:, steps].max(0, initial=0) + slack < least.min(initial=np.inf)
        upto = np.where(covered.any(1), steps[covered.argmax(1)], width)
        rows = np.argsort(-upto, kind="stable")  # so a dimension's posting list is the rows up to some place
        rows = rows[upto[rows] > 0]
        sums = np.zeros((len(a), len(rows)), self.x.dtype)
        for at in range(0, width, DIMENSIONS):
            part = slice(at, min(at + DIMENSIONS, width))
            listed = int(np.searchsorted(-upto[rows], -at, "left"))  # of the rows in order of upto, those above it
            if not listed:
                break
            sums[:, :listed] += a[:, part] @ self.x[rows[:listed], part].T
            if part.stop < width:
                may = (sums + tails[:, part.stop : part.stop + 1] * np.maximum(self.tails[rows, part.stop], 0) + slack >= least[:, None]).any(0)
                # rows whose list has ended are bounded by what they left out
                ended = upto[rows] <= part.stop
                if ended.any():
                    bound = sums[:, ended] + tails[:, upto[rows[ended]]] * self.tails[rows[ended], upto[rows[ended]]]
                    may[ended] = (bound + slack >= least[:, None]).any(0)
                rows, sums = rows[may], sums[:, may]
        left = upto[rows]
        bound = sums + tails[:, left] * self.tails[rows, left] + slack
        i, j = np.nonzero((bound >= least[:, None]) & wanted[:, rows])
        score = sums[i, j].astype(np.int64)
        short = np.flatnonzero(left[j] < width)
        for k in np.array_split(short, max(1, len(short) // 65_536)):  # components that the index left out
            rest = np.arange(width) >= left[j[k]][:, None]
            score[k] += (a[i[k]] * self.x[rows[j[k]]] * rest).sum(1).astype(np.int64)
        good = score >= whole[i]
        return i[good], rows[j[good]], score[good]


def _search(same: bool, count: int, order: np.ndarray, exact: bool):
    """A function of a block of rows and a block of anchors with windows: each window's first ``count`` rows there."""

    def task(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[list] = [[], [], [], []]
        if left.num_rows and right.num_rows:
            kind = np.float64 if exact else np.int64
            x, a = (_matrix(t.column("x"), order).astype(kind) for t in (left, right))
            index = BlockIndex(left.column("vec_id").to_numpy(), left.column("label").to_numpy(), x)
            ids, labels, windows = right.column("anchor_id").to_numpy(), right.column("label").to_numpy(), right.column("windows").to_pylist()
            for at in range(0, len(ids), STEP):
                part = slice(at, at + STEP)
                least = np.array([min(w["least"] for w in ws) for ws in windows[part]], np.int64)
                wanted = labels[part, None] == index.labels
                wanted = wanted & (ids[part, None] != index.ids) if same else ~wanted
                i, j, score = index.pairs(a[part], _tails(a[part]), least, wanted)
                best = np.lexsort((index.ids[j], -score, i))
                i, j, score = i[best], index.ids[j[best]], score[best]
                starts = np.searchsorted(i, np.arange(len(least) + 1))
                for k, ws in enumerate(windows[part]):
                    own = slice(starts[k], starts[k + 1])
                    for w in ws:
                        first = starts[k] + np.searchsorted(-score[own], -w["most"], "left")
                        end = starts[k] + np.searchsorted(-score[own], -w["least"], "right")
                        for r in range(first, min(end, first + count)):
                            for column, value in zip(out, (ids[at + k], w["positive_id"], j[r], score[r]), strict=True):
                                column.append(value)
        return pa.table([pa.array(c, pa.int64()) for c in out], names=["anchor_id", "positive_id", "vec_id", "score"])

    return task


def _rounds(rows: DataFrame, windows: DataFrame, shares: tuple[float, ...], same: bool, count: int, order: np.ndarray, exact: bool, blocks: int, anchor_blocks: int, tag: str) -> DataFrame:
    """(anchor_id, positive_id, vec_id, score, rank): the first ``count`` rows of each of ``windows`` (anchor_id, label, x, positive_id, high, least, most, wish).

    Scores count from ``least`` to ``most``. A round's threshold is ``share`` of ``high``, if that is more than ``least``,
    which the last round takes. A window whose ``wish`` is met, or whose threshold was its end, is done.
    """
    done, order_by = [], Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("score"), "vec_id")
    blocked = rows.withColumns({"i": F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int"), "j": F.explode(F.sequence(F.lit(0), F.lit(anchor_blocks - 1)))})
    for at, share in enumerate([*shares, None]):
        low = F.col("least") if share is None else F.greatest("least", F.floor(F.col("high") * share).cast("long"))
        now = windows.withColumn("now", low)
        asked = now.groupBy("anchor_id").agg(F.first("label").alias("label"), F.first("x").alias("x"), F.collect_list(F.struct("positive_id", F.col("now").alias("least"), "most")).alias("windows"))  # a few windows an anchor
        asked = asked.withColumns({"j": F.pmod(F.xxhash64("anchor_id"), F.lit(anchor_blocks)).cast("int"), "i": F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))})
        met = blocked.groupBy("i", "j").cogroup(asked.groupBy("i", "j")).applyInArrow(_search(same, count, order, exact), "anchor_id long, positive_id long, vec_id long, score long")
        found = written(met.withColumn("rank", F.row_number().over(order_by)).where(F.col("rank") <= count), f"{tag}-{at}")
        if share is None:
            return _all([*done, found])
        full = found.groupBy("anchor_id", "positive_id").agg(F.count("*").alias("__n"))
        state = now.join(full, ["anchor_id", "positive_id"], "left").withColumn("__done", (F.coalesce("__n", F.lit(0)) >= F.col("wish")) | (F.col("now") <= F.col("least")))
        state = written(state, f"{tag}-windows-{at}")
        done.append(found.join(state.where("__done").select("anchor_id", "positive_id"), ["anchor_id", "positive_id"], "left_semi"))
        windows = state.where("not __done").drop("now", "__n", "__done")
        if windows.isEmpty():
            break
    return _all(done)


def _all(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def mine(vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100, block: int = BLOCK, anchor_block: int = ANCHORS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score for anchors among ``vectors`` (``usable`` rows: vec_id, label, x).

    An anchor's positives are the first ``positives`` other rows of its label by score, ties by smaller vec_id, all if
    fewer; a positive's hard negatives the first ``negatives`` rows of other labels with ``low`` * positive_score <=
    100 * negative_score <= ``high`` * positive_score. Every row counts, whatever the number of copies or ties; a
    positive score below 0 has no window where ``low`` is below ``high``. Null results of ``is_anchor`` are no anchors.
    Without anchors, or with one label, no rows.
    """
    rows = written(vectors.select("vec_id", "label", "x"), "negatives-rows")
    square = F.aggregate("x", F.lit(0.0), lambda s, v: s + v.cast("double") * v.cast("double"))
    total, width, most = rows.agg(F.count("*"), F.max(F.size("x")), F.max(square)).first()
    if not total:
        return rows.select(*[F.lit(0).cast(t).alias(c) for c, t in (("anchor_id", "long"), ("positive_id", "long"), ("rank", "int"), ("negative_id", "long"), ("positive_score", "long"), ("negative_score", "long"))]).limit(0)
    # a sum for each dimension, over all rows
    energy = np.zeros(width)
    for r in rows.select(F.posexplode("x")).groupBy("pos").agg(F.sum(F.col("col").cast("double") * F.col("col")).alias("e")).collect():
        energy[r.pos] = r.e
    order, exact, norm = np.argsort(-energy, kind="stable"), most <= _EXACT, most**0.5
    anchors = rows.where(is_anchor)
    n_anchors = anchors.count()
    blocks, anchor_blocks = max(1, -(-total // block)), max(1, -(-n_anchors // anchor_block))
    of_label = rows.groupBy("label").agg(F.count("*").alias("__of_label"))
    wish = F.least(F.lit(positives), F.col("__of_label") - 1)
    ceiling = F.ceil(F.sqrt(square) * norm).cast("long")
    first = anchors.join(of_label, "label").select(F.col("vec_id").alias("anchor_id"), "label", "x", F.lit(0).cast("long").alias("positive_id"), ceiling.alias("high"), F.lit(_LEAST).alias("least"), F.lit(_MOST).alias("most"), wish.alias("wish"))
    options = (order, exact, blocks, anchor_blocks)
    found = written(_rounds(rows, first, POSITIVE_SHARES, True, positives, *options, "negatives-positives"), "negatives-positives")
    pos = found.select("anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    whole = lambda share, up: (F.floor if not up else F.ceil)(F.col("positive_score").cast("decimal(20,0)") * share / F.lit(100).cast("decimal(3,0)")).cast("long")
    windows = pos.join(anchors.select(F.col("vec_id").alias("anchor_id"), "label", "x"), "anchor_id")
    windows = windows.select("anchor_id", "label", "x", "positive_id", F.col("positive_score").alias("high"), whole(low, True).alias("least"), whole(high, False).alias("most"), F.lit(negatives).alias("wish")).where("least <= most")
    hard = _rounds(rows, windows, NEGATIVE_SHARES, False, negatives, *options, "negatives-hard")
    return hard.join(pos, ["anchor_id", "positive_id"]).select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
