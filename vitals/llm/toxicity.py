"""Toxicity by a counterfactual-regularised classifier.

A logistic regression over the distinct words of a text and the beginnings of its longer words, so that inflected and
compounded forms count. For each labelled sentence with an identity term, the term is
swapped for others of its kind and for a neutral word; the squared change of the sentence's score, by the words and
their beginnings that go and come, is penalised, so a mere mention of a group moves no score. Copies of one text share one
unit of weight, so a labelling slip on a much copied text teaches nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bytewords import IS_ALNUM, LOWER, alnum_words, mixed, runs, slices, span_hashes, tidy, word_hash
from .common import free_name, written

#: Labelled rows that the classifier is fitted on, at most: those of the smallest hash of their doc_id.
SAMPLE = 6000
#: Bytes of the beginnings of words that are features besides whole words.
PREFIXES = (4, 5, 6, 7)
THRESHOLD = 0.7
#: A text's whole weight in sums of whole numbers, which are the same in any order.
UNIT = 1 << 20
#: Identity terms by kind.
IDENTITY = (
    ("women", "men", "girls", "boys", "transgender"),
    ("woman", "man", "girl", "boy"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "african", "latino", "hispanic", "arab"),
    ("gay", "lesbian", "straight", "bisexual", "queer"),
    ("old", "young", "elderly"),
    ("blind", "deaf", "disabled"),
    ("american", "mexican", "chinese", "german", "french", "spanish", "indian", "russian"),
    ("immigrants", "refugees", "foreigners", "citizens"),
)
#: Stands for no group at all.
NEUTRAL = "people"


def _features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words and of the beginnings of longer words of a slice, and the row of each."""
    starts, ends, first = runs(IS_ALNUM[LOWER[data]], offsets)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    longer = [np.flatnonzero(ends - starts > k) for k in PREFIXES]
    return _features_of(data, starts, ends), np.concatenate([row, *[row[x] for x in longer]])


def _features_of(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the words, then of the beginnings of longer words, at these places of a slice."""
    longer = [np.flatnonzero(ends - starts > k) for k in PREFIXES]
    heads = np.concatenate([starts, *[starts[x] for x in longer]])
    tails = np.concatenate([ends, *[starts[x] + k for x, k in zip(longer, PREFIXES, strict=True)]])
    return span_hashes(LOWER[data], heads, tails)


@dataclass(frozen=True)
class Model:
    """``words``: sorted hashes; ``weights`` of them."""

    words: np.ndarray
    weights: np.ndarray
    bias: float

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """The score of each row of a slice."""
        hashes, row = _features(data, offsets)
        total = np.full(len(offsets) - 1, self.bias)
        if len(self.words) and len(hashes):
            at = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
            found = np.flatnonzero(self.words[at] == hashes)
            pairs = np.unique(row[found] * len(self.words) + at[found])
            total += np.bincount(pairs // len(self.words), self.weights[pairs % len(self.words)], len(total))
        return 1 / (1 + np.exp(-total))


def held_out(doc_id: Column) -> Column:
    """True where crc32 of the doc_id as text leaves 1 by 3; a null doc_id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 3 == 1


def _swaps() -> dict[int, list[int]]:
    neutral = word_hash(NEUTRAL)
    return {word_hash(w): [word_hash(x) for x in kind if x != w] + [neutral] for kind in IDENTITY for w in kind}


def _parts(word: str) -> list[int]:
    """The features of one word: itself and its beginnings."""
    return [word_hash(word), *[word_hash(word[:k]) for k in PREFIXES if len(word) > k]]


def _parts_of_terms() -> dict[int, list[int]]:
    return {word_hash(w): _parts(w) for w in (*[w for kind in IDENTITY for w in kind], NEUTRAL)}


def _featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Label, distinct features, four least hashes of 3-word runs, and (term, swapped term, mask) of each sentence that has one.

    The mask has a bit for each feature of the term and, from bit 8, of the swapped term that no other word of the sentence has.
    """
    swaps, parts = _swaps(), _parts_of_terms()
    terms = np.array(sorted(swaps), np.uint64)
    for batch in batches:
        toxic, out = batch.column(1).to_pylist(), []
        for at, data, offsets in slices(batch.column(0)):
            hashes, starts, ends, first = alnum_words(data, offsets)
            features, of = _features(data, offsets)
            order = np.argsort(of, kind="stable")
            features, edges = features[order], np.searchsorted(of[order], np.arange(len(offsets)))
            sentence = np.cumsum(np.isin(data, np.frombuffer(b".!?\n", np.uint8)))
            for i in range(len(offsets) - 1):
                words = hashes[first[i] : first[i + 1]]
                marks = words[:-2] + np.uint64(3) * words[1:-1] + np.uint64(5) * words[2:] if len(words) > 2 else words
                least = [int(mixed(marks * np.uint64(2 * k + 1)).min()) for k in range(1, 5)] if len(marks) else []
                pairs, swapped = [], {}
                for j in np.flatnonzero(np.isin(words, terms)).tolist():
                    term, at_sentence = int(words[j]), int(sentence[starts[first[i] + j]])
                    if (term, at_sentence) not in swapped:
                        same = np.flatnonzero(sentence[starts[first[i] : first[i + 1]]] == at_sentence)
                        rest = first[i] + same[words[same] != words[j]]
                        low, high = (starts[rest[0]], ends[rest[-1]]) if len(rest) else (0, 0)
                        others = set(_features_of(data[low:high], starts[rest] - low, ends[rest] - low).tolist())
                        alone = lambda x, bit: sum(1 << bit + k for k, f in enumerate(parts[x]) if f not in others)  # noqa: B023, E731
                        swapped[term, at_sentence] = [(term, x, alone(term, 0) | alone(x, 8)) for x in swaps[term] if not (words[same] == np.uint64(x)).any()]
                    pairs += swapped[term, at_sentence]
                out.append((toxic[at + i], np.unique(features[edges[i] : edges[i + 1]]).tobytes(), np.array(least, np.uint64).tobytes(), np.array(pairs, np.uint64).tobytes()))
        yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int32()), *[pa.array([x[k] for x in out], pa.binary()) for k in (1, 2, 3)]], names=["toxic", "words", "least", "pairs"])


def _families(least: list[np.ndarray]) -> np.ndarray:
    """The size of each text's family: texts that share one of their four least hashes."""
    root = list(range(len(least)))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    seen: dict[tuple[int, int], int] = {}
    for i, marks in enumerate(least):
        for key in enumerate(marks.tolist()):
            root[find(i)] = find(seen.setdefault(key, i))
    of = np.array([find(i) for i in range(len(least))])
    return np.bincount(of)[of] if len(of) else np.ones(0)


def _counter(worth_of: dict[bytes, float]):
    """(word, worth, toxic) of batches (toxic, least, words): what the texts with a feature weigh, and the toxic ones, in whole units."""
    units = {x: round(w * UNIT) for x, w in worth_of.items()}

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [np.frombuffer(x, np.int64) for x in batch.column(2).to_pylist()]
            if not words:
                continue
            weight = np.array([units[x] for x in batch.column(1).to_pylist()], np.int64)
            toxic = weight * (batch.column(0).to_numpy() > 0)
            n = list(map(len, words))
            word, at = np.unique(np.concatenate(words), return_inverse=True)
            sums = [np.bincount(at, np.repeat(x, n), len(word)).astype(np.int64) for x in (weight, toxic)]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (word, *sums)], names=["word", "worth", "toxic"])

    return task


def _pair_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(term, other, mask, n): how often each kind of swap occurs."""
    for batch in batches:
        pairs = np.concatenate([np.zeros(0, np.int64), *[np.frombuffer(x, np.int64) for x in batch.column(0).to_pylist()]]).reshape(-1, 3)
        kinds, n = np.unique(pairs, axis=0, return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (*np.ascontiguousarray(kinds.T), n)], names=["term", "other", "mask", "n"])


def _places_in(chosen: np.ndarray):
    """(toxic, least, places) of batches (toxic, least, words): where the features of a text that are ``chosen`` stand there."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = []
            for words in batch.column(2).to_pylist():
                words = np.frombuffer(words, np.uint64)
                at = np.minimum(np.searchsorted(chosen, words), max(0, len(chosen) - 1))
                places.append((at[chosen[at] == words] if len(chosen) else at[:0]).astype(np.int32).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(places, pa.binary())], names=["toxic", "least", "places"])

    return task


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, swap_penalty: float = 10.0, ridge: float = 0.02, support: float = 4.0, chi: float = 16.0) -> Model:
    """A model from ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic), without the held-out ones.

    At most ``sample`` labelled rows are used, whatever the number of labels and of rows of a doc_id; only their labels and
    the places of the features that the model keeps come to the driver. Null labels don't count; of several labels of a doc_id the largest holds. Without labels of both kinds, all texts get
    the labels' mean.
    """
    chosen = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    # one row for each doc_id and text, and of these too those of the smallest hashes, so a repeated doc_id brings no more
    named = docs.select("doc_id", F.xxhash64("text").alias("hash"), "text").join(F.broadcast(chosen), "doc_id")
    keys = named.select("doc_id", "hash").distinct().orderBy(F.xxhash64("doc_id", "hash"), "doc_id", "hash").limit(sample)
    texts = named.join(F.broadcast(keys), ["doc_id", "hash"]).groupBy("doc_id", "hash").agg(F.max("toxic").alias("toxic"), F.min("text").alias("text"))
    rows = written(texts.select("text", "toxic").mapInArrow(tidy(_featurise), "toxic int, words binary, least binary, pairs binary"), "labelled")

    # the driver holds the labels, four hashes of each text, and what the following aggregates leave
    marks = rows.select(F.least(F.greatest("toxic", F.lit(0)), F.lit(1)).cast("double"), "least").toArrow()
    labels_of, least = marks.column(0).to_numpy(), marks.column(1).to_pylist()
    if not 0 < labels_of.sum() < len(labels_of):
        rate = (labels_of.sum() + 1) / (len(labels_of) + 2)
        return Model(np.zeros(0, np.uint64), np.zeros(0), float(np.log(rate / (1 - rate))))
    worth_of = dict(zip(least, 1 / _families([np.frombuffer(x, np.uint64) for x in least]), strict=True))
    all_worth = np.array([worth_of[x] for x in least])
    n1, n = float(np.sort(all_worth * labels_of).sum()), float(np.sort(all_worth).sum())

    # features that go with the label
    with_word, toxic_word = F.col("worth") / UNIT, F.col("toxic") / UNIT
    expected = with_word * n1 / n
    stat = F.pow(toxic_word - expected, 2) / (expected * (1 - n1 / n) * F.greatest(F.lit(1e-9), 1 - with_word / n) + 1e-9)
    totals = rows.select("toxic", "least", "words").mapInArrow(tidy(_counter(worth_of)), "word long, worth long, toxic long").groupBy("word").agg(F.sum("worth").alias("worth"), F.sum("toxic").alias("toxic"))
    going = totals.where((with_word >= support) & (stat >= chi)).select("word").toArrow().column(0).to_numpy().view(np.uint64)
    kinds = rows.select("pairs").mapInArrow(tidy(_pair_counts), "term long, other long, mask long, n long").groupBy("term", "other", "mask").agg(F.sum("n").alias("n")).toArrow()
    often = kinds.column(3).to_numpy()
    kinds = np.stack([kinds.column(i).to_numpy().view(np.uint64) for i in range(3)], 1)
    order = np.lexsort(kinds.T)
    kinds, often = kinds[order], often[order]
    chosen_words = np.union1d(going, kinds[:, :2].ravel())
    k = len(chosen_words)

    # the texts in these features alone
    found = rows.select("toxic", "least", "words").mapInArrow(tidy(_places_in(chosen_words)), "toxic int, least binary, places binary").toArrow().to_pylist()
    found.sort(key=lambda r: (r["least"], r["places"], r["toxic"]))
    y = np.array([min(1, max(0, r["toxic"])) for r in found], float)
    worth = np.array([worth_of[r["least"]] for r in found])
    lists = [np.frombuffer(r["places"], np.int32) for r in found]
    row = np.repeat(np.arange(len(lists)), list(map(len, lists)))
    col = np.concatenate(lists)

    # each kind of swap: how often it occurs, and the features of the model that it removes and adds
    parts, entries = _parts_of_terms(), []
    for i, (term, other, mask) in enumerate(kinds.tolist()):
        entries += [(i, f, sign) for x, at, sign in ((term, 0, -1.0), (other, 8, 1.0)) for bit, f in enumerate(parts[x]) if mask >> at + bit & 1]
    swap, changed, sign = np.array([e[0] for e in entries], int), np.array([e[1] for e in entries], np.uint64), np.array([e[2] for e in entries])
    held = np.isin(changed, chosen_words)
    swap, sign, changed = swap[held], sign[held], np.searchsorted(chosen_words, changed[held])
    size = np.bincount(swap, minlength=len(kinds))

    # gradient steps with momentum on the weighted mean loss, the ridge and the swaps' squared score changes
    w, bias = np.zeros(k), float(np.log(n1 / (n - n1)))
    step_w, step_b = np.zeros(k), 0.0
    curve = 0.25 * np.bincount(col, worth[row], k) / n + ridge / n + swap_penalty * np.bincount(changed, (often * size)[swap], k) / n
    width = max(1.0, float(np.bincount(row, minlength=len(y)).max()) ** 0.5)
    for _ in range(3000):
        p = 1 / (1 + np.exp(-(bias + np.bincount(row, w[col], len(y)))))
        miss = worth * (p - y) / n
        change = swap_penalty * often * np.bincount(swap, sign * w[changed], len(kinds)) / n
        grad = np.bincount(col, miss[row], k) + ridge * w / n + np.bincount(changed, sign * change[swap], k)
        step_w, step_b = 0.9 * step_w - 0.1 * grad / (curve * width), 0.9 * step_b - 0.1 * 4 * miss.sum() / width
        w, bias = w + step_w, bias + step_b
    return Model(chosen_words, w, float(bias))


def scored(docs: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """``docs`` with a column ``name``: the score from 0 to 1 of each whole text; a null text scores as an empty one."""
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())])
    text, names = docs.columns.index("text"), [*docs.columns, name]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [model.scores(data, offsets) for _, data, offsets in slices(batch.column(text))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate([np.zeros(0), *values]))], names=names)

    return docs.mapInArrow(tidy(task), schema)


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **options) -> DataFrame:
    """doc_id, held_out, score, predicted: one row for each row of ``docs``, repeated ones too. An empty table gives no rows."""
    rows = scored(docs.select("doc_id", "text"), fit(docs, labels, **options))
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **options) -> DataFrame:
    """The rows of ``docs`` that score below the threshold, with all their columns."""
    score = free_name(docs, "__score")
    return scored(docs, fit(docs, labels, **options), score).where(F.col(score) < threshold).drop(score)
