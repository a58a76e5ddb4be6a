"""Hierarchical packing of tokenised documents into windows of several lengths.

Each task packs the documents it reads, so texts and ids never cross the network. A document's full 2048-token windows
stand alone. What is left of it goes to the tier of the smallest power of two that holds it. Tiers are packed from the
longest: an item opens a window of its tier, and the gap is filled from shorter tiers, the last filler being cut to fit,
its rest going back to the tier of its new length. What remains at a task's end is laid end to end and cut at powers of
two. So every window is full. Windows of one length form step groups of equally many tokens.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .bytewords import LOWER, same_spans, slices, span_hashes, tidy

WINDOW = 2048
#: Tiers of windows that take remainders; shorter remainders only fill gaps.
SHORTEST = 256
#: Tokens of a step group.
STEP_TOKENS = 32_768
#: The id after each document.
END_ID = 1
#: Distinct words whose ids a Python worker remembers.
CACHE = 400_000
#: Bytes of words after which it forgets them all.
CACHE_BYTES = 16 << 20

SCHEMA = T.StructType([T.StructField(n, T.LongType()) for n in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "window", "step_group")])

# Classes of bytes of texts whose letters are a-z and U+00C0 to U+00FF.
_SPACE, _LETTER, _DIGIT, _OTHER, _FOREIGN = range(5)
_CLASS = np.full(256, _OTHER, np.uint8)
_CLASS[[9, 10, 11, 12, 13, 32]] = _SPACE
_CLASS[48:58] = _DIGIT
_CLASS[97:123] = _CLASS[65:91] = _LETTER
_CLASS[128:] = _FOREIGN
_CLASS[[39, 0xC3]] = _FOREIGN, _LETTER  # ' starts contractions


class WordIds:
    """Ids of whole texts, equal to the tokenizer's own, from the ids of distinct words.

    The vocabulary's pre-tokens are runs of letters, single digits and runs of other signs, in lower case; each ends with an
    id of a word end. Texts with other letters than U+00C0 to U+00FF, apostrophes or special tokens go to the tokenizer as
    they are, and so do texts with a word whose hash is that of another word: words are compared by their bytes.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocab = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for w, i in vocab.items() if w.endswith("</w>")]] = True
        self.clear()

    def clear(self) -> None:
        self.hashes, self.ids, self.data = np.zeros(0, np.uint64), np.zeros(0, np.uint32), np.zeros(0, np.uint8)
        #: Of each word: where its ids stand and how many they are, and where its bytes stand.
        self.at, self.n, self.start, self.end = (np.zeros(0, np.int64) for _ in range(4))

    def _learn(self, data: np.ndarray, hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        if len(self.hashes) + len(hashes) > CACHE or len(self.data) > CACHE_BYTES:
            self.clear()
        raw, words = data.tobytes(), []
        for s, e in zip(starts.tolist(), ends.tolist(), strict=True):
            words.append(raw[s:e])
        texts = [b" ".join(words[i : i + 1000]).decode() for i in range(0, len(words), 1000)]
        found = [np.array(x.ids, np.uint32) for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        ids = np.concatenate([np.zeros(0, np.uint32), *found])
        stops = np.flatnonzero(self.ends[ids]) + 1
        at = np.concatenate([[0], stops])[:-1]
        order = np.argsort(np.concatenate([self.hashes, hashes]), kind="stable")
        self.at = np.concatenate([self.at, at + len(self.ids)])[order]
        self.n = np.concatenate([self.n, stops - at])[order]
        tails = np.cumsum(ends - starts) + len(self.data)
        self.start = np.concatenate([self.start, tails - (ends - starts)])[order]
        self.end = np.concatenate([self.end, tails])[order]
        self.data = np.concatenate([self.data, np.frombuffer(b"".join(words), np.uint8)])
        self.hashes, self.ids = np.concatenate([self.hashes, hashes])[order], np.concatenate([self.ids, ids])

    def _find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(self.hashes, hashes), max(len(self.hashes) - 1, 0))
        return at, (self.hashes[at] == hashes) if len(self.hashes) else np.zeros(len(hashes), bool)

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
        """The ids of each row of one slice."""
        kind, low = _CLASS[data], LOWER[data]
        after = np.flatnonzero(data[:-1] == 0xC3) + 1  # the second byte of U+00C0 to U+00FF
        second = low[after]
        letter = (second != 0x97) & (second != 0xB7)  # not the signs of multiplication and division
        kind[after] = np.where(letter, _LETTER, _OTHER)
        kind[after - 1] = kind[after]
        low[after] = np.where(letter & (second < 0x9F), second + 32, second)
        special = np.zeros(len(data), bool)
        special[:-1] = (data[:-1] == 60) & (data[1:] == 124)
        foreign = np.zeros(len(data) + 1, np.int64)
        np.cumsum((kind == _FOREIGN) | special, out=foreign[1:])
        plain = foreign[offsets[1:]] == foreign[offsets[:-1]]

        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        start = np.ones(len(data), bool)
        start[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT) | edge[1:-1]
        start = np.flatnonzero(start)
        end = np.append(start[1:], len(data)) if len(start) else start
        word = kind[start] != _SPACE
        start, end = start[word], end[word]
        first = np.searchsorted(start, offsets, "left")
        row_plain = np.repeat(plain, np.diff(first))
        start, end = start[row_plain], end[row_plain]
        first = np.concatenate([[0], np.cumsum(np.where(plain, np.diff(first), 0))])

        hashes, at, which = np.unique(span_hashes(low, start, end), return_index=True, return_inverse=True)
        place, known = self._find(hashes)
        if not known.all():
            new = at[~known]
            self._learn(low, hashes[~known], start[new], end[new])
            place, known = self._find(hashes)
            if not known.all():  # the memory was full and is now empty of the others
                self._learn(low, hashes[~known], start[at[~known]], end[at[~known]])
                place, known = self._find(hashes)
        place = place[which]
        odd = ~same_spans(low, start, end, self.data, self.start[place], self.end[place])
        if odd.any():
            plain[np.searchsorted(first, np.flatnonzero(odd), "right") - 1] = False
        n = self.n[place]
        stops = np.concatenate([[0], np.cumsum(n)])
        ids = self.ids[np.repeat(self.at[place] - stops[:-1], n) + np.arange(stops[-1])]
        bounds, out = stops[first].tolist(), []
        for i, good in enumerate(plain.tolist()):
            if good:
                out.append(ids[bounds[i] : bounds[i + 1]])
            else:
                text = data[offsets[i] : offsets[i + 1]].tobytes().decode()
                out.append(np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32))
        return out


_tokenizers: dict[str, WordIds] = {}


def tokenizer(path: str) -> WordIds:
    """A worker keeps its tokenizers and their memory between tasks."""
    if path not in _tokenizers:
        _tokenizers[path] = WordIds(path)
    return _tokenizers[path]


class Packer:
    """Windows from items (row, start, length), in the order of arrival."""

    def __init__(self, window: int, shortest: int) -> None:
        self.window, self.tiers = window, {}
        while shortest < window:
            self.tiers[shortest] = []
            shortest *= 2
        self.tiers[window] = []
        self.sizes = sorted(self.tiers)

    def add(self, row: int, length: int) -> Iterator[list[tuple[int, int, int]]]:
        for start in range(0, length - self.window + 1, self.window):
            yield [(row, start, self.window)]
        if length % self.window:
            self._route((row, length - length % self.window, length % self.window))

    def _route(self, item: tuple[int, int, int]) -> None:
        self.tiers[next(t for t in self.sizes if item[2] <= t)].append(item)

    def pack(self) -> Iterator[list[tuple[int, int, int]]]:
        """Full windows from each tier, the longest first; an item whose gap can't be filled yet stays."""
        for tier in reversed(self.sizes):
            shorter = [t for t in reversed(self.sizes) if t < tier] or [tier]
            left = sum(x[2] for t in self.sizes if t <= tier for x in self.tiers[t])
            while self.tiers[tier] and left >= tier:
                left -= tier
                window = [self.tiers[tier].pop()]
                gap = tier - window[0][2]
                while gap:
                    source = next((t for t in shorter if self.tiers[t]), tier)
                    row, start, length = self.tiers[source].pop()
                    taken = min(length, gap)
                    window.append((row, start, taken))
                    gap -= taken
                    if taken < length:
                        self._route((row, start + taken, length - taken))
                yield window

    def rest(self) -> Iterator[list[tuple[int, int, int]]]:
        """All that is left, end to end, cut at the powers of two of its length."""
        items = [x for t in reversed(self.sizes) for x in self.tiers[t]]
        left = sum(x[2] for x in items)
        while left:
            size = min(self.window, 1 << (left.bit_length() - 1))
            left, window = left - size, []
            while size:
                row, start, length = items.pop()
                taken = min(length, size)
                window.append((row, start, taken))
                size -= taken
                if taken < length:
                    items.append((row, start + taken, length - taken))
            yield window
        for t in self.sizes:
            self.tiers[t] = []


def pack(docs: DataFrame, tokenizer_path: str, window: int = WINDOW, shortest: int = SHORTEST, step_tokens: int = STEP_TOKENS, end_id: int = END_ID) -> DataFrame:
    """One row for each piece of each row of ``docs`` (doc_id, text): doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, window, step_group.

    Every id of every text, with ``end_id`` after it, lies in exactly one piece; a null or empty text has that id alone, so
    each row has a piece. Repeated rows are packed each. ``sequence_id`` holds the task's number and a counter, ``window``
    the sequence's length, a power of two up to the window; ``step_group`` sequences of one window and task with
    ``step_tokens`` tokens together (the last of a kind may hold less). A task that is run again gives the same rows. A
    task holds one Arrow batch, and less than a window of each tier's items besides.
    """
    if window & (window - 1) or shortest & (shortest - 1) or shortest > window:
        raise ValueError("windows are powers of two, the shortest not above the longest")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of, packer = tokenizer(tokenizer_path), Packer(window, shortest)
        base = TaskContext.get().partitionId() << 36
        made, rows, next_row, by_window = 0, {}, 0, {}

        def out(windows: Iterator[list[tuple[int, int, int]]]) -> Iterator[pa.RecordBatch]:
            nonlocal made
            columns: list[list] = [[] for _ in SCHEMA]
            for pieces in windows:
                size, offset = sum(p[2] for p in pieces), 0
                nth = by_window[size] = by_window.get(size, -1) + 1
                step = base | (size.bit_length() << 30) | (nth * size // step_tokens)
                for row, start, length in pieces:
                    doc, ids = rows[row]
                    for column, value in zip(columns, (doc, start, length, zlib.crc32(ids[start : start + length]), len(ids), base | made, offset, size, step), strict=True):
                        column.append(value)
                    offset += length
                made += 1
            if columns[0]:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=SCHEMA.names)

        for batch in batches:
            docs_of = batch.column(0).to_pylist()
            for first, data, offsets in slices(batch.column(1)):
                full = []
                for i, ids in enumerate(ids_of(data, offsets)):
                    rows[next_row] = (docs_of[first + i], np.append(ids, end_id).astype("<u4"))
                    full += packer.add(next_row, len(ids) + 1)
                    next_row += 1
                yield from out(iter(full))
                yield from out(packer.pack())
                waiting = {x[0] for t in packer.tiers.values() for x in t}
                rows = {k: v for k, v in rows.items() if k in waiting}
        yield from out(packer.rest())

    return docs.select("doc_id", "text").mapInArrow(tidy(task), SCHEMA)
