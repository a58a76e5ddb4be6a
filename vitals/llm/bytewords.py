"""Words and their 64-bit hashes for a batch of UTF-8 texts at once, with numpy on Arrow's buffers."""

from __future__ import annotations

import ctypes
import functools
import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

_U = np.uint64
#: ASCII white space of the query contracts.
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[32, 9, 10, 11, 12, 13]] = True
#: Bytes with A-Z made lower case.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


Task = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def tidy(task: Task) -> Task:
    """``task``, after which its worker gives the memory that it has freed back to the system: workers wait for more tasks beside the JVM."""

    @functools.wraps(task)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from task(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # not in every C library
            if trim is not None:
                trim(0)

    return run


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (the splitmix64 finaliser)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_STEP = _U(0x9E3779B97F4A7C15)
#: Bytes from which a span is hashed by itself.
LONG = 256


def _loads(data: np.ndarray) -> np.ndarray:
    """The eight bytes at each place of ``data`` as one integer, zeros behind the end."""
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = data
    return np.ndarray(len(data) + 1, np.dtype("<u8"), padded, strides=(1,))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of data[start:end] for each span.

    Eight bytes at a time are mixed into a state that begins with seed and length, so spans of one length up to eight
    bytes never collide, and no algebraic structure of longer ones makes them collide. Long spans are hashed one by one.
    """
    if not len(starts):
        return np.zeros(0, _U)
    size, loads = ends - starts, _loads(data)
    with np.errstate(over="ignore"):
        out = mixed((size.astype(_U) + _U(seed & 0xFFFFFFFF) * _U(1 << 32)) * _STEP + _STEP)
        active, at = np.flatnonzero((size > 0) & (size < LONG)), 0
        while len(active):
            left = size[active] - at
            word = loads[starts[active] + at]
            part = np.flatnonzero(left < 8)
            word[part] &= (_U(1) << (left[part].astype(_U) * _U(8))) - _U(1)
            out[active] = mixed(out[active] * _STEP + word)
            active, at = active[left > 8], at + 8
    key = seed.to_bytes(8, "little")
    for i in np.flatnonzero(size >= LONG).tolist():
        out[i] = int.from_bytes(hashlib.blake2b(data[starts[i] : ends[i]].tobytes(), digest_size=8, key=key).digest(), "little")
    return out


def same_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, others: np.ndarray, other_starts: np.ndarray, other_ends: np.ndarray) -> np.ndarray:
    """Whether each span of ``data`` has the bytes of the span of ``others`` in the same place of the lists."""
    size = ends - starts
    out = size == other_ends - other_starts
    here, there = _loads(data), _loads(others)
    active, at = np.flatnonzero(out & (size > 0) & (size < LONG)), 0
    while len(active):
        left = size[active] - at
        differ = here[starts[active] + at] ^ there[other_starts[active] + at]
        part = np.flatnonzero(left < 8)
        differ[part] &= (_U(1) << (left[part].astype(_U) * _U(8))) - _U(1)
        out[active[differ != 0]] = False
        active, at = active[(left > 8) & (differ == 0)], at + 8
    for i in np.flatnonzero(out & (size >= LONG)).tolist():
        out[i] = bool((data[starts[i] : ends[i]] == others[other_starts[i] : other_ends[i]]).all())
    return out


def slices(texts: pa.Array, rows: int = 2000, size: int = 1_000_000) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) for runs of rows of about ``size`` bytes, a longer text alone; nulls are empty."""
    texts = texts.cast(pa.large_string()).fill_null("")
    n = len(texts)
    if not n:
        return
    offsets = np.frombuffer(texts.buffers()[1], np.int64, n + 1, texts.offset * 8)
    data = np.frombuffer(texts.buffers()[2], np.uint8) if texts.buffers()[2] else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = min(first + rows, n, max(first + 1, int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1))
        yield first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def runs(member: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and per-row offsets of the maximal runs of member bytes that don't cross a row's edge."""
    n = len(member)
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before, after = np.zeros(n, bool), np.zeros(n, bool)
    before[1:], after[:-1] = member[:-1], member[1:]
    starts = np.flatnonzero(member & (~before | edge[:-1]))
    ends = np.flatnonzero(member & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets, "left")


#: Bytes of words of letters and digits: everything but ASCII signs and controls.
IS_ALNUM = np.ones(256, bool)
IS_ALNUM[:48] = IS_ALNUM[58:65] = IS_ALNUM[91:97] = IS_ALNUM[123:128] = False


def alnum_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes, starts, ends and per-row offsets of the words of letters and digits, A-Z in lower case."""
    low = LOWER[data]
    starts, ends, first = runs(IS_ALNUM[low], offsets)
    return span_hashes(low, starts, ends), starts, ends, first


def word_hash(word: str) -> int:
    """The hash that ``alnum_words`` gives a word."""
    data = LOWER[np.frombuffer(word.encode(), np.uint8)]
    return int(span_hashes(data, np.array([0]), np.array([len(data)]))[0])
