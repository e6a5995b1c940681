"""Texts as flat byte and word arrays: the vectorised helpers the text operators share.

A batch of texts is one byte buffer with offsets, as Arrow holds it. Words are maximal runs of
bytes other than the six ASCII white-space bytes, so a word never crosses a text, and no
multi-byte character is ever cut. A null text is an empty one.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa

# Work is done on slices of about this many bytes, so memory follows one slice, not the task.
SLICE_BYTES = 1 << 20
_STRETCH = 1 << 18

_U = np.uint64
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_BYTE = np.random.RandomState(20240229).randint(0, 2**63, 256).astype(_U) * _U(2) + _U(1)
_POINT = _U(0x9E3779B97F4A7C15 | 5)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (two multiply-and-shift rounds)."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class _Powers:
    """Powers of an odd base and of its inverse modulo 2**64, grown as needed."""

    def __init__(self, base: int):
        self.base, self.back = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, _U)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            n = max(n, 2 * len(self.up))
            self.up = np.cumprod(np.r_[_U(1), np.full(n - 1, self.base, _U)])
            self.down = np.cumprod(np.r_[_U(1), np.full(n - 1, self.back, _U)])
        return self.up, self.down


_BYTES, _WORDS = _Powers(0xD6E8FEB86659FD95 | 5), _Powers(int(_POINT))


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string array and the offsets of its texts; nulls are empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, where, data = texts.buffers()
    if len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offs = np.frombuffer(where, np.int64 if wide else np.int32)[texts.offset:texts.offset + len(texts) + 1]
    offs = offs.astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offs[0]:offs[-1]], offs - offs[0]


@cache
def _trim():
    try:
        return ctypes.CDLL("libc.so.6").malloc_trim
    except (OSError, AttributeError):  # no glibc, nothing to trim
        return lambda _: 0


def release() -> None:
    """Give memory that is no longer used back to the system: workers outlive their tasks."""
    pa.default_memory_pool().release_unused()
    _trim()(0)


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut so that each has about ``limit`` bytes of text, one text at least. Memory is released at the end."""
    yield from _slices(batches, column, limit)
    release()


def _slices(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        offs = buffers(batch.column(column))[1]
        at = 0
        while at < batch.num_rows:
            upto = max(at + 1, int(np.searchsorted(offs, offs[at] + limit, "right")) - 1)
            yield batch.slice(at, upto - at)
            at = upto


def per_text(run, texts: pa.Array, limit: int = SLICE_BYTES) -> list:
    """``run`` on slices of ``texts`` of about ``limit`` bytes each, and its results in order."""
    whole = pa.RecordBatch.from_arrays([texts], names=["text"])
    out = [run(part.column("text")) for part in slices(iter([whole]), "text", limit)]
    return out


def byte_hashes(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each ``raw[start:end]``; pieces ascend and don't overlap.

    Worked off a stretch of bytes at a time, since sums take 8 bytes for each byte.
    """
    out = np.empty(len(start), _U)
    i = 0
    while i < len(start):
        j = max(i + 1, int(np.searchsorted(end, start[i] + _STRETCH, "right")))
        low, high = start[i], end[j - 1]
        n = int(high - low)
        up, down = _BYTES.upto(n + 1)
        sums = np.zeros(n + 1, _U)
        np.cumsum(_BYTE[raw[low:high]] * up[:n], out=sums[1:])
        a, b = start[i:j] - low, end[i:j] - low
        out[i:j] = (sums[b] - sums[a]) * down[a] + (b - a).astype(_U) * _POINT
        i = j
    return mix(out)


def runs(raw: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each piece between two cuts."""
    return byte_hashes(raw, cuts[:-1], cuts[1:])


class Words:
    """The words of a batch: ``start``/``end`` byte positions, and ``of[d]:of[d+1]`` for text d.
    ``gaps`` marks the bytes that stand between words, white space if not given."""

    def __init__(self, texts: pa.Array, lower: bool = False, gaps: np.ndarray = _SPACE):
        raw, self.offs = buffers(texts)
        self.raw = _LOWER[raw] if lower else raw
        n = len(raw)
        solid = ~gaps[raw]
        before = np.zeros(n, bool)
        before[1:] = solid[:-1]
        cuts = self.offs[:-1]
        before[cuts[cuts < n]] = False
        self.start = np.flatnonzero(solid & ~before)
        after = np.zeros(n, bool)
        after[:-1] = solid[1:]
        ends = self.offs[1:] - 1
        after[ends[ends >= 0]] = False
        self.end = np.flatnonzero(solid & ~after) + 1
        self.of = np.searchsorted(self.start, self.offs)
        self.count = np.diff(self.of)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of every word."""
        return byte_hashes(self.raw, self.start, self.end)


def windows(hashes: np.ndarray, of: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``k`` consecutive words inside one text, and each run's first word.

    Two windows get the same hash when their word hashes are the same, in order (64 bits).
    """
    n = len(hashes)
    if n < k:
        return np.zeros(0, _U), np.zeros(0, np.int64)
    up, down = _WORDS.upto(n + 1)
    sums = np.zeros(n + 1, _U)
    np.cumsum(hashes * up[:n], out=sums[1:])
    left = np.repeat(of[1:], np.diff(of)) - np.arange(n)
    at = np.flatnonzero(left >= k)
    return mix((sums[at + k] - sums[at]) * down[at] + _U(k)), at


def shingles(words: Words, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of every text, ascending: values and ``of[d]:of[d+1]`` bounds.

    A text with fewer than ``k`` words has its whole sequence as the only shingle; one without
    words has none.
    """
    hashes, of = words.hashes(), words.of
    got, at = windows(hashes, of, k)
    doc = np.searchsorted(of, at, "right") - 1
    short = np.flatnonzero((words.count > 0) & (words.count < k))
    if len(short):
        whole = np.zeros(len(short), _U)
        up, _ = _WORDS.upto(k + 1)
        for j in range(k - 1):
            has = words.count[short] > j
            whole[has] += hashes[of[short[has]] + j] * up[j]
        got = np.r_[got, mix(whole + words.count[short].astype(_U))]
        doc = np.r_[doc, short]
    order = np.lexsort((got, doc))
    got, doc = got[order], doc[order]
    new = np.ones(len(got), bool)
    new[1:] = (got[1:] != got[:-1]) | (doc[1:] != doc[:-1])
    got, doc = got[new], doc[new]
    return got, np.searchsorted(doc, np.arange(len(words.count) + 1))


def spans(lengths: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Indices ``starts[i] .. starts[i] + lengths[i] - 1`` of all i, one after the other."""
    ends = np.cumsum(lengths)
    if not len(ends) or not ends[-1]:
        return np.zeros(0, np.int64)
    return np.repeat(starts - np.r_[0, ends[:-1]], lengths) + np.arange(ends[-1])


def packed(values: np.ndarray, of: np.ndarray) -> pa.Array:
    """One binary value per text: ``values[of[d]:of[d+1]]`` as little-endian bytes."""
    size = values.dtype.itemsize
    data = np.ascontiguousarray(values).tobytes()
    bounds = np.asarray(of, np.int64) * size
    return pa.Array.from_buffers(pa.large_binary(), len(of) - 1,
                                 [None, pa.py_buffer(bounds.tobytes()), pa.py_buffer(data)]).cast(pa.binary())
