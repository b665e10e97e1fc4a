"""Numpy kernels over a batch of texts held as one flat byte array.

A batch never becomes Python strings word by word: words are byte ranges of one buffer, and
hashes of words and of word windows come from prefix sums modulo 2**64. A window that starts at
word ``i`` hashes to ``(S[i + n] - S[i]) * q**-i``, so every window costs the same few vector
operations whatever its length.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Text bytes handled at a time; a single longer document is handled alone and whole.
CHUNK_BYTES = 1 << 18

#: Bytes that separate words: 0x20 and 0x09-0x0D.
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True

_U = np.uint64
_BYTE_BASE, _WORD_BASE = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """``base**0 .. base**(n-1)`` modulo 2**64, kept for the next batch."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        steps = np.full(max(n, CHUNK_BYTES), base, _U)
        steps[0] = 1
        have = _powers[base] = np.cumprod(steps)
    return have[:n]


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose high and low bits both depend on all bits."""
    h = h ^ (h >> _U(31))
    h *= _U(0x7FB5D329728EA185)
    h ^= h >> _U(27)
    h *= _U(0x81DADEF4BC2DD44D)
    h ^= h >> _U(33)
    return h


def range_hashes(values: np.ndarray, start: np.ndarray, end: np.ndarray, base: int) -> np.ndarray:
    """Hash of ``values[s:e]`` for each pair of bounds."""
    total = np.zeros(len(values) + 1, _U)
    np.cumsum((values.astype(_U) + _U(1)) * powers(base, len(values)), out=total[1:])
    inverse = powers(pow(base, -1, 1 << 64), len(values) + 1)
    return mixed((total[end] - total[start]) * inverse[start])


@dataclass
class Words:
    """Words of a batch. ``buf`` holds every word followed by one space; word ``i`` is
    ``buf[start[i]:end[i]]`` and belongs to document ``doc[i]``; ``first[d]`` is the first word of
    document ``d`` and ``first[d + 1]`` the end of it."""

    buf: np.ndarray
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    first: np.ndarray

    def hashes(self) -> np.ndarray:
        return range_hashes(self.buf, self.start, self.end, _BYTE_BASE)


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts, offsets); null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    array = pc.fill_null(texts.cast(pa.large_binary()), b"")
    if not len(array):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(array.buffers()[1], np.int64)[array.offset : array.offset + len(array) + 1]
    data = array.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def words_of(texts: pa.Array, lower: bool = False, breaks: np.ndarray = IS_SPACE) -> Words:
    """All words of a batch, the runs of bytes that ``breaks`` has not; ``lower`` maps A-Z to a-z and nothing else."""
    raw, off = flat(texts)
    if lower and len(raw):
        raw = np.where((raw >= 65) & (raw <= 90), raw + np.uint8(32), raw)
    inside = ~breaks[raw]
    fresh = np.zeros(len(raw) + 1, bool)
    fresh[off] = True
    before = np.concatenate([[False], inside[:-1]]) & ~fresh[:-1] if len(raw) else inside
    after = np.concatenate([inside[1:], [False]]) & ~fresh[1:] if len(raw) else inside
    raw_start = np.flatnonzero(inside & ~before)
    raw_end = np.flatnonzero(inside & ~after) + 1
    size = raw_end - raw_start
    end = np.cumsum(size + 1) - 1
    buf = np.full(int(end[-1]) + 1 if len(end) else 0, 32, np.uint8)
    filled = np.ones(len(buf), bool)
    filled[end] = False
    buf[filled] = raw[inside]
    first = np.searchsorted(raw_start, off)
    doc = np.repeat(np.arange(len(off) - 1), np.diff(first))
    return Words(buf, end - size, end, doc, first)


def window_hashes(word_hash: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of ``n`` words, ``len - n + 1`` of them (runs over a document's end included)."""
    count = len(word_hash) - n + 1
    if count <= 0:
        return np.zeros(0, _U)
    at = np.arange(count)
    return range_hashes(word_hash, at, at + n, _WORD_BASE)


def slices(batch: pa.RecordBatch, column: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of at most ``limit`` bytes of ``column`` (one row at least)."""
    size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    total = np.concatenate([[0], np.cumsum(size, dtype=np.int64)])
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(total, total[at] + limit, "right")) - 1)
        yield batch.slice(at, to - at)
        at = to
    pa.default_memory_pool().release_unused()


def spread(offsets: np.ndarray, values: np.ndarray, picks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Concatenation of the lists ``values[offsets[p]:offsets[p + 1]]`` for p in ``picks``, and their sizes."""
    size = np.diff(offsets)[picks]
    total = np.cumsum(size)
    if not len(total) or not total[-1]:
        return values[:0], size
    step = np.ones(int(total[-1]), np.int64)
    begin, kept = offsets[:-1][picks][size > 0], size[size > 0]
    step[0] = begin[0]
    step[np.cumsum(kept)[:-1]] = begin[1:] - (begin[:-1] + kept[:-1] - 1)
    return values[np.cumsum(step)], size
