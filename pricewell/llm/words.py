"""Array views of whole text columns: bytes, word spans, word hashes, window minimisers.

A word is a run of bytes other than space and 9 to 13; these are single bytes in UTF-8, so spans are
found on the bytes of a column without decoding. Hashes only choose and bring together; what is
decided rests on the words themselves.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Bytes of text handled at once; bounds the arrays of a task (about 40 bytes each).
SLICE_BYTES = 1 << 20

_SEP = np.zeros(256, bool)
_SEP[[9, 10, 11, 12, 13, 32]] = True
_P = np.uint64(0x9E3779B97F4A7C15)
_POWERS: dict[str, np.ndarray] = {}


def slices(batch: pa.RecordBatch, column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Pieces of a batch with about ``most`` bytes of ``column``; a longer text stays whole."""
    _, off = text_bytes(batch.column(column))
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(off, off[at] + most, "right")) - 1)
        yield batch.slice(at, to - at)
        at = to


def text_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null is an empty text."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("" if not pa.types.is_binary(col.type) else b"")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    _, off, data = col.buffers()
    n = len(col)
    o = np.frombuffer(off, np.int64 if wide else np.int32)[col.offset:col.offset + n + 1].astype(np.int64) if n else np.zeros(1, np.int64)
    if data is None or not n:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    return np.frombuffer(data, np.uint8)[o[0]:o[-1]], o - o[0]


def word_spans(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first): byte spans of all words, and each text's first word, with the end."""
    inside = ~_SEP[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[off] = True
    begin = inside.copy()
    begin[1:] &= ~inside[:-1] | edge[1:-1]
    end = inside.copy()
    end[:-1] &= ~inside[1:] | edge[1:-1]
    starts = np.flatnonzero(begin)
    return starts, np.flatnonzero(end) + 1, np.searchsorted(starts, off)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get("up", ())) < n:
        size = max(n, SLICE_BYTES + (1 << 17))
        back = np.uint64(pow(int(_P), -1, 1 << 64))
        for name, base in (("up", _P), ("down", back)):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            _POWERS[name] = np.multiply.accumulate(p)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word: differences of prefix sums of byte times power."""
    up, down = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    sums[1:] = data
    sums[1:] += np.uint64(1)
    sums[1:] *= up[:-1]
    np.cumsum(sums, out=sums)
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def rolling(h: np.ndarray, m: int) -> np.ndarray:
    """A hash of each run of ``m`` word hashes (len(h) - m + 1 of them)."""
    n = len(h) - m + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = h[:n].copy()
    for j in range(1, m):
        out *= _P
        out += h[j:j + n]
    return mix(out)


def sliding_argmin(h: np.ndarray, w: int) -> np.ndarray:
    """Position of the first smallest of each ``w`` neighbours (len(h) - w + 1 of them)."""
    pos, size = np.arange(len(h)), 1

    def lower(p: np.ndarray, q: np.ndarray) -> np.ndarray:
        return np.where(h[q] < h[p], q, p)

    while size * 2 <= w:
        pos = lower(pos[:-size], pos[size:])
        size *= 2
    if size < w:
        d = w - size
        pos = lower(pos[:-d], pos[d:])
    return pos
