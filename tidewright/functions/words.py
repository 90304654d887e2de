"""Words and shingles of Arrow text columns as 64-bit hashes, in numpy.

A word is a run of bytes other than 0x20 and 0x09-0x0D; A-Z count as a-z. Two
different words get the same hash with a chance of 2**-64 a pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SPACE = np.zeros(256, bool)
SPACE[[0x20, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_RNG = np.random.default_rng(20240607)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = int(_RNG.integers(1, 2**62)) * 8 + 5
_INVERSE = pow(_BASE, -1, 2**64)
_powers: dict[str, np.ndarray] = {}
#: Bytes of text that are hashed at a time; a longer text is hashed alone.
CHUNK_BYTES = 1 << 19


def _power(of: int, n: int) -> np.ndarray:
    key = str(of)
    if key not in _powers or len(_powers[key]) < n:
        size = max(n, CHUNK_BYTES + 1)
        out = np.ones(size, np.uint64)
        out[1:] = np.uint64(of)
        with np.errstate(over="ignore"):
            np.multiply.accumulate(out, out=out)
        if n > 16 * CHUNK_BYTES:  # one very long text; not kept
            return out
        _powers[key] = out
    return _powers[key]


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads each 64-bit value over all bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def chunks(texts: pa.Array, most: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, end row, bytes, offsets)`` of runs of whole texts; nulls are empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    i = 0
    while i < len(texts):
        j = max(i + 1, int(np.searchsorted(at, at[i] + most, "right")) - 1)
        yield i, j, data[at[i] : at[j]], at[i : j + 1] - at[i]
        i = j


def word_spans(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word, and of each text the index of its first word (one more at the end)."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(at), np.int64)
    edge = np.zeros(n + 1, bool)
    edge[at] = True
    word = np.zeros(n + 1, bool)
    word[:n] = ~SPACE[data]
    before = np.zeros(n + 1, bool)
    before[1:] = word[:n]
    start = np.flatnonzero(word & (~before | edge))
    end = np.flatnonzero(before & (~word | edge))
    return start, end, np.searchsorted(start, at)


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    n = len(data)
    total = np.zeros(n + 1, np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum(_BYTE[LOWER[data]] * _power(_BASE, n + 1)[:n], out=total[1:])
        return mix((total[end] - total[start]) * _power(_INVERSE, n + 1)[start] + np.uint64(0x9E3779B97F4A7C15))


def shingle_sets(texts: pa.Array, n: int) -> Iterator[np.ndarray]:
    """For each text the sorted distinct hashes of its ``n``-word shingles; with fewer words, of the whole sequence; without words, nothing."""
    if n < 1:
        raise ValueError("a shingle has at least one word")
    for i, j, data, at in chunks(texts):
        start, end, first = word_spans(data, at)
        h = word_hashes(data, start, end)
        with np.errstate(over="ignore"):
            whole = np.zeros(max(0, len(h) - n + 1), np.uint64)
            for k in range(n):
                whole = whole * np.uint64(0xD6E8FEB86659FD93) + h[k : k + len(whole)]
            whole = mix(whole)
            for row in range(j - i):
                a, b = int(first[row]), int(first[row + 1])
                if b - a >= n:
                    yield np.unique(whole[a : b - n + 1])
                elif b > a:
                    short = np.uint64(b - a)
                    for x in h[a:b]:
                        short = short * np.uint64(0xD6E8FEB86659FD93) + x
                    yield mix(np.array([short], np.uint64))
                else:
                    yield np.zeros(0, np.uint64)
