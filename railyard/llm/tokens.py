"""Vectorised word and shingle hashing over Arrow text columns.

Everything works on the UTF-8 buffer of a whole Arrow column at once, so the
cost per word is a few numpy operations and no Python string is made.  Words
are runs of characters other than the six ASCII white-space characters;
capital A-Z may be lowered.  Hashes are 64 bits wide and fixed (no seed from
the process), so they agree between tasks, retries and runs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Text bytes handled at once; a single longer text is still taken whole.
CHUNK_BYTES = 1 << 21

U64 = np.uint64
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_ROOT = U64(0x9E3779B97F4A7C15 | 5)  # odd, 5 modulo 8: its powers have the largest period
_INVERSE = U64(pow(int(_ROOT), -1, 1 << 64))


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective finaliser (two multiply-xorshift rounds)."""
    x = np.asarray(x, U64)
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


_BYTE = mix64(np.arange(1, 257, dtype=U64) * U64(0xD6E8FEB86659FD93))
_LOWERED = _BYTE[_LOWER]
_powers: list[np.ndarray] = [np.ones(1, U64), np.ones(1, U64)]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, CHUNK_BYTES + 1)
        for i, root in enumerate((_ROOT, _INVERSE)):
            p = np.full(size, root, U64)
            p[0] = 1
            _powers[i] = np.cumprod(p, out=p)
    return _powers[0], _powers[1]


def text_chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, rows, bytes, offsets) for runs of rows of about ``limit``
    bytes; null counts as empty text."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    _, at, data = column.buffers()
    off = np.frombuffer(at, np.int64)[column.offset:column.offset + n + 1] if n else np.zeros(1, np.int64)
    buf = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + limit, side="right")) - 1)
        yield i, j - i, buf[off[i]:off[j]], off[i:j + 1] - off[i]
        i = j


def word_spans(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends (byte positions) of all words, and the number of words
    before each text (one more entry than texts)."""
    if not len(buf):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(off), np.int64)
    word = ~_SPACE[buf]
    edge = np.zeros(len(buf) + 1, bool)
    edge[off] = True
    first = word.copy()
    first[1:] &= ~word[:-1] | edge[1:-1]
    last = word.copy()
    last[:-1] &= ~word[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, off)


def word_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = True) -> np.ndarray:
    """64-bit hash of each word."""
    if not len(starts):
        return np.zeros(0, U64)
    power, inverse = _power_tables(len(buf) + 1)
    total = np.empty(len(buf) + 1, U64)
    total[0] = 0
    np.take(_LOWERED if lower else _BYTE, buf, out=total[1:])
    total[1:] *= power[:len(buf)]
    np.cumsum(total[1:], out=total[1:])
    return mix64((total[ends] - total[starts]) * inverse[starts])


def shingle_sets(words: np.ndarray, at: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of the ``n``-word windows of each text, ascending, and
    the offsets of the texts.  A text of fewer words counts as one window; a
    text without words has none."""
    k = np.diff(at)
    size = np.where(k >= n, k - n + 1, np.minimum(k, 1))
    out = np.concatenate([[0], np.cumsum(size)])
    factor = mix64(np.arange(1, n + 1, dtype=U64) * U64(0xA24BAED4963EE407)) | U64(1)
    h = np.empty(out[-1], U64)
    long = np.flatnonzero(k >= n)
    if len(long):
        m = len(words) - n + 1
        window = words[:m] * factor[0]
        for j in range(1, n):
            window += words[j:m + j] * factor[j]
        # window starts of the long texts, in order
        ok = np.zeros(len(words) + 1, np.int32)
        np.add.at(ok, at[:-1][long], 1)
        np.add.at(ok, at[1:][long] - n + 1, -1)
        take = np.flatnonzero(np.cumsum(ok[:m]) > 0)
        fill = np.zeros(out[-1] + 1, np.int32)
        np.add.at(fill, out[:-1][long], 1)
        np.add.at(fill, out[1:][long], -1)
        h[np.flatnonzero(np.cumsum(fill[:-1]) > 0)] = window[take]
    for d in np.flatnonzero((k > 0) & (k < n)):
        w = words[at[d]:at[d + 1]]
        h[out[d]] = (w * factor[:len(w)]).sum(dtype=U64) + U64(len(w))
    h = mix64(h)
    for s, e in zip(out[:-1], out[1:]):
        if e - s > 1:
            h[s:e].sort()
    keep = np.ones(len(h), bool)
    keep[1:] = h[1:] != h[:-1]
    keep[out[:-1][size > 0]] = True
    before = np.concatenate([[0], np.cumsum(keep)])
    return h[keep], before[out]


def text_shingles(buf: np.ndarray, off: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    starts, ends, at = word_spans(buf, off)
    return shingle_sets(word_hashes(buf, starts, ends), at, n)


def set_keys(h: np.ndarray, at: np.ndarray) -> np.ndarray:
    """64-bit key of each set (sum of remixed members; 0 for the empty set)."""
    total = np.concatenate([np.zeros(1, U64), np.cumsum(mix64(h ^ U64(0x5851F42D4C957F2D)), dtype=U64)])
    key = mix64(total[at[1:]] - total[at[:-1]] + np.diff(at).astype(U64))
    key[np.diff(at) == 0] = 0
    return key
