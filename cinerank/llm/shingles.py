"""Word shingles of whole texts as sorted 64-bit hashes, in NumPy.

Words are maximal runs of bytes other than space and \\t..\\r after A-Z are
lower-cased. A text's set holds its distinct `width`-word shingles; with
fewer words the whole sequence counts as one; null, empty or blank texts
have the empty set. Two different shingles get the same hash with
probability 2^-64; a set is identified by its size and 128 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 2 << 20  # texts handled at a time; a longer text is its own slice

_BASE = 0x9E3779B97F4A7C15 | 1
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers.get("up", ())) < n:
        size = max(n, SLICE_BYTES + (1 << 17))
        inverse = pow(_BASE, -1, 1 << 64)
        for name, base in (("up", _BASE), ("down", inverse)):
            p = np.full(size, base, dtype=np.uint64)
            p[0] = 1
            _powers[name] = np.multiply.accumulate(p)
    return _powers["up"], _powers["down"]


def _text_buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    col = pa.compute.fill_null(col.cast(pa.large_string()), "")
    n = len(col)
    _, off, data = col.buffers()
    offsets = np.frombuffer(off, dtype=np.int64)[col.offset:col.offset + n + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    return offsets, raw


def shingle_sets(col: pa.Array, width: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text, in order."""
    offsets, raw = _text_buffers(col)
    n, a = len(offsets) - 1, 0
    while a < n:
        b = int(np.searchsorted(offsets, offsets[a] + SLICE_BYTES, "right")) - 1
        b = min(max(b, a + 1), n)
        yield from _slice_sets(raw[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], width)
        a = b


def _slice_sets(x: np.ndarray, offsets: np.ndarray, width: int) -> Iterator[np.ndarray]:
    docs = len(offsets) - 1
    if not len(x):
        for _ in range(docs):
            yield np.empty(0, np.uint64)
        return
    x = x.copy()
    x[(x >= 65) & (x <= 90)] += 32
    blank = (x == 32) | ((x >= 9) & (x <= 13))
    cut = np.zeros(len(x) + 1, dtype=bool)  # a text starts here
    cut[offsets] = True
    before = np.concatenate(([True], blank[:-1])) | cut[:-1]
    after = np.concatenate((blank[1:], [True])) | cut[1:]
    start, end = np.flatnonzero(~blank & before), np.flatnonzero(~blank & after)
    up, down = _power(len(x))
    total = np.cumsum((x.astype(np.uint64) + np.uint64(1)) * up[:len(x)], dtype=np.uint64)
    word = total[end] - np.where(start > 0, total[start - 1], np.uint64(0))
    word = mix(word * down[start] + (end - start).astype(np.uint64))
    owner = np.searchsorted(offsets, start, "right") - 1
    count = np.bincount(owner, minlength=docs)
    first = np.concatenate(([0], np.cumsum(count)))
    step = np.uint64(0xD6E8FEB86659FD93)

    def chain(at: np.ndarray, k: int) -> np.ndarray:
        h = np.full(len(at), k, dtype=np.uint64)
        for j in range(k):
            h = h * step + word[at + j]
        return mix(h)

    full = chain(np.arange(max(0, len(word) - width + 1)), width)
    for i in range(docs):
        c, f = int(count[i]), int(first[i])
        if c >= width:
            yield np.unique(full[f:f + c - width + 1])
        elif c:
            yield chain(np.array([f]), c)
        else:
            yield np.empty(0, np.uint64)


def set_key(h: np.ndarray) -> tuple[int, int]:
    """128 bits that identify a set, as two signed longs."""
    if not len(h):
        return 0, 0
    a = np.add.reduce(mix(h ^ np.uint64(0x5851F42D4C957F2D)))
    b = np.bitwise_xor.reduce(mix(h + np.uint64(0x14057B7EF767814F)))
    return int(a.astype(np.int64)), int(b.astype(np.int64))
