"""Word shingles of texts as 64-bit hashes, whole columns at a time."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from tabforge.llm.common import keeps

SEGMENT = 1 << 20       # bytes hashed at once; bounds the temporaries
_ODD = np.uint64(0x9E3779B97F4A7C15)

# A random 64-bit number per byte; A-Z count as a-z.
_BYTE = np.random.default_rng(20240501).integers(1, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE[65:91] = _BYTE[97:123]
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_powers: dict[str, np.ndarray] = {}
keeps(_powers.clear, __name__, "tabforge.llm.minhash")


def _power(inverse: bool, n: int) -> np.ndarray:
    name = "inverse" if inverse else "plain"
    if name not in _powers or len(_powers[name]) < n:
        base = pow(int(_ODD), -1, 1 << 64) if inverse else int(_ODD)
        p = np.full(max(n, SEGMENT), base, np.uint64)
        p[0] = 1
        _powers[name] = np.multiply.accumulate(p)
    return _powers[name][:n]


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xA0761D6478BD642F)
    return h ^ (h >> np.uint64(32))


def _words(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of consecutive texts in ``data`` and each word's text
    (``starts`` are the texts' first bytes)."""
    n = len(data)
    word = ~_SPACE[data]
    edge = np.zeros(n + 1, bool)
    edge[starts[starts < n]] = True
    edge[n] = True
    first = word & (edge[:n] | ~np.r_[False, word[:-1]])
    last = word & (edge[1:] | ~np.r_[word[1:], False])
    a, b = np.flatnonzero(first), np.flatnonzero(last) + 1
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[data] * _power(False, n), out=sums[1:])
    h = (sums[b] - sums[a]) * _power(True, n)[a] + (b - a).astype(np.uint64)
    return mix(h), np.searchsorted(starts, a, "right") - 1


def _long_text(data: np.ndarray) -> np.ndarray:
    """Word hashes of one text longer than a segment, cut at white space.  A
    word that alone exceeds a segment is hashed as a whole."""
    out, at, n = [], 0, len(data)
    zero = np.zeros(1, np.int64)
    while at < n:
        end = min(at + SEGMENT, n)
        if end < n and not _SPACE[data[end]]:
            space = np.flatnonzero(_SPACE[data[at:end]])
            if len(space):
                end = at + int(space[-1]) + 1
            else:
                rest = np.flatnonzero(_SPACE[data[end:]])
                end = end + int(rest[0]) if len(rest) else n
                text = data[at:end].tobytes().lower()   # bytes.lower: A-Z only
                out.append(np.frombuffer(hashlib.blake2b(text, digest_size=8).digest(), "<u8").astype(np.uint64))
                at = end
                continue
        out.append(_words(data[at:end], zero)[0])
        at = end
    return np.concatenate(out) if out else np.empty(0, np.uint64)


def _sets(words: np.ndarray, text: np.ndarray, n: int, k: int) -> Iterator[np.ndarray]:
    """Sorted distinct k-word shingles of texts 0..n-1."""
    bounds = np.searchsorted(text, np.arange(n + 1))
    rolled = np.zeros(max(0, len(words) - k + 1), np.uint64)
    for i in range(k):
        rolled += words[i:len(words) - k + 1 + i] * _power(False, k + 2)[i + 1]
    rolled = mix(rolled + np.uint64(k)) if len(rolled) else rolled
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if b - a >= k:
            yield np.unique(rolled[a:b - k + 1])
        elif b > a:     # fewer words than k: the sequence as one
            part = words[a:b] * _power(False, k + 2)[1:b - a + 1]
            yield mix(part.sum(dtype=np.uint64, keepdims=True) + np.uint64(b - a))
        else:
            yield np.empty(0, np.uint64)


def shingle_sets(column: pa.Array, k: int) -> Iterator[np.ndarray]:
    """For each text of a string column, the sorted distinct hashes of its
    k-word shingles (one for all words if there are fewer; none without a
    word or for null).  Words are runs without ASCII white space, A-Z as
    a-z."""
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    i, n = 0, len(column)
    while i < n:
        j = max(i + 1, int(np.searchsorted(at, at[i] + SEGMENT, "right")) - 1)
        j = min(j, n)
        part = data[at[i]:at[j]]
        if len(part) > SEGMENT:
            words = _long_text(part)
            yield from _sets(words, np.zeros(len(words), np.int64), 1, k)
        elif len(part) == 0:
            for _ in range(j - i):
                yield np.empty(0, np.uint64)
        else:
            words, text = _words(part, at[i:j] - at[i])
            yield from _sets(words, text, j - i, k)
        i = j
