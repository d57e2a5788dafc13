"""Word shingles of a text as 64-bit hashes, by array operations."""

from __future__ import annotations

import numpy as np

_U = np.uint64


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (multiply and shift rounds)."""
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


#: one odd number per byte value
BYTE_HASH = mix(np.arange(1, 257, dtype=np.uint64) * _U(0x9E3779B97F4A7C15)) | _U(1)
_BASE = 0xD1342543DE82EF95
_INVERSE = pow(_BASE, -1, 1 << 64)
_GAP = np.zeros(256, bool)
_GAP[[9, 10, 11, 12, 13, 32]] = True


class Powers:
    """Powers of the base and of its inverse modulo 2 ** 64, grown on demand."""

    def __init__(self) -> None:
        self.up = np.ones(1, np.uint64)
        self.down = np.ones(1, np.uint64)

    def to(self, n: int) -> None:
        while len(self.up) < n:
            k = len(self.up)
            self.up = np.concatenate([self.up, self.up * _U(pow(_BASE, k, 1 << 64))])
            self.down = np.concatenate([self.down, self.down * _U(pow(_INVERSE, k, 1 << 64))])


POWERS = Powers()


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Running polynomial hash; ``span_hash`` gives any substring's hash from it."""
    POWERS.to(len(data) + 1)
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE_HASH[data] * POWERS.up[:len(data)], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of ``data[start:end]``, the same wherever the bytes stand."""
    return mix((prefix[end] - prefix[start]) * POWERS.down[start] + (end - start).astype(np.uint64))


def shingles(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct hashes of the ``words``-word shingles of a text, A-Z lower-cased.

    Words are runs of ``[^\\x20\\x09-\\x0D]``.  Fewer words than ``words`` make
    one shingle of the whole sequence; no word, none.
    """
    raw = (text or "").encode("utf-8", "surrogatepass").lower()  # bytes.lower: A-Z only
    data = np.frombuffer(raw, np.uint8)
    word = ~_GAP[data]
    if not word.any():
        return np.empty(0, np.uint64)
    edge = np.flatnonzero(np.diff(word, prepend=False, append=False))
    h = span_hash(prefix_hash(data), edge[::2], edge[1::2])
    n = len(h)
    if n < words:
        out = _U(n)
        for x in h:
            out = mix(np.array([out], np.uint64) * _U(0x9E3779B97F4A7C15) + x)[0]
        return np.array([out], np.uint64)
    out = h[:n - words + 1].copy()
    for k in range(1, words):
        out = out * _U(0x9E3779B97F4A7C15) + h[k:n - words + 1 + k]
    return np.unique(mix(out))
