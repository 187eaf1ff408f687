"""Words, shingles and their 64-bit hashes over many texts at once, as numpy arrays.

Words are maximal runs of bytes other than space and \\t \\n \\v \\f \\r; none crosses from one text to the next.
"""

from __future__ import annotations

import numpy as np

U = np.uint64
#: Two primes and a base for each: hashes modulo a prime have no texts that collide whatever the base, as those modulo 2^64 do.
_PRIMES = (2147483647, 2147483629)
_BASES = (1103515245, 1812433253)
_powers = [np.ones(1, U), np.ones(1, U)]
_inverses = [np.ones(1, U), np.ones(1, U)]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: equal inputs stay equal, different ones scatter."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _geometric(base: int, prime: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo a prime."""
    out = np.ones(1, U)
    while len(out) < n:
        out = np.concatenate([out, out * U(pow(base, len(out), prime)) % U(prime)])
    return out[:n]


def _upto(n: int) -> None:
    if len(_powers[0]) < n:
        n = max(n, 1 << 18) + 1
        for i, (base, prime) in enumerate(zip(_BASES, _PRIMES, strict=True)):
            _powers[i] = _geometric(base, prime, n)
            _inverses[i] = _geometric(pow(base, -1, prime), prime, n)


def span_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, limit: int = 1 << 18) -> np.ndarray:
    """A 62-bit polynomial hash, mixed, of the bytes of each span; equal bytes give equal hashes wherever they stand. Starts
    rise. Long input is taken about ``limit`` bytes at a time."""
    if len(raw) <= limit:
        return _span_hashes(raw, starts, ends)
    out, i = np.empty(len(starts), U), 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(starts, starts[i] + limit)))
        low = starts[i]
        out[i:j] = _span_hashes(raw[low : ends[i:j].max()], starts[i:j] - low, ends[i:j] - low)
        i = j
    return out


def _span_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    n = len(raw)
    _upto(n + 1)
    symbols, sums, parts = raw.astype(U) + U(1), np.zeros(n + 1, U), []
    for power, inverse, prime in zip(_powers, _inverses, map(U, _PRIMES), strict=True):
        terms = symbols * power[:n]  # below 2^40, so that a sum of 2^20 fits
        np.cumsum(terms if n <= 1 << 20 else terms % prime, out=sums[1:])
        parts.append((sums[ends] - sums[starts]) % prime * inverse[starts] % prime)
    return mix((parts[0] << U(31) | parts[1]) + mix((ends - starts).astype(U)))


def is_space(raw: np.ndarray) -> np.ndarray:
    return (raw == 32) | ((raw >= 9) & (raw <= 13))


def words(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and for each text the number of words before it (one more entry at the end)."""
    inside = ~is_space(raw)
    edge = np.zeros(len(raw) + 1, bool)
    edge[offsets] = True
    first = inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def grams(hashes: np.ndarray, bounds: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of k neighbouring words of one text; the index of the first word of each, and bounds by text."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, U), np.zeros(0, np.int64), np.zeros(len(bounds), np.int64)
    acc = hashes[:n].copy()
    for j in range(1, k):
        acc = mix(acc) + hashes[j : j + n]
    left = np.repeat(bounds[1:], np.diff(bounds))[:n] - np.arange(n)
    at = np.flatnonzero(left >= k)
    return mix(acc[at]), at, np.searchsorted(at, bounds)


def shingles(raw: np.ndarray, offsets: np.ndarray, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the k-word shingles of each text in order, and bounds. A text of 1 to k - 1 words has one shingle, all its
    words; a text without words has none."""
    starts, ends, bounds = words(raw, offsets)
    h = span_hashes(raw, starts, ends)
    got, _, at = grams(h, bounds, k)
    n = np.diff(bounds)
    short = np.flatnonzero((n > 0) & (n < k))
    if not len(short):
        return got, at
    extra = np.zeros(len(short), U)
    for i, d in enumerate(short):
        acc = h[bounds[d] : bounds[d] + 1]
        for j in range(bounds[d] + 1, bounds[d + 1]):
            acc = mix(acc) + h[j : j + 1]
        extra[i] = mix(acc + U(n[d]))[0]
    sizes = np.diff(at)
    out = np.insert(got, at[short], extra)
    sizes[short] = 1
    return out, np.concatenate([[0], np.cumsum(sizes)])


def occurrences(hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Multisets by text: distinct hashes (sorted in each text), their counts, and bounds."""
    doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    order = np.lexsort((hashes, doc))
    h, d = hashes[order], doc[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
    at = np.flatnonzero(new)
    return h[at], np.diff(np.append(at, len(h))), np.searchsorted(d[at], np.arange(len(bounds)))


def least_of(x: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours."""
    n, have, acc = len(x) - width + 1, 1, x
    while have * 2 <= width:
        acc = np.minimum(acc[:-have], acc[have:])
        have *= 2
    return np.minimum(acc[:n], acc[width - have : width - have + n])
