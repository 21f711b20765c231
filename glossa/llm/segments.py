"""Super-k-mers: runs of consecutive windows that share one minimiser.

A text is a sequence of elements (words or bytes). Every window of ``width``
consecutive elements is represented by its *minimiser*: the gram of ``gram``
elements with the smallest hash inside the window, leftmost on ties.
Consecutive windows with the same minimiser form one super-k-mer. Equal windows
have equal minimisers at equal offsets, so two equal windows always lie in
super-k-mers with the same minimiser.

The functions work on one slice of one text with numpy, inside Spark tasks.
"""

from __future__ import annotations

import numpy as np

# --- fixed values: odd 64-bit multipliers of the hash functions ---------------
MULT_A = 0xBF58476D1CE4E5B9
MULT_B = 0x94D049BB133111EB
BASE = 0x9E3779B97F4A7C15
# ------------------------------------------------------------------------------
SLICE = 1 << 18            # windows handled at once; bounds the memory of one long text
_POS = np.uint64(20)       # low bits of a packed (hash, position) key; positions < 2**20
_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values (a bijection), so that polynomial hashes order randomly."""
    x = (x ^ (x >> _U(30))) * _U(MULT_A)
    x = (x ^ (x >> _U(27))) * _U(MULT_B)
    return x ^ (x >> _U(31))


#: element hash of a byte
BYTE_HASH = mix(np.arange(1, 257, dtype=np.uint64))


def gram_hashes(h: np.ndarray, length: int) -> np.ndarray:
    """Polynomial hash of every run of ``length`` elements, by doubling the run length."""
    whole, have = None, 0
    part, size, mult = h, 1, BASE                # runs of `size` elements, BASE ** size
    while True:
        if length & size:
            if whole is None:
                whole, have = part, size
            else:
                n = len(h) - have - size + 1
                whole = whole[:n] * _U(mult) + part[have:have + n]
                have += size
        if size * 2 > length:
            return whole
        part = part[:-size] * _U(mult) + part[size:]
        mult = mult * mult % (1 << 64)
        size *= 2


def sliding_min(x: np.ndarray, span: int) -> np.ndarray:
    """Minimum of every run of ``span`` values."""
    size = 1
    while size * 2 <= span:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    rest = span - size
    return np.minimum(x[:-rest], x[rest:]) if rest else x


def super_kmers(h: np.ndarray, width: int, gram: int):
    """``(minimiser, content, start, count)`` of the super-k-mers of the elements ``h``.

    ``content`` hashes all elements of the super-k-mer with the place of its
    minimiser; ``start`` is its first window and ``count`` its number of windows.
    """
    n = len(h) - width + 1
    g = mix(gram_hashes(h, gram))
    key = (g >> _POS << _POS) | np.arange(len(g), dtype=np.uint64)
    where = (sliding_min(key, width - gram + 1) & _U((1 << 20) - 1)).astype(np.int64)
    start = np.concatenate((np.zeros(1, np.int64), np.flatnonzero(where[1:] != where[:-1]) + 1))
    count = np.diff(start, append=n)
    at = where[start]
    power, inverse = _powers(len(h))
    prefix = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(h * power, out=prefix[1:])
    body = (prefix[start + count + width - 1] - prefix[start]) * inverse[start]
    shape = ((at - start) << 32 | count).astype(np.uint64)
    return g[at] >> _POS, mix(body ^ mix(shape)), start, count


_TABLES = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int):
    """Powers of BASE and of its inverse modulo 2**64, kept per process."""
    if len(_TABLES[0]) < n:
        for i, base in enumerate((BASE, pow(BASE, -1, 1 << 64))):
            steps = np.full(max(n, 1 << 14), base, np.uint64)
            steps[0] = 1
            _TABLES[i] = np.cumprod(steps)
    return _TABLES[0][:n], _TABLES[1]
