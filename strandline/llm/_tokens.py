"""Vectorised words, shingles and hashes over Arrow string columns.

A column is cut into chunks of about a megabyte, so memory does not follow the batch; every text stays whole in
one chunk. Hashes are 64 bits and depend on nothing but the text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 20
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x = x * _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def randoms(n: int, seed: int) -> np.ndarray:
    """n fixed pseudo-random 64-bit values."""
    with np.errstate(over="ignore"):
        return mix((np.arange(1, n + 1, dtype=_U) + _U(seed * 0x100000)) * _U(_BASE))


def _tables() -> dict[str, tuple[np.ndarray, np.ndarray]]:
    values = randoms(256, 7) | _U(1)
    upper = np.arange(65, 91)
    values[upper] = values[upper + 32]
    space = np.zeros(256, bool)
    space[[9, 10, 11, 12, 13, 32]] = True
    ascii_word = np.zeros(256, bool)
    ascii_word[48:58] = ascii_word[65:91] = ascii_word[97:123] = ascii_word[128:] = True
    out = {}
    for name, gap in (("space", space), ("alnum", ~ascii_word)):
        v = values.copy()
        v[gap] = 0
        out[name] = (gap, v)
    return out


_TABLE = _tables()
_POW = np.ones(1, _U)
_INV = np.ones(1, _U)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _POW, _INV
    if len(_POW) < n:
        n = max(n, 2 * len(_POW), CHUNK_BYTES)
        base = _BASE | 1
        with np.errstate(over="ignore"):
            _POW = np.cumprod(np.full(n, base, _U), dtype=_U)
            _INV = np.cumprod(np.full(n, pow(base, -1, 1 << 64), _U), dtype=_U)
    return _POW, _INV


@dataclass
class Chunk:
    """Rows ``first`` to ``first + n`` of a column: their bytes, and where each begins."""

    first: int
    n: int
    data: np.ndarray
    offsets: np.ndarray


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """The texts of a column in order; a null is an empty text."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(column):
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    body = column.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body is not None and body.size else np.zeros(0, np.uint8)
    at = 0
    while at < len(column):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        yield Chunk(at, to - at, data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at])
        at = to


@dataclass
class Words:
    """``hash`` of each word, its byte ``start``, and ``bounds``: the words of row i are bounds[i]:bounds[i + 1]."""

    hash: np.ndarray
    start: np.ndarray
    bounds: np.ndarray

    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))


def words(chunk: Chunk, kind: str = "space") -> Words:
    """Words with A-Z lower-cased: runs between ASCII white space, or (``alnum``) runs of letters, digits and non-ASCII."""
    data, offsets = chunk.data, chunk.offsets
    gap_table, values = _TABLE[kind]
    n = len(data)
    if not n:
        return Words(np.zeros(0, _U), np.zeros(0, np.int64), np.zeros(chunk.n + 1, np.int64))
    gap = gap_table[data]
    before = np.empty(n, bool)
    before[0] = True
    before[1:] = gap[:-1]
    heads = offsets[:-1]
    before[heads[heads < n]] = True
    start = np.flatnonzero(before & ~gap)
    bounds = np.searchsorted(start, offsets)
    if not len(start):
        return Words(np.zeros(0, _U), start, bounds)
    power, inverse = _powers(n)
    with np.errstate(over="ignore"):
        hashed = mix(np.add.reduceat(values[data] * power[:n], start) * inverse[start])
    return Words(hashed, start, bounds)


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """A hash of every k consecutive words; ``len(hashes) - k + 1`` of them."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, _U)
    factor = randoms(k, 11) | _U(1)
    with np.errstate(over="ignore"):
        out = hashes[:n] * factor[0]
        for i in range(1, k):
            out += hashes[i : i + n] * factor[i]
        return mix(out)


def run_hash(hashes: np.ndarray) -> np.ndarray:
    """Prefix sums with which ``runs`` hashes any stretch of words in constant time."""
    power, _ = _powers(len(hashes) + 1)
    out = np.zeros(len(hashes) + 1, _U)
    with np.errstate(over="ignore"):
        np.cumsum(hashes * power[: len(hashes)], dtype=_U, out=out[1:])
    return out


def runs(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the word runs start:end."""
    _, inverse = _powers(len(prefix))
    with np.errstate(over="ignore"):
        return mix((prefix[end] - prefix[start]) * inverse[start] + (end - start).astype(_U))
