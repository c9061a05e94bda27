"""Sites as bits, 64 to a word: packing, whole rows, and counts of all pairs of two blocks of rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import BinaryType, StructField, StructType

#: Rows of the first block that meet the second at a time.
STRIP_ROWS = 16

_CODE = np.full(256, -1, np.int8)
for _letters in (b"AGCT", b"agct"):
    _CODE[np.frombuffer(_letters, np.uint8)] = np.arange(4)  # the second bit tells purines from pyrimidines


def codes(seq: str | None) -> np.ndarray:
    """A plain base's number, small letters included; -1 for other sites."""
    return _CODE[np.frombuffer((seq or "").encode("latin-1", "replace"), np.uint8)]


def packed(code: np.ndarray) -> bytes:
    """Sites 64 at a time: which are plain, and the two bits of the base."""
    return _packed(code >= 0, code)


def _packed(known: np.ndarray, code: np.ndarray) -> bytes:
    words, plain = max(1, -(-len(code) // 64)), code >= 0
    bits = np.zeros((3, words * 64), np.uint8)
    bits[0, : len(code)] = known
    bits[1, : len(code)] = (code & 1) * plain
    bits[2, : len(code)] = (code >> 1 & 1) * plain
    return np.packbits(bits.reshape(3, words, 64).transpose(1, 0, 2), axis=2).tobytes()


def known_sites(seq: str | None, letters: str) -> tuple[np.ndarray, np.ndarray]:
    """A row's words of ``packed``, and by word which sites have one of ``letters``."""
    code = codes(seq)
    place = np.zeros(256, bool)
    place[np.frombuffer(letters.encode(), np.uint8)] = True
    known = place[np.frombuffer((seq or "").encode("latin-1", "replace"), np.uint8)]
    words = lambda x: np.frombuffer(x, np.uint64).reshape(-1, 3)
    return words(packed(code)), words(_packed(known, code))[:, 0]


def whole_rows(seqs: DataFrame) -> DataFrame:
    """The columns of ``seqs`` with ``whole``, all sites as bits, in place of ``q``."""
    others = [f for f in seqs.schema.fields if f.name != "q"]

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches:
            yield pa.RecordBatch.from_arrays([*(t[n] for n in names), pa.array([packed(codes(q)) for q in t["q"].to_pylist()], pa.binary())], names=[*names, "whole"])

    names = [f.name for f in others]
    return seqs.select(*names, "q").mapInArrow(make, StructType([*others, StructField("whole", BinaryType())]))


def strips(one: list[np.ndarray], two: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Places in both lists, and for each two of them the sites that both know and those of both plain that differ.

    Rows are words of ``known, plain, low, high``. A few rows meet all others, word by word; rows stand by length, so that a
    word is read only for rows that have it.
    """
    flat, starts, order, left = zip(*(_by_length(x) for x in (one, two)), strict=True)
    for at in range(0, len(one), STRIP_ROWS):
        rows = slice(at, min(len(one), at + STRIP_ROWS))
        both, differ = np.zeros((rows.stop - at, len(two)), np.int32), np.zeros((rows.stop - at, len(two)), np.int32)
        for w in range(min(int(left[0][at]), len(wide := _prefixes(left[1])))):
            nr, nc = int((left[0][rows] > w).sum()), int(wide[w])
            a, b = flat[0][starts[0][at : at + nr] + w].T[:, :, None], flat[1][starts[1][:nc] + w].T[:, None]
            both[:nr, :nc] += np.bitwise_count(a[0] & b[0])
            bits = a[2] ^ b[2]
            bits |= a[3] ^ b[3]
            bits &= b[1]
            bits &= a[1]
            differ[:nr, :nc] += np.bitwise_count(bits)
        yield order[0][rows], order[1], both, differ


def _by_length(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    length = np.array([len(x) for x in rows], np.int64)
    order = np.argsort(-length, kind="stable")
    flat = np.concatenate([rows[i] for i in order]) if len(rows) else np.zeros((0, 4), np.uint64)
    return flat, np.cumsum(length[order]) - length[order], order, length[order]


def _prefixes(length: np.ndarray) -> np.ndarray:
    """For each word how many rows have it."""
    return len(length) - np.cumsum(np.bincount(length))[:-1] if len(length) else length
