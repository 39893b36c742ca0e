"""Helpers shared by the operators: lineage cuts, stable hashes, and words of whole Arrow batches."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from pressledger.session import checkpointed

__all__ = [
    "BLANK", "WORD", "checkpointed", "fold_of", "is_held_out", "mix64", "pieces", "row_chunks", "utf8", "word_hashes",
]

#: A word is a longest run of other characters than these.
BLANK = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"

#: Text bytes worked on at once in a task; a longer document is a chunk by itself.
CHUNK_BYTES = 1 << 20

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_PRIME = np.uint64((1 << 31) - 1)
_BASES = 1_103_515_245, 1_812_433_253


def fold_of(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 4; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 4


def is_held_out(doc_id: Column) -> Column:
    """True for the fold that models never learn from; a null id is never held out."""
    return F.coalesce(fold_of(doc_id) == 2, F.lit(False))


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser, element by element."""
    x = np.asarray(x, dtype=np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts in a row, and where each begins (one more entry for the end). Null is empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if len(offsets) == 0:
        return np.zeros(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    data = column.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def row_chunks(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes, one row at least."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1)
        yield i, j
        i = j


def _folded(x: np.ndarray) -> np.ndarray:
    """The same remainders modulo 2^31 - 1, in 34 bits at most."""
    return (x & _PRIME) + (x >> np.uint64(31))


class _Powers:
    """Powers of a base and of its inverse modulo 2^31 - 1, kept by a worker as far as it has needed them."""

    def __init__(self, base: int):
        self.up, self.down = (np.ones(1, dtype=np.uint64) for _ in range(2))
        self.steps = base, pow(base, -1, int(_PRIME))

    def of(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        while len(self.up) < n:
            size = len(self.up)
            more = [np.uint64(pow(base, size, int(_PRIME))) for base in self.steps]
            self.up, self.down = (np.concatenate((x, x * m % _PRIME)) for x, m in zip((self.up, self.down), more, strict=True))
        return self.up, self.down


_POWERS = tuple(_Powers(base) for base in _BASES)


class ByteHashes:
    """64-bit hashes of any byte ranges of one buffer, by prefix sums of two polynomials modulo a prime; the place doesn't matter.

    Two different ranges of n bytes collide at no more than n of the 2^31 values that each base might have had.
    """

    def __init__(self, data: np.ndarray):
        digits = data.astype(np.uint64) + np.uint64(1)
        self.sums, self.down = [], []
        for powers in _POWERS:
            up, down = powers.of(len(data) + 1)
            sums = np.zeros(len(data) + 1, dtype=np.uint64)
            np.cumsum(_folded(digits * up[: len(data)]), out=sums[1:])
            self.sums.append(sums)
            self.down.append(down)

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        out = np.zeros(len(starts), dtype=np.uint64)
        for sums, down in zip(self.sums, self.down, strict=True):
            out = out << np.uint64(32) | (sums[ends] - sums[starts]) % _PRIME * down[starts] % _PRIME
        return mix64(out)


def pieces(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return ByteHashes(data).of(starts, ends)


_QUICK_BASE = 0x9E3779B97F4A7C15


def quick_pieces(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Cheaper hashes by bytes of a range's ends and sums: only for places on a curve, where different ranges may well share one."""
    sums = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum(data, out=sums[1:], dtype=np.int64)
    size = ends - starts
    eight = np.concatenate((data, np.zeros(8, dtype=np.uint8)))
    head = sum(eight[starts + i].astype(np.uint64) * (size > i) << np.uint64(8 * i) for i in range(4))
    tail = sum(data[np.maximum(ends - 1 - i, starts)].astype(np.uint64) << np.uint64(8 * i) for i in range(4))
    mixed = (head | tail << np.uint64(32)) * np.uint64(_QUICK_BASE) + (sums[ends] - sums[starts]).astype(np.uint64)
    return mix64(mixed + (size.astype(np.uint64) << np.uint64(48)))


def word_hashes(data: np.ndarray, offsets: np.ndarray, lower: bool = True, hashes=pieces) -> tuple[np.ndarray, np.ndarray]:
    """Row number and 64-bit hash of every word of a chunk, in order; A-Z in lower case if asked."""
    if len(data) == 0:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    space = _SPACE[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    before = np.concatenate(([True], space[:-1]))
    after = np.concatenate((space[1:], [True]))
    starts = np.flatnonzero(~space & (before | edge[:-1]))
    ends = np.flatnonzero(~space & (after | edge[1:])) + 1
    rows = np.searchsorted(offsets, starts, side="right") - 1
    return rows, hashes(_LOWER[data] if lower else data, starts, ends)
