"""Packing documents into sequences along a space-filling curve.

The words of a text are hashed into a signed vector, projected to four dimensions by fixed random directions, and
placed on a Hilbert curve. Documents are range-sorted by curve position, so neighbours share words; copies lie
at one position, and ties are spread by a hash of id and text, so a large group of copies covers several ranges.
Every range becomes one stream of tokens, cut at each sequence's end; there are as many ranges as the texts have pieces
of 32 MB, at most 65,536 (larger ranges are streamed and sorted on disk, never held). Their limits come from some 200 sampled
documents a range, weighed by bytes, so that a curve position is worked out once for every other document; they decide how even the
ranges are and nothing else. What remains of a range, less than a sequence, is cut into sequences whose lengths are powers of two:
nothing is padded.

Contract. ``pack_documents`` returns one row per piece: ``doc_id, start, length, ids`` (little-endian unsigned 32-bit),
``doc_tokens, sequence_id, offset``. A document is its ids and then the end id; a null or empty text is the end id
alone. Every id lies in exactly one piece; offsets of a sequence have no gap. Repeated rows are packed each by itself; a
null id stays null. Sequence ids are unique, not consecutive. Only ``doc_id`` and ``text`` are read.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pressledger.llm.common import quick_pieces, row_chunks, utf8, word_hashes
from pressledger.llm.pretokens import StretchIds

DIMS, BITS = 4, 8
_WIDTH_BITS = 8
_DIRECTIONS = np.random.default_rng(20).normal(size=(1 << _WIDTH_BITS, DIMS)) / 16
PIECES_AT_ONCE = 2048
#: Bytes of text in a range, and the most ranges: beyond them a shuffle's own book-keeping outweighs its data.
RANGE_BYTES, MAX_RANGES = 32 << 20, 1 << 16
#: Documents sampled for the limits, per range and in all; each is three numbers on the driver.
SAMPLE_ROWS, MAX_SAMPLE = 200, 1 << 20


def hilbert_index(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place on the Hilbert curve of points with whole coordinates below 2^bits (Skilling's transform)."""
    x = points.astype(np.int64).T.copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(n):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(high, x[0] ^ p, x[0] ^ swap)
            x[i] ^= swap if i else 0
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        t = np.where(x[n - 1] & q, t ^ (q - 1), t)
        q >>= 1
    x ^= t
    out = np.zeros_like(t)
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            out = out << 1 | (x[i] >> b & 1)
    return out


def curve_keys(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Curve position of every text of a chunk."""
    n = len(offsets) - 1
    rows, words = word_hashes(data, offsets, hashes=quick_pieces)
    cell = rows << _WIDTH_BITS | (words >> np.uint64(64 - _WIDTH_BITS)).astype(np.int64)
    sign = np.where(words & np.uint64(1), 1.0, -1.0)
    # Without a word at all numpy counts in whole numbers.
    vectors = np.bincount(cell, weights=sign, minlength=n << _WIDTH_BITS).astype(np.float64).reshape(n, -1)
    vectors /= np.maximum(np.sqrt((vectors * vectors).sum(axis=1, keepdims=True)), 1e-9)
    spread = np.tanh(4 * (vectors @ _DIRECTIONS * 4))
    return hilbert_index(np.clip((spread + 1) / 2 * (1 << BITS), 0, (1 << BITS) - 1))


def places(keys: np.ndarray, ties: np.ndarray) -> np.ndarray:
    """Curve positions, and among equal ones the upper 31 bits of the ties, as one number."""
    return keys << 31 | (ties >> 33) + (1 << 30)


def _keyed(limits: np.ndarray):
    """Curve position and range of every text; ``limits`` are the first places of all ranges but the first."""

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for i, j in row_chunks(offsets):
                keys = curve_keys(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                part = batch.slice(i, j - i)
                found = np.searchsorted(limits, places(keys, part.column(2).to_numpy()), side="right")
                at = pa.array(found.astype(np.int32))
                yield pa.RecordBatch.from_arrays([at, pa.array(keys, pa.int64()), *part.columns], names=["range", "key", "doc_id", "text", "tie"])

    return keyed


def _packer(path: str, end_id: int, length: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        ids_of = StretchIds(path)
        end = np.array([end_id], dtype="<u4").tobytes()
        sequence = TaskContext.get().partitionId() << 40
        names = ("doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset")
        types = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64())
        ready: list[tuple] = []
        open_: list[tuple] = []  # pieces of the sequence that isn't full yet
        filled = 0

        def out() -> pa.RecordBatch:
            columns = zip(*ready, strict=True) if ready else [()] * len(names)
            batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=list(names))
            ready.clear()
            return batch

        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                doc_id, text = doc_id.as_py(), text.as_py()
                ids = ids_of.encode(text or "") + end
                total, at = len(ids) // 4, 0
                while at < total:
                    n = min(total - at, length - filled)
                    open_.append((doc_id, at, n, ids[4 * at : 4 * (at + n)], total, sequence, filled))
                    at += n
                    filled += n
                    if filled == length:
                        ready.extend(open_)
                        open_, filled = [], 0
                        sequence += 1
                if len(ready) >= PIECES_AT_ONCE:
                    yield out()
        # The rest: cut at powers of two, the largest first.
        size = 1 << (filled.bit_length() - 1) if filled else 0
        room = size
        for doc_id, start, n, ids, total, _, _ in open_:
            at = 0
            while at < n:
                step = min(n - at, room)
                ready.append((doc_id, start + at, step, ids[4 * at : 4 * (at + step)], total, sequence, size - room))
                at += step
                room -= step
                filled -= step
                if not room and filled:
                    sequence += 1
                    size = room = 1 << (filled.bit_length() - 1)
        yield out()

    return pack


def _ranges(total: int | None) -> int:
    return max(1, min(MAX_RANGES, -(-(total or 0) // RANGE_BYTES)))


def range_count(docs: DataFrame) -> int:
    """Ranges for the texts of ``docs``, by their bytes."""
    return _ranges(docs.agg(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0])


def range_limits(rows: DataFrame) -> np.ndarray:
    """First place of every range but the first, for ``rows`` (doc_id, text, tie), by the bytes of sampled texts."""
    none = np.empty(0, np.int64)
    size = F.coalesce(F.octet_length("text"), F.lit(0)) + 1
    count, total = rows.agg(F.count(F.lit(1)), F.sum(F.octet_length("text"))).first()
    ranges = _ranges(total)
    if ranges == 1:
        return none
    # Another hash than the tie, which orders the copies of a text.
    share = min(1.0, min(MAX_SAMPLE, SAMPLE_ROWS * ranges) / count)
    some = rows.filter(F.pmod(F.xxhash64(F.lit(7), "doc_id", "tie"), F.lit(1 << 30)) < int(share * (1 << 30)))
    keyed = some.mapInArrow(_keyed(none), "range int, key long, doc_id long, text string, tie long")
    found = keyed.select("key", "tie", size.alias("size")).toArrow()
    place = places(found.column("key").to_numpy(), found.column("tie").to_numpy())
    if not len(place):
        return none
    order = np.argsort(place)
    weight = np.cumsum(found.column("size").to_numpy()[order])
    at = np.searchsorted(weight, weight[-1] * np.arange(1, ranges) / ranges, side="right")
    return np.unique(place[order[np.minimum(at, len(place) - 1)]])


def pack_documents(docs: DataFrame, path: str, end_id: int = 0, length: int = 1024) -> DataFrame:
    """One row per piece of a document; path: a byte-level tokenizer file; see the module's contract."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("doc_id", "text"))
    limits = range_limits(rows)
    keyed = rows.mapInArrow(_keyed(limits), "range int, key long, doc_id long, text string, tie long")
    ordered = keyed.repartitionById(len(limits) + 1, F.col("range")).sortWithinPartitions("key", "tie", "doc_id")
    return ordered.select("doc_id", "text").mapInArrow(
        _packer(path, end_id, length),
        "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long",
    )
