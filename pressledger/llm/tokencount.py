"""Token counts without token ids.

The library's own pre-tokeniser cuts texts into pre-tokens. A task turns a block of documents into one row per
distinct pre-token, with the documents and frequencies in two byte strings. Rows are shuffled and sorted by pre-token, so
that a task meets all frequencies of one together: it cuts the pre-token into pieces once, joins that count
to the frequencies, and sums products per document of each block. Last, the sums of a block meet.
Neither ids nor per-document token lists exist.

Pre-tokens in more than ``FREQUENT`` documents of a block are dealt by groups of ``SPREAD`` blocks as well, so no
task gets all rows of a word that is everywhere; such a pre-token is cut once per group. What meets in
the last step are the frequencies of one block at most, whose size is fixed.

Space-separated stretches always end at a pre-token border, so a task pre-tokenises each distinct stretch once;
texts with other runs of white space, or with a special string in them, are handed to the library whole.

Contract. ``count_tokens`` returns ``doc_id, n_bytes, n_tokens, over_limit`` per input row, as the library counts without
added special tokens; special strings inside a text are one token each, as is its default. Null is empty: 0 bytes, 0
tokens. Rows that repeat an id are counted each by itself; a null id stays null. Only ``doc_id`` and ``text`` are read.
"""

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pressledger.llm.pretokens import PreTokens

#: Characters of text in a block, and documents at most, so that two bytes name one.
BLOCK_CHARS, BLOCK_ROWS = 16 << 20, 1 << 16
FREQUENT, SPREAD = 16, 64
#: Sums of documents that a task keeps before it passes them on.
HELD_SUMS = 1 << 21
_FREQ = "pre string, salt long, block long, docs binary, times binary"
_PART = "block long, ids boolean, docs binary, times binary"


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple[int | None, str | None]]]:
    """Rows of a partition in order, cut by characters and rows."""
    held, size = [], 0
    for batch in batches:
        for row in zip(batch.column(0), batch.column(1), strict=True):
            doc_id, text = row[0].as_py(), row[1].as_py()
            held.append((doc_id, text))
            size += len(text or "")
            if size >= BLOCK_CHARS or len(held) == BLOCK_ROWS:
                yield held
                held, size = [], 0
    if held:
        yield held


def _ragged(begins: np.ndarray, widths: np.ndarray) -> np.ndarray:
    """Positions of ranges one after another."""
    shift = np.cumsum(widths) - widths
    return np.repeat(begins - shift, widths) + np.arange(int(widths.sum()))


def _postings(pre: PreTokens, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pre-tokens of a block; then, sorted by pre-token and document, both numbers and the frequency."""
    stretches: dict[str, int] = {}
    tokens: dict[str, int] = {}
    names, found, docs, other, other_docs = [], [], [], [], []
    for i, text in enumerate(texts):
        if not text:
            continue
        if pre.cuttable(text):
            head, *rest = text.split(" ")
            counts = Counter(rest)
            names.append(np.fromiter((stretches.setdefault(x, len(stretches)) for x in counts), np.int32, len(counts)))
            found.append(np.fromiter(counts.values(), np.int32, len(counts)))
            docs.append(np.full(len(counts), i, dtype=np.int32))
        else:
            head = text
        whole = pre.of(head) if head else []
        other.extend(tokens.setdefault(t, len(tokens)) for t in whole)
        other_docs.append(np.full(len(whole), i, dtype=np.int32))
    flat, ends = [], []
    for x in stretches:
        flat.extend(tokens.setdefault(t, len(tokens)) for t in pre.of_stretch(x))
        ends.append(len(flat))
    none = [np.zeros(0, dtype=np.int32)]
    names, found, docs = (np.concatenate(x or none) for x in (names, found, docs))
    ends = np.array(ends, dtype=np.int64)
    begins = np.concatenate((ends[:0], [0], ends[:-1])) if len(ends) else ends
    widths = (ends - begins)[names]
    token = np.concatenate((np.array(flat, dtype=np.int64)[_ragged(begins[names], widths)], np.array(other, dtype=np.int64)))
    doc = np.concatenate((np.repeat(docs, widths), *other_docs)).astype(np.int64)
    times = np.concatenate((np.repeat(found, widths), np.ones(len(other), dtype=np.int32))).astype(np.int64)
    key = token * BLOCK_ROWS + doc
    order = np.argsort(key)
    key, times = key[order], times[order]
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, dtype=np.int64)
    n = np.add.reduceat(times, first) if len(first) else times
    return list(tokens), key[first] // BLOCK_ROWS, key[first] % BLOCK_ROWS, n


def _frequencies(path: str):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of a block: its ids and lengths, then each pre-token with its documents and frequencies."""
        from pyspark import TaskContext

        pre, part = PreTokens(path), TaskContext.get().partitionId()
        for seq, rows_ in enumerate(_blocks(batches)):
            block = (part << 20) + seq
            sizes = np.array([len((t or "").encode()) for _, t in rows_], dtype="<i8")
            # A null id is told by a negative length.
            ids = np.array([0 if i is None else i for i, _ in rows_], dtype="<i8")
            sizes = np.where([i is None for i, _ in rows_], -1 - sizes, sizes)
            yield pa.RecordBatch.from_pydict({
                "pre": pa.array([None], pa.string()), "salt": pa.array([block], pa.int64()), "block": pa.array([block], pa.int64()),
                "docs": pa.array([ids.tobytes()], pa.binary()), "times": pa.array([sizes.astype("<i8").tobytes()], pa.binary()),
            })
            names, token, doc, n = _postings(pre, [t for _, t in rows_])
            # A frequency over 255 goes on in further entries of the same document.
            more = (n - 1) // 255
            if more.any():
                last = np.cumsum(more + 1) - 1
                token, doc, total = np.repeat(token, more + 1), np.repeat(doc, more + 1), n - 255 * more
                n = np.full(len(doc), 255, dtype=np.int64)
                n[last] = total
            ends = np.searchsorted(token, np.arange(len(names)), side="right")
            begins = np.concatenate(([0], ends[:-1])) if len(ends) else ends
            salt = np.where(ends - begins > FREQUENT, block // SPREAD, -1)
            raw_doc, raw_n = doc.astype("<u2").tobytes(), n.astype(np.uint8).tobytes()
            for i in range(0, len(names), 20_000):
                cut = list(zip(begins[i : i + 20_000].tolist(), ends[i : i + 20_000].tolist(), strict=True))
                yield pa.RecordBatch.from_pydict({
                    "pre": pa.array(names[i : i + 20_000], pa.string()), "salt": pa.array(salt[i : i + 20_000]),
                    "block": pa.array(np.full(len(cut), block, dtype=np.int64)),
                    "docs": pa.array([raw_doc[2 * a : 2 * b] for a, b in cut], pa.binary()), "times": pa.array([raw_n[a:b] for a, b in cut], pa.binary()),
                })

    return rows


def _sums(path: str):
    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pieces of each pre-token, once, times its frequencies, summed by document; rows come sorted by pre-token."""
        pre = PreTokens(path)
        held: dict[int, np.ndarray] = {}
        seen, last, last_pieces = 0, None, 0

        def out() -> Iterator[pa.RecordBatch]:
            for block, sums in held.items():
                at = np.flatnonzero(sums)
                yield pa.RecordBatch.from_pydict({
                    "block": pa.array([block], pa.int64()), "ids": pa.array([False]),
                    "docs": pa.array([at.astype("<u2").tobytes()], pa.binary()), "times": pa.array([sums[at].astype("<i8").tobytes()], pa.binary()),
                })

        for whole in batches:
            for start in range(0, len(whole), 20_000):
                batch = whole.slice(start, 20_000)
                names, docs, times = (batch.column(i).to_pylist() for i in (0, 3, 4))
                blocks = batch.column(2).to_numpy(zero_copy_only=False)
                pieces = np.zeros(len(names))
                for i, name in enumerate(names):
                    if name is None:
                        yield pa.RecordBatch.from_pydict({
                            "block": pa.array([int(blocks[i])], pa.int64()), "ids": pa.array([True]),
                            "docs": pa.array([docs[i]], pa.binary()), "times": pa.array([times[i]], pa.binary()),
                        })
                        docs[i] = times[i] = b""
                        continue
                    if name != last:
                        last, last_pieces = name, pre.pieces(name)
                    pieces[i] = last_pieces
                order = np.argsort(blocks, kind="stable")
                cuts = np.flatnonzero(np.diff(blocks[order])) + 1
                for own in np.split(order, cuts):
                    doc = np.frombuffer(b"".join([docs[i] for i in own]), dtype="<u2")
                    if not len(doc):
                        continue
                    n = np.frombuffer(b"".join([times[i] for i in own]), dtype=np.uint8)
                    n = n * np.repeat(pieces[own], [len(times[i]) for i in own])
                    sums, block = np.bincount(doc, weights=n), int(blocks[own[0]])
                    have = held.get(block, np.zeros(0))
                    if len(have) < len(sums):
                        seen += len(sums) - len(have)
                        have = np.pad(have, (0, len(sums) - len(have)))
                    have[: len(sums)] += sums
                    held[block] = have
                if seen > HELD_SUMS:
                    yield from out()
                    held, seen = {}, 0
        yield from out()

    return summed


def _totals(table: pa.Table) -> pa.Table:
    """One block: its ids and lengths, and what the tasks have summed."""
    ids = sizes = np.zeros(0, dtype=np.int64)
    parts = []
    for row in zip(*(table.column(x).to_pylist() for x in ("ids", "docs", "times")), strict=True):
        if row[0]:
            ids, sizes = np.frombuffer(row[1], dtype="<i8"), np.frombuffer(row[2], dtype="<i8")
        else:
            parts.append((np.frombuffer(row[1], dtype="<u2"), np.frombuffer(row[2], dtype="<i8")))
    tokens = np.zeros(len(ids))
    for doc, n in parts:
        tokens += np.bincount(doc, weights=n, minlength=len(ids))
    return pa.table({
        "doc_id": pa.array(ids, mask=sizes < 0), "n_bytes": pa.array(np.where(sizes < 0, -1 - sizes, sizes)), "n_tokens": pa.array(tokens.astype(np.int64)),
    })


def count_tokens(docs: DataFrame, path: str, limit: int = 1024) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every input row; path: a byte-level ``.json`` file."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    dealt = rows.mapInArrow(_frequencies(path), _FREQ).repartition("pre", "salt").sortWithinPartitions("pre", "block")
    parts = dealt.mapInArrow(_sums(path), _PART)
    totals = parts.groupBy("block").applyInArrow(_totals, "doc_id long, n_bytes long, n_tokens long")
    return totals.withColumn("over_limit", F.col("n_tokens") > limit)
