"""Alignment of two tokenizers by pointer jumping, with corpus-wide counts of aligned ids.

Both tokenisations cover the bytes of a blank and the text. Every token points to its farthest-right overlapping token of the
other side; where that one ends at the same byte, the pair ends a group, named by its terminal token (that of the first side).
Doubling all pointers at once, vectorised over a whole block of documents, takes every token to its group's terminal in as many
rounds as the logarithm of the longest chain.

Both tokenizers always end a token before a blank that stands between visible characters, so texts are cut there, and every distinct
stretch of a block of documents is encoded and aligned once. Inside a group only distinct ids meet, with their
numbers; occurrences are never paired one by one.

How many documents hold an id pair linked takes two passes over small tables. Each block lists its distinct pairs with the number
of its documents, packed by hash bucket; a bucket sums them, answers each block with corpus-wide counts in the block's own
order, and keeps the highest count of each first id (bounded by the vocabulary). A pair that is everywhere is one entry per block, so no
bucket grows with its documents. The number of buckets follows the size of the input. Last, each block's answers meet its
stretches, and sums per stretch give sums per document.

Contract. ``align`` returns ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups`` per input row; ``groups`` is
``a1,a2|b1;a3|b2,b3`` (ids in order). Null and empty texts, and those whose joined token bytes differ from blank + text on either side (a
text with U+2581, say), have no tokens: zeros and an empty string, and add to no count. Rows that repeat an id are documents each; a null id stays null.
Only ``doc_id`` and ``text`` are read. The first vocabulary is a byte-level ``.json``, the second a sentencepiece model that adds a blank.
"""

import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pressledger.llm.common import checkpointed, mix64
from pressledger.llm.pretokens import ODD_BLANK, PLAIN, rank_encoder

#: Characters of text in a block, and documents at most.
BLOCK_CHARS, BLOCK_ROWS = 4 << 20, 1 << 16
#: Links of documents worked on at once, one document at least.
RUN_PAIRS = 1 << 20
#: Input bytes per bucket of pairs.
BUCKET_BYTES, LEAST_BUCKETS = 8 << 20, 16
#: Distinct stretches whose ids a worker keeps from block to block.
KEPT = 200_000
#: A blank where both sides always end a token: between a character other than a blank and plain visible text.
CUT = re.compile(r"(?<=[^ ▁]) (?=[!-~¡-ᙿᚁ-៿])")


class Sides:
    """Both tokenizers: ids of stretches, bytes of ids, and ids as text with what follows them in a list of groups."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True  # their strings in a text are then ordinary text
        self.fast = rank_encoder(path_a)
        raw = {b: chr(b) for b in (*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100))}
        raw |= {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in raw)}
        byte = {c: b for b, c in raw.items()}
        size = max(self.a.get_vocab(with_added_tokens=True).values()) + 1
        self.bytes_a = [b""] * size
        for token, i in self.a.get_vocab(with_added_tokens=True).items():
            self.bytes_a[i] = bytes(byte[c] for c in token) if all(c in byte for c in token) else token.encode()
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)
        ]
        # A piece with a blank after another character could cross a cut.
        self.cuts = not any("▁" in p.lstrip("▁") for p in pieces)
        self.len_a, self.len_b = (np.array([len(x) for x in side], dtype=np.int64) for side in (self.bytes_a, self.bytes_b))
        self.text = {
            mark: np.array([f"{i}{mark}" for i in range(max(len(self.bytes_a), len(self.bytes_b)))], dtype=object) for mark in ",|;"
        }
        self.kept: dict[str, tuple[bytes, bytes]] = {}

    def stretches(self, text: str) -> list[str]:
        if not self.cuts:
            return [text]
        if text[0] != " " and not ODD_BLANK.search(text):
            return text.split(" ")
        return CUT.split(text)

    def _ids_a(self, stretch: str) -> list[int]:
        if self.fast is not None and PLAIN.fullmatch(stretch):
            return self.fast.encode_ordinary(" " + stretch)
        return self.a.encode(" " + stretch, add_special_tokens=False).ids

    def ids(self, stretches: list[str]) -> list[tuple[bytes, bytes] | None]:
        """Ids of both sides as unsigned 32-bit numbers; None where the bytes of either differ from blank + stretch."""
        new = [s for s in stretches if s not in self.kept]
        found = {}
        for at in range(0, len(new), 4096):
            part = new[at : at + 4096]
            for stretch, ids_b in zip(part, self.b.encode(part, num_threads=1), strict=True):
                ids_a, whole = self._ids_a(stretch), b" " + stretch.encode()
                same = whole == b"".join([self.bytes_a[i] for i in ids_a]) == b"".join([self.bytes_b[i] for i in ids_b])
                found[stretch] = (array("I", ids_a).tobytes(), array("I", ids_b).tobytes()) if same else None
        out = [found[s] if s in found else self.kept[s] for s in stretches]
        for s, ids in found.items():
            if len(self.kept) >= KEPT:
                break
            self.kept[s] = ids
        return out


def sides(path_a: str, path_b: str) -> Sides:
    """Both tokenizers, once per worker; hung on the library's module, since functions are shipped with their globals."""
    import tokenizers

    kept = tokenizers.__dict__.setdefault("_kept_by_workers", {})
    if ("sides", path_a, path_b) not in kept:
        kept["sides", path_a, path_b] = Sides(path_a, path_b)
    return kept["sides", path_a, path_b]


def terminals(end_a: np.ndarray, end_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For the tokens of both sides the number of the terminal token of their group, a token of the first side.

    Ends are byte offsets in one row of bytes that both sides cover.
    """
    n = len(end_a)
    start_a, start_b = (np.concatenate(([0], x[:-1])) for x in (end_a, end_b))
    far_b = np.searchsorted(start_b, end_a, side="left") - 1
    far_a = np.searchsorted(start_a, end_b, side="left") - 1
    successor = np.concatenate((np.where(end_b[far_b] > end_a, n + far_b, np.arange(n)), far_a)) if n else np.zeros(0, dtype=np.int64)
    while True:
        doubled = successor[successor]
        if np.array_equal(doubled, successor):
            return successor[:n], successor[n:]
        successor = doubled


def _ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers starts[i] ... starts[i] + sizes[i] - 1 of all i in a row."""
    ends = np.cumsum(sizes)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


def _per(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs of values, whose sizes may be 0."""
    sums = np.concatenate((np.zeros(1, dtype=np.int64), np.cumsum(values)))
    ends = np.cumsum(sizes)
    return sums[ends] - sums[ends - sizes]


class Stretches:
    """The aligned stretches of a block: per stretch its numbers, and the distinct id pairs with how often it links them."""

    def __init__(self, ids_a: np.ndarray, n_a: np.ndarray, ids_b: np.ndarray, n_b: np.ndarray, both: Sides):
        self.ids_a, self.ids_b, self.n_a, self.n_b, self.both = ids_a, ids_b, n_a, n_b, both
        last_a, last_b = terminals(np.cumsum(both.len_a[ids_a]), np.cumsum(both.len_b[ids_b]))
        ends, self.group_a = np.unique(last_a, return_inverse=True)
        self.group_b = np.searchsorted(ends, last_b)
        groups = len(ends)
        owner = np.repeat(np.arange(len(n_a)), n_a)[ends]
        in_a, in_b = np.bincount(self.group_a, minlength=groups), np.bincount(self.group_b, minlength=groups)
        self.n_groups = np.bincount(owner, minlength=len(n_a))
        self.n_links = _per(in_a * in_b, self.n_groups)

        # Distinct ids of each group, with their numbers, and then all of one side with all of the other.
        key_a, times_a = np.unique(self.group_a << 32 | ids_a, return_counts=True)
        key_b, times_b = np.unique(self.group_b << 32 | ids_b, return_counts=True)
        of_a = key_a >> 32
        own_b = np.bincount(key_b >> 32, minlength=groups)
        start_b = np.cumsum(own_b) - own_b
        left = np.repeat(np.arange(len(key_a)), own_b[of_a])
        right = _ragged(start_b[of_a], own_b[of_a])
        low = (1 << 32) - 1
        self.pairs, number = np.unique((key_a[left] & low) << 32 | key_b[right] & low, return_inverse=True)
        cell = owner[of_a[left]] * max(len(self.pairs), 1) + number
        order = np.argsort(cell, kind="stable")
        cell, times = cell[order], (times_a[left] * times_b[right])[order]
        first = np.flatnonzero(np.concatenate(([True], cell[1:] != cell[:-1]))) if len(cell) else np.zeros(0, dtype=np.int64)
        self.times = np.add.reduceat(times, first) if len(first) else times
        self.number = cell[first] % max(len(self.pairs), 1)
        self.n_pairs = np.bincount(cell[first] // max(len(self.pairs), 1), minlength=len(n_a))

    def texts(self) -> list[str]:
        """The groups of each stretch, each with a semicolon after it."""
        text, size_a, size_b = self.both.text, len(self.ids_a), len(self.ids_b)
        final_a, final_b = (np.concatenate((g[1:] != g[:-1], [True])) if len(g) else np.zeros(0, dtype=bool) for g in (self.group_a, self.group_b))
        parts = np.empty(size_a + size_b, dtype=object)
        parts[:size_a] = np.where(final_a, text["|"][self.ids_a], text[","][self.ids_a])
        parts[size_a:] = np.where(final_b, text[";"][self.ids_b], text[","][self.ids_b])
        order = np.argsort(np.concatenate((2 * self.group_a, 2 * self.group_b + 1)), kind="stable")
        flat = parts[order].tolist()
        ends = np.cumsum(self.n_a + self.n_b)
        return ["".join(flat[i:j]) for i, j in zip((ends - self.n_a - self.n_b).tolist(), ends.tolist(), strict=True)]


#: How numbers are written by the bytes each takes; 0 for numbers with a sign.
_WIDTHS = {1: np.dtype("u1"), 2: np.dtype("<u2"), 4: np.dtype("<u4"), 8: np.dtype("<i8"), 0: np.dtype("<i8")}


def packed(*arrays: np.ndarray) -> bytes:
    """Whole numbers in one compressed string, each array in as few bytes as its largest needs."""
    parts = []
    for x in arrays:
        width = 1 if not len(x) else 0 if x.min() < 0 else next(w for w in _WIDTHS if w == 8 or x.max() < 1 << (8 * w))
        parts += [np.array([width, len(x)], dtype="<i8").tobytes(), x.astype(_WIDTHS[width]).tobytes()]
    raw = b"".join(parts)
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def unpacked(data: bytes) -> list[np.ndarray]:
    raw = pa.decompress(data[8:], decompressed_size=int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True)
    out, at = [], 0
    while at < len(raw):
        width, n = np.frombuffer(raw, dtype="<i8", count=2, offset=at).tolist()
        kind = _WIDTHS[width]
        out.append(np.frombuffer(raw, dtype=kind, count=n, offset=at + 16).astype(np.int64))
        at += 16 + n * kind.itemsize
    return out


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple[int | None, str | None]]]:
    held, chars = [], 0
    for batch in batches:
        for row in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if held and (chars + len(row[1] or "") > BLOCK_CHARS or len(held) == BLOCK_ROWS):
                yield held
                held, chars = [], 0
            held.append(row)
            chars += len(row[1] or "")
    if held:
        yield held


def _buckets_of(pairs: np.ndarray, buckets: int) -> np.ndarray:
    return (mix64(pairs) % np.uint64(buckets)).astype(np.int64)


def encoded(texts: list[str | None], both: Sides) -> tuple[Stretches, np.ndarray, np.ndarray]:
    """The distinct stretches of a block of texts, each text's stretches in order, and their number (0 for a text without tokens)."""
    seen: dict[str, int] = {}
    orders = [[seen.setdefault(s, len(seen)) for s in both.stretches(t)] if t else [] for t in texts]
    ids = both.ids(list(seen))
    bad = {i for i, x in enumerate(ids) if x is None}
    if bad:
        orders = [[] if not bad.isdisjoint(o) else o for o in orders]
    ids = [x or (b"", b"") for x in ids]
    order = np.fromiter((i for o in orders for i in o), np.int64)
    a, b = (np.frombuffer(b"".join([x[k] for x in ids]), dtype=np.uint32).astype(np.int64) for k in (0, 1))
    n_a, n_b = (np.array([len(x[k]) // 4 for x in ids], dtype=np.int64) for k in (0, 1))
    return Stretches(a, n_a, b, n_b, both), order, np.array([len(o) for o in orders], dtype=np.int64)


def _documents_of(own: Stretches, order: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """How many documents of a block hold each distinct pair; documents are taken in runs of bounded size."""
    docs = np.zeros(len(own.pairs), dtype=np.int64)
    starts, width = np.cumsum(own.n_pairs) - own.n_pairs, max(len(own.n_a), 1)
    ends = np.cumsum(sizes)
    weight = np.cumsum(_per(own.n_pairs[order], sizes))
    i = 0
    while i < len(sizes):
        j = max(i + 1, int(np.searchsorted(weight, (weight[i - 1] if i else 0) + RUN_PAIRS, side="right")))
        part = order[ends[i] - sizes[i] : ends[j - 1]]
        # Distinct stretches of each document, then distinct pairs of each document.
        cells = np.unique(np.repeat(np.arange(j - i), sizes[i:j]) * width + part)
        doc, stretch = cells // width, cells % width
        numbers = own.number[_ragged(starts[stretch], own.n_pairs[stretch])]
        cells = np.unique(np.repeat(doc, own.n_pairs[stretch]) * max(len(own.pairs), 1) + numbers)
        docs += np.bincount(cells % max(len(own.pairs), 1), minlength=len(own.pairs))
        i = j
    return docs


_FOUND = "block long, bucket long, data binary"


def _found(path_a: str, path_b: str, buckets: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Per block its documents and stretches (bucket -1), and by bucket its pairs with the number of documents that hold them."""
        from pyspark import TaskContext

        both, part = sides(path_a, path_b), TaskContext.get().partitionId()
        for seq, held in enumerate(_blocks(batches)):
            block = (part << 24) + seq
            ids = np.array([0 if i is None else i for i, _ in held], dtype=np.int64)
            null = np.array([i is None for i, _ in held], dtype=np.int64)
            own, order, sizes = encoded([t for _, t in held], both)
            whole = packed(ids, null, sizes, order, own.ids_a, own.n_a, own.ids_b, own.n_b)
            yield pa.RecordBatch.from_pydict({"block": pa.array([block], pa.int64()), "bucket": pa.array([-1], pa.int64()), "data": pa.array([whole], pa.binary())})

            docs = _documents_of(own, order, sizes)
            # Stretches of texts without tokens count for nothing.
            held_, docs = np.flatnonzero(docs), docs[docs > 0]
            pairs = own.pairs[held_]
            bucket = _buckets_of(pairs, buckets)
            by = np.argsort(bucket, kind="stable")
            cuts = np.flatnonzero(np.diff(bucket[by])) + 1
            runs = np.split(by, cuts) if len(by) else []
            yield pa.RecordBatch.from_pydict({
                "block": pa.array(np.full(len(runs), block), pa.int64()), "bucket": pa.array([int(bucket[r[0]]) for r in runs], pa.int64()),
                "data": pa.array([packed(np.diff(pairs[r], prepend=0), docs[r]) for r in runs], pa.binary()),
            })

    return rows


def _answers(table: pa.Table) -> pa.Table:
    """One bucket: to each block the corpus-wide counts of its pairs; with block -1 the highest count of each first id."""
    asked = [unpacked(x) for x in table.column("data").to_pylist()]
    pairs = [np.cumsum(x[0]) for x in asked]
    every, number = np.unique(np.concatenate(pairs), return_inverse=True)
    counts = np.zeros(len(every), dtype=np.int64)
    np.add.at(counts, number, np.concatenate([x[1] for x in asked]))
    out = [packed(x) for x in np.split(counts[number], np.cumsum([len(p) for p in pairs])[:-1])]
    first = every >> 32
    new = np.flatnonzero(np.concatenate(([True], first[1:] != first[:-1])))
    most = packed(first[new], np.maximum.reduceat(counts, new))
    bucket = table.column("bucket").to_pylist()
    return pa.table({
        "block": pa.array([*table.column("block").to_pylist(), -1], pa.int64()), "bucket": pa.array([*bucket, bucket[0]], pa.int64()),
        "data": pa.array([*out, most], pa.binary()),
    })


def _highest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The highest count of each first id among a task's buckets."""
    best = np.zeros(0, dtype=np.int64)
    for batch in batches:
        for data in batch.column(0).to_pylist():
            ids, counts = unpacked(data)
            if len(ids) and ids[-1] >= len(best):
                best = np.pad(best, (0, int(ids[-1]) + 1 - len(best)))
            best[ids] = np.maximum(best[ids], counts)
    held = np.flatnonzero(best)
    yield pa.RecordBatch.from_pydict({"a": pa.array(held, pa.int64()), "most": pa.array(best[held], pa.int64())})


_ALIGNED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string"


def _documents(path_a: str, path_b: str, buckets: int, most: np.ndarray):
    def rows(blocks: pa.Table, answers: pa.Table) -> pa.Table:
        both = sides(path_a, path_b)
        ids, null, sizes, order, ids_a, n_a, ids_b, n_b = unpacked(blocks.column("data")[0].as_py())
        own = Stretches(ids_a, n_a, ids_b, n_b, both)
        # The same pairs as were asked for: those that documents with tokens hold.
        used = np.zeros(len(n_a), dtype=bool)
        used[order] = True
        held = np.zeros(len(own.pairs), dtype=bool)
        held[own.number[np.repeat(used, own.n_pairs)]] = True
        asked = np.flatnonzero(held)
        counts = np.zeros(len(own.pairs), dtype=np.int64)
        by = asked[np.argsort(_buckets_of(own.pairs[asked], buckets), kind="stable")]
        got = sorted(zip(answers.column("bucket").to_pylist(), answers.column("data").to_pylist(), strict=True))
        counts[by] = np.concatenate([unpacked(x)[0] for _, x in got]) if got else 0
        first = own.pairs >> 32
        best = np.zeros(len(own.pairs), dtype=bool)
        best[asked] = counts[asked] == most[first[asked]]
        of = {
            "n_a": n_a, "n_b": n_b, "n_groups": own.n_groups, "n_links": own.n_links,
            "n_best": _per(own.times * best[own.number], own.n_pairs), "count_sum": _per(own.times * counts[own.number], own.n_pairs),
        }
        texts, begins, ends = own.texts(), (np.cumsum(sizes) - sizes).tolist(), np.cumsum(sizes).tolist()
        places = order.tolist()
        return pa.table({
            "doc_id": pa.array(ids, pa.int64(), mask=null.astype(bool)),
            **{name: pa.array(_per(x[order], sizes), pa.int64()) for name, x in of.items()},
            "groups": pa.array(["".join([texts[k] for k in places[i:j]])[:-1] for i, j in zip(begins, ends, strict=True)], pa.string()),
        })

    return rows


def bucket_count(docs: DataFrame) -> int:
    """Buckets of pairs, in proportion to the input as Spark knows its size."""
    size = int(str(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return min(max(LEAST_BUCKETS, size // BUCKET_BYTES), 1 << 22)


def align(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups for every input row; see the module's contract."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    buckets = bucket_count(rows)
    found = checkpointed(rows.mapInArrow(_found(path_a, path_b, buckets), _FOUND))
    asked = found.where(F.col("bucket") >= 0)
    answers = checkpointed(asked.groupBy("bucket").applyInArrow(_answers, _FOUND))
    # One row for each id of the first vocabulary at most.
    highest = answers.where(F.col("block") < 0).select("data").mapInArrow(_highest, "a long, most long")
    top = {r["a"]: r["most"] for r in highest.groupBy("a").agg(F.max("most").alias("most")).collect()}
    most = np.zeros(max(top, default=0) + 1, dtype=np.int64)
    for a, n in top.items():
        most[a] = n
    blocks = found.where(F.col("bucket") < 0).select("block", "data")
    replies = answers.where(F.col("block") >= 0)
    met = blocks.groupBy("block").cogroup(replies.groupBy("block"))
    return met.applyInArrow(_documents(path_a, path_b, buckets, most), _ALIGNED)
