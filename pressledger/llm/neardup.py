"""Near-duplicate detection with HyperMinHash sketches, banding and exact verification.

A text is its set of distinct 5-word shingles. A sketch has 128 buckets; a bucket keeps of its smallest hash
the count of leading zeros (6 bits) and 10 mantissa bits. Empty buckets of short texts borrow the next full
one from a fixed starting place. Texts of one set are first folded into a class. 32 bands of four
registers propose classes to compare: at a similarity of 0.85 a pair is missed with probability
(1 - 0.85^4)^32 < 1e-10 if all buckets are full. Inside a band's bucket, equal registers, corrected for chance collisions,
estimate the similarity; only pairs at most four standard errors below the limit are verified on their full sets.

A bucket never emits all its pairs. The first round proposes each class's two best partners only, so it is linear;
once the links found there are contracted, the second round compares only classes of one bucket that lie in
different components, by finer sketches (1,024 buckets, a byte each, nothing borrowed), whose estimate is nearly the
similarity itself for texts of up to some hundred words. A pair of larger classes is proposed in its first common band only. Buckets beyond
``BLOCK`` classes are compared block by block, so no task holds a whole one. Classes that are already
connected need no further links, so the components are those of the full link graph.

Sketches say little about short texts, which fill few buckets. Classes of at most ``EXACT`` shingles meet each other
without them: of its shingles, ordered by how many such classes have them, the rarest first, a class of n needs only the first
n - ceil(limit n) + 1 as bucket keys, for two sets at the limit have one of these in common (prefix filter). Of their
pairs the second round leaves out only those whose finer sketches prove them below the limit.

Contract. ``near_duplicates`` returns ``doc_id, n_shingles, component_id, kept`` per input row. Fewer than five
words are one shingle; without words, or with a null text, a row is linked with nothing. A row without id
is linked with nothing, has a null component and is kept. Rows that repeat an id are one document. Ties cannot
occur: components are named by their smallest id. Only ``doc_id`` and ``text`` are read.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from pressledger.llm.common import checkpointed, mix64, row_chunks, utf8, word_hashes

WORDS = 5
BUCKET_BITS, MANTISSA_BITS = 7, 10
REGISTERS, BAND = 1 << BUCKET_BITS, 4
BANDS = REGISTERS // BAND
#: Classes of one bucket compared in one task; larger buckets are cut.
BLOCK = 2048
#: Partners looked at in the first round: neighbours in a block ordered by sketch.
NEIGHBOURS = 128
#: Ids sent to every task at most; beyond, a shuffle join.
BROADCAST_IDS = 1_000_000
#: Ids of a table of links or roots in one task; beyond, there are more tasks.
TASK_IDS = 1 << 17
FINE = 1024
#: Classes of at most so many shingles find each other by rare shingles, not by sketches.
EXACT = 80
_EMPTY = np.uint16(0xFFFF)
_MULT = mix64(np.arange(1, WORDS + 1)) | np.uint64(1)
_START = (mix64(np.arange(REGISTERS) + 77) % np.uint64(REGISTERS)).astype(np.int64)


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row number and hash of the distinct shingles of a chunk, sorted by both."""
    rows, words = word_hashes(data, offsets)
    n = len(offsets) - 1
    counts = np.bincount(rows, minlength=n)
    last = np.cumsum(counts)
    out_rows, out = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    if len(words) >= WORDS:
        total = sum((words[i : len(words) - WORDS + 1 + i] * _MULT[i] for i in range(1, WORDS)), words[: len(words) - WORDS + 1] * _MULT[0])
        whole = rows[: len(total)] == rows[WORDS - 1 :]
        out_rows, out = rows[: len(total)][whole], mix64(total[whole])
    short = np.flatnonzero((counts > 0) & (counts < WORDS))
    if len(short):
        begin = last[short] - counts[short]
        extra = mix64(counts[short].astype(np.uint64) + np.uint64(1 << 40))
        for i in range(WORDS - 1):
            has = counts[short] > i
            extra[has] += words[begin[has] + i] * _MULT[i]
        order = np.argsort(np.concatenate((out_rows, short)), kind="stable")
        out_rows, out = np.concatenate((out_rows, short))[order], np.concatenate((out, mix64(extra)))[order]
    ends = np.searchsorted(out_rows, np.arange(n), side="right")
    begins = np.concatenate(([0], ends[:-1])) if n else ends
    for i, j in zip(begins.tolist(), ends.tolist(), strict=True):
        out[i:j].sort()
    new = np.ones(len(out), dtype=bool)
    new[1:] = (out[1:] != out[:-1]) | (out_rows[1:] != out_rows[:-1])
    return out_rows[new], out[new]


def sketches(rows: np.ndarray, hashes: np.ndarray, n: int) -> np.ndarray:
    """n x 128 registers: leading zeros and mantissa of the smallest hash of each bucket."""
    regs = np.full((n, REGISTERS), _EMPTY, dtype=np.uint16)
    if len(hashes):
        cell = rows * REGISTERS + (hashes >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
        first = np.concatenate(([True], cell[1:] != cell[:-1]))
        low = hashes[first] << np.uint64(BUCKET_BITS)
        # The exponent of the float is the place of the leading one; 52 bits are enough for both parts.
        frac, exp = np.frexp((low >> np.uint64(11)).astype(np.float64))
        zeros = np.clip(53 - exp, 0, 62)
        mantissa = ((np.maximum(frac, 0.5) - 0.5) * (2 << MANTISSA_BITS)).astype(np.int64)
        regs.reshape(-1)[cell[first]] = (zeros << MANTISSA_BITS | mantissa).astype(np.uint16)
    empty = regs == _EMPTY
    if empty.any():
        place = np.where(np.concatenate((empty, empty), axis=1), 4 * REGISTERS, np.arange(2 * REGISTERS))
        following = np.minimum.accumulate(place[:, ::-1], axis=1)[:, ::-1]
        lend = following[:, _START]
        lend = np.where(lend < 4 * REGISTERS, lend % REGISTERS, 0)
        regs = np.where(empty, np.take_along_axis(regs, lend, axis=1), regs)
    return regs


def _levels(n: np.ndarray) -> np.ndarray:
    """Chance that a bucket's smallest hash has each count of leading zeros, if a text has n shingles."""
    share = np.maximum(n, 1)[:, None] / REGISTERS
    edge = 0.5 ** np.arange(0, 41)
    above = 1 - (1 - np.minimum(edge, 1 - 1e-12)) ** np.maximum(share, 1.0)
    return above[:, :-1] - above[:, 1:]


def estimate(left: np.ndarray, right: np.ndarray, n_left: np.ndarray, n_right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Similarity of pairs of sketches, corrected for registers equal by chance, and the first common band."""
    equal = left == right
    chance = (_levels(n_left) * _levels(n_right)).sum(axis=1) / (1 << MANTISSA_BITS)
    bands = equal.reshape(-1, BANDS, BAND).all(axis=2)
    return (equal.mean(axis=1) - chance) / (1 - chance), np.where(bands.any(axis=1), bands.argmax(axis=1), BANDS)


def margin(n: np.ndarray, limit: float) -> np.ndarray:
    """Four standard errors of the estimate, if the smaller set has n shingles.

    Only filled buckets are independent. Each speaks for itself and for the empty ones that borrow from it, a number that
    scatters like the gaps between random places.
    """
    full = -REGISTERS * np.expm1(np.maximum(n, 1) * np.log1p(-1 / REGISTERS))
    lent = (REGISTERS - full) / full
    return 4 * np.sqrt(limit * (1 - limit) * full * (lent + lent**2 + (1 + lent) ** 2)) / REGISTERS


def fine_sketches(rows: np.ndarray, hashes: np.ndarray, n: int) -> np.ndarray:
    """n x 1,024 bytes: of each bucket's smallest hash its lowest bits, 0 for an empty bucket."""
    out = np.zeros((n, FINE), dtype=np.uint8)
    if len(hashes):
        cell = rows * FINE + (hashes >> np.uint64(54)).astype(np.int64)
        first = np.concatenate(([True], cell[1:] != cell[:-1]))
        out.reshape(-1)[cell[first]] = (1 + hashes[first] % np.uint64(255)).astype(np.uint8)
    return out


def near_enough(left: np.ndarray, right: np.ndarray, n_left: np.ndarray, n_right: np.ndarray, limit: float) -> np.ndarray:
    """Whether finer sketches leave it open that the similarity reaches the limit: for small sets surely, else at four standard errors."""
    full_left, full_right = left != 0, right != 0
    union = np.maximum((full_left | full_right).sum(axis=1), 1)
    chance = 1 / 255
    equal = ((left == right) & full_left).sum(axis=1)
    est = (equal / union - chance) / (1 - chance)
    # Shingles that no bucket kept are what an estimate can err by; chance collisions add a little.
    kept = (full_left.sum(axis=1) + full_right.sum(axis=1)) / np.maximum(n_left + n_right, 1)
    error = np.sqrt(limit * (1 - limit) * np.maximum(1 - kept, 0) / union + chance / union)
    # A common shingle makes its bucket equal unless another one displaced it there.
    most = equal + np.maximum(n_left - full_left.sum(axis=1), 0) + np.maximum(n_right - full_right.sum(axis=1), 0)
    open_ = most >= limit * (n_left + n_right - most) - 1e-6
    return np.where(np.maximum(n_left, n_right) <= EXACT, open_, est >= limit - 4 * error - 1 / union)


def _fine_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = utf8(batch.column(1))
        for i, j in row_chunks(offsets):
            found = fine_sketches(*shingle_sets(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]), j - i)
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array([r.tobytes() for r in found], pa.binary())], names=["cid", "fine"])


def _sketch_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = utf8(batch.column(1))
        for i, j in row_chunks(offsets):
            rows, hashes = shingle_sets(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
            n = np.bincount(rows, minlength=j - i)
            regs = sketches(rows, hashes, j - i)
            keys = []
            for salt in (0, 0x5851F42D4C957F2D):
                sums = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum(mix64(hashes ^ np.uint64(salt)))))
                ends = np.cumsum(n)
                keys.append(pa.array((sums[ends] - sums[ends - n]).view(np.int64), pa.int64()))
            raw = regs.tobytes()
            size = 2 * REGISTERS
            small = [hashes[e - k : e].tobytes() if 0 < k <= EXACT else None for k, e in zip(n.tolist(), ends.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(i, j - i), pa.array(n, pa.int64()), *keys,
                    pa.array([raw[k * size : (k + 1) * size] for k in range(j - i)], pa.binary()), pa.array(small, pa.binary()),
                ],
                names=["doc_id", "n_shingles", "k1", "k2", "sketch", "small"],
            )


def _small_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not len(batch):
            continue
        n = batch.column(2).to_numpy(zero_copy_only=False)
        own = [pa.array(np.repeat(batch.column(i).to_numpy(zero_copy_only=False), n), pa.int64()) for i in range(3)]
        hashes = np.frombuffer(b"".join(batch.column(3).to_pylist()), dtype=np.int64)
        yield pa.RecordBatch.from_arrays([*own, pa.array(hashes)], names=["cid", "k1", "n_shingles", "key"])


def rare_keys(classes: DataFrame, percent: int) -> DataFrame:
    """key, cid, band (BANDS): the rare shingles of small classes; two classes at the limit have one in common."""
    own = ["cid", "k1", "n_shingles"]
    held = classes.where(F.col("small").isNotNull()).select(*own, "small").mapInArrow(_small_sets, "cid long, k1 long, n_shingles long, key long")
    # Stored by itself, so that the join below can split a common shingle's rows.
    shared = checkpointed(held.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > 1))
    ordered = held.join(shared, "key").groupBy(*own).agg(F.sort_array(F.collect_list(F.struct("n", "key"))).alias("found"))
    # Shingles of one class only come first in the order, and find nothing.
    prefix = F.col("n_shingles") - F.floor((percent * F.col("n_shingles") + 99) / 100) + 1
    left = F.greatest(prefix - (F.col("n_shingles") - F.size("found")), F.lit(0)).cast("int")
    return ordered.select(F.explode(F.slice("found", 1, left)["key"]).alias("key"), "cid", F.lit(BANDS).alias("band"))


def _registers(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint16).reshape(-1, REGISTERS)


def _band_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not len(batch):
            continue
        parts = _registers(batch.column(1)).view(np.uint64).reshape(-1, BANDS)
        keys = mix64(parts + mix64(np.arange(BANDS) + 1000)).view(np.int64)
        yield pa.RecordBatch.from_arrays([
            pa.array(keys.reshape(-1)), pa.array(np.repeat(batch.column(0).to_numpy(zero_copy_only=False), BANDS), pa.int64()),
            pa.array(np.tile(np.arange(BANDS, dtype=np.int32), len(batch))),
        ], names=["key", "cid", "band"])


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows whose key is not alone, with the block they fall into; rows come sorted by key."""
    held, count = None, 0

    def done(table: pa.Table, following: int | None) -> tuple[pa.Table, int]:
        keys = table.column("key").to_numpy()
        same = np.concatenate((keys[1:] == keys[:-1], [following is not None and following == keys[-1]]))
        first = np.concatenate(([count == 0 or keys[0] != before], ~same[:-1]))
        start = np.maximum.accumulate(np.where(first, np.arange(len(keys)), -1))
        index = np.where(start >= 0, np.arange(len(keys)) - start, np.arange(len(keys)) + count)
        shared = same | (index > 0)
        out = table.append_column("block", pa.array((index // BLOCK).astype(np.int32))).filter(pa.array(shared))
        return out, int(index[-1]) + 1

    before = None
    for batch in batches:
        if not len(batch):
            continue
        table = pa.Table.from_batches([batch])
        if held is not None:
            out, count = done(held, table.column("key")[0].as_py())
            before = held.column("key")[-1].as_py()
            yield from out.to_batches()
        held = table
    if held is not None:
        yield from done(held, None)[0].to_batches()


def _groups(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Whole groups of rows sorted by the named columns, and where each begins (one more for the end)."""
    held = None
    for batch in batches:
        if not len(batch):
            continue
        table = pa.Table.from_batches([batch])
        held = table if held is None else pa.concat_tables([held, table])
        cuts = _cuts(held, names)
        if len(cuts) > 2:
            yield held.slice(0, int(cuts[-2])).combine_chunks(), cuts[:-1]
            held = held.slice(int(cuts[-2])).combine_chunks()
    if held is not None and len(held):
        yield held.combine_chunks(), _cuts(held, names)


def _cuts(table: pa.Table, names: list[str]) -> np.ndarray:
    change = np.zeros(max(0, len(table) - 1), dtype=bool)
    for name in names:
        x = table.column(name).to_numpy()
        change |= x[1:] != x[:-1]
    return np.concatenate(([0], np.flatnonzero(change) + 1, [len(table)]))


_PAIRS = "a long, b long, est double"


def _proposer(limit: float, best: int | None):
    """Pairs of a sorted stream of bucket rows: each row's best partners, or all that may reach the limit."""

    def pairs_of(size: int, side: np.ndarray | None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        if best is not None and size > NEIGHBOURS:
            for step in range(1, NEIGHBOURS):
                yield np.arange(size - step), np.arange(step, size)
            return
        step = max(1, (1 << 16) // max(1, size))
        for i in range(0, size, step):
            rows = np.arange(i, min(size, i + step))
            left, right = np.repeat(rows, size), np.tile(np.arange(size), len(rows))
            ok = left < right
            if side is not None:
                ok &= side[left] != side[right]
            yield left[ok], right[ok]

    def propose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, cuts in _groups(batches, ["key", "lo", "hi"]):
            cid, comp, n = (table.column(x).to_numpy() for x in ("cid", "comp", "n_shingles"))
            band, block, lo, hi = (table.column(x).to_numpy() for x in ("band", "block", "lo", "hi"))
            regs = _registers(table.column("sketch"))
            fine = np.frombuffer(b"".join(table.column("fine").to_pylist()), dtype=np.uint8).reshape(-1, FINE) if best is None else None
            todo = []
            sizes = np.diff(cuts)
            # Small groups of one size are compared together.
            for size in np.unique(sizes[sizes <= 16]):
                if size > 1:
                    start = cuts[:-1][sizes == size]
                    left, right = np.triu_indices(size, 1)
                    todo.append(((start[:, None] + left).reshape(-1), (start[:, None] + right).reshape(-1)))
            for at in np.flatnonzero(sizes > 16):
                i, j = int(cuts[at]), int(cuts[at + 1])
                if (comp[i:j] == comp[i]).all():
                    continue
                order = np.lexsort(regs[i:j, :8].T) if best is not None else np.arange(j - i)
                side = block[i:j] if lo[i] != hi[i] else None
                todo.extend((i + order[x], i + order[y]) for x, y in pairs_of(j - i, side))
            found = []
            for x, y in todo:
                ok = comp[x] != comp[y]
                ok &= np.minimum(n[x], n[y]) >= limit * np.maximum(n[x], n[y])
                x, y = x[ok], y[ok]
                for at in range(0, len(x), 1 << 16):
                    xs, ys = x[at : at + (1 << 16)], y[at : at + (1 << 16)]
                    est, first = estimate(regs[xs], regs[ys], n[xs], n[ys])
                    small = np.maximum(n[xs], n[ys]) <= EXACT
                    good = np.where(small, band[xs] == BANDS, (est >= limit - margin(np.minimum(n[xs], n[ys]), limit)) & (first == band[xs]))
                    xs, ys, est = xs[good], ys[good], est[good]
                    if best is None:
                        good = np.concatenate([np.zeros(0, dtype=bool)] + [
                            near_enough(fine[xs[k : k + 4096]], fine[ys[k : k + 4096]], n[xs[k : k + 4096]], n[ys[k : k + 4096]], limit) for k in range(0, len(xs), 4096)
                        ])
                        xs, ys, est = xs[good], ys[good], est[good]
                    found.append((xs, ys, est))
            if not found:
                continue
            x, y, est = (np.concatenate(v) for v in zip(*found, strict=True))
            if best is not None:
                both = np.concatenate((x, y))
                order = np.lexsort((np.concatenate((cid[y], cid[x])), -np.concatenate((est, est)), both))
                sorted_ = both[order]
                start = np.searchsorted(sorted_, sorted_, side="left")
                keep = np.unique(order[np.arange(len(order)) - start < best] % len(x))
                x, y, est = x[keep], y[keep], est[keep]
            yield pa.RecordBatch.from_arrays([
                pa.array(np.minimum(cid[x], cid[y])), pa.array(np.maximum(cid[x], cid[y])), pa.array(est),
            ], names=["a", "b", "est"])

    return propose


def propose_pairs(buckets: DataFrame, classes: DataFrame, labels: DataFrame, limit: float, best: int | None, rows: int | None = None) -> DataFrame:
    """Distinct pairs of classes of different components that share a bucket and look similar enough.

    classes: cid, n_shingles, sketch, and for the round without ``best`` also the finer sketch, fine. ``rows``: of labels, if known.
    """
    whole = Window.partitionBy("key")
    named = buckets.join(_small(labels, rows), "cid").repartition("key").withColumns({
        "_lo": F.min("comp").over(whole), "_hi": F.max("comp").over(whole), "_blocks": F.max("block").over(whole)
    })
    rows = named.where(F.col("_lo") != F.col("_hi")).drop("_lo", "_hi").join(classes, "cid")
    if best is None:
        rows = rows.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks"))))
        rows = rows.withColumns({"lo": F.least("block", "_other"), "hi": F.greatest("block", "_other")})
    else:
        rows = rows.withColumns({"lo": F.col("block"), "hi": F.col("block")})
    rows = rows.select("key", "lo", "hi", "cid", "comp", "n_shingles", "band", "block", "sketch", *(["fine"] if best is None else []))
    dealt = rows.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi")
    pairs = dealt.mapInArrow(_proposer(limit, best), _PAIRS).groupBy("a", "b").agg(F.max("est").alias("est"))
    if best is not None:
        # The best few of every class over all its buckets.
        ends = pairs.select(F.explode(F.array("a", "b")).alias("_own"), "a", "b", "est")
        order = Window.partitionBy("_own").orderBy(F.desc("est"), "a", "b")
        pairs = ends.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= best).select("a", "b").distinct()
    return pairs.select("a", "b")


def _links(percent: int):
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pairs whose full sets are similar enough; a's set is reused while a stays the same."""
        for whole in batches:
            for at in range(0, len(whole), 256):
                batch = whole.slice(at, 256)
                a, b = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
                fresh = np.flatnonzero(np.concatenate(([True], a[1:] != a[:-1])))
                sets = []
                for column in (batch.column(2).take(pa.array(fresh)), batch.column(3)):
                    data, offsets = utf8(column)
                    own = []
                    for i, j in row_chunks(offsets):
                        rows, hashes = shingle_sets(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                        own.extend(np.split(hashes, np.searchsorted(rows, np.arange(1, j - i))))
                    sets.append(own)
                which = np.searchsorted(fresh, np.arange(len(batch)), side="right") - 1
                keep = np.zeros(len(batch), dtype=bool)
                for i in range(len(batch)):
                    x, y = sets[0][which[i]], sets[1][i]
                    common = len(np.intersect1d(x, y, assume_unique=True))
                    keep[i] = common > 0 and 100 * common >= percent * (len(x) + len(y) - common)
                yield pa.RecordBatch.from_arrays([pa.array(a[keep]), pa.array(b[keep])], names=["a", "b"])

    return verify


def verified(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The pairs whose shingle sets have 100 * common >= percent * union."""
    left = texts.select(F.col("cid").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("cid").alias("b"), F.col("text").alias("text_b"))
    rows = pairs.join(right, "b").join(left, "a").select("a", "b", "text_a", "text_b")
    return rows.mapInArrow(_links(percent), "a long, b long").distinct()


def _small(df: DataFrame, rows: int | None = None) -> DataFrame:
    """A checkpointed table of ids: sent to every task if it has few rows (counted here unless known), else left to a shuffle join."""
    return F.broadcast(df) if (df.count() if rows is None else rows) <= BROADCAST_IDS else df


def _stars(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect the same ids: the smallest one of each connected part with every other."""
    ids, ends = np.unique(np.concatenate((u, v)), return_inverse=True)
    x, y = ends.reshape(2, -1)
    low = np.arange(len(ids))
    while True:
        a, b = low[x], low[y]
        apart = a != b
        if not apart.any():
            break
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(low, np.maximum(a, b), np.minimum(a, b))
        while (low[low] != low).any():
            low = low[low]
    moved = np.flatnonzero(low != np.arange(len(ids)))
    return ids[low[moved]], ids[moved]


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The edges of a task as stars, so that no long chain of its own is left; at most 2 ``TASK_IDS`` are held."""
    held = np.zeros((2, 0), dtype=np.int64)
    for batch in batches:
        held = np.concatenate((held, [batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1)]), axis=1)
        if held.shape[1] > 2 * TASK_IDS:
            held = np.stack(_stars(*held))
            if held.shape[1] > TASK_IDS:
                yield pa.RecordBatch.from_arrays([pa.array(held[0]), pa.array(held[1])], names=["u", "v"])
                held = held[:, :0]
    held = np.stack(_stars(*held))
    yield pa.RecordBatch.from_arrays([pa.array(held[0]), pa.array(held[1])], names=["u", "v"])


def _thinned(edges: DataFrame, rows: int) -> DataFrame:
    """Edges (u, v) as stars of each task. Tasks are as few as ``TASK_IDS`` allows, so that what is left of an input meets soon."""
    return edges.coalesce(_parts(rows)).mapInArrow(_forest, "u long, v long")


def _parts(rows: int) -> int:
    """Tasks for a table of so many links, of two ids each."""
    return max(1, -(-2 * rows // TASK_IDS))


def contracted(labels: DataFrame, links: DataFrame, rows: int | None = None) -> DataFrame:
    """Labels after joining the components that the links connect, each under its smallest label. ``rows``: of labels, if known.

    In each round links are thinned within each task, every component hooks onto its smallest neighbour, and chains are halved until
    all point at a root; links are taken over to the roots, and those inside a component vanish. Each round leaves fewer
    components with links. Each job costs the driver plans, events and threads, however few ids are left; so tables of ids are
    held in no more partitions than they need, and sizes are counted along with what ends a loop.
    """
    total = left = links.count()
    if not left:
        return labels
    named = _small(labels, rows)
    here, there = (named.select(F.col("cid").alias(x), F.col("comp").alias(y)) for x, y in (("a", "u"), ("b", "v")))
    # Stored as joined: the few tasks below must not become those of the join.
    moves, edges = None, checkpointed(links.join(here, "a").join(there, "b").where(F.col("u") != F.col("v")).select("u", "v"))
    while left:
        parts = _parts(left)
        edges = checkpointed(_thinned(edges, left))
        both = edges.union(edges.select("v", "u"))
        root = both.groupBy(F.col("u").alias("c")).agg(F.min("v").alias("m")).select("c", F.least("c", "m").alias("root"))
        root = checkpointed(root.coalesce(parts))
        ids = moved = root.count()
        while moved:
            up = _small(root, ids).select(F.col("c").alias("root"), F.col("root").alias("higher"))
            jumped = root.join(up, "root").select("c", F.col("higher").alias("to"), (F.col("higher") < F.col("root")).alias("moved"))
            jumped = checkpointed(jumped.coalesce(parts))
            root, moved = jumped.select("c", F.col("to").alias("root")), jumped.where("moved").count()
        ends = _small(root, ids)
        if moves is None:
            moves = root
        else:
            moves = checkpointed(moves.join(ends.select(F.col("c").alias("root"), F.col("root").alias("to")), "root", "left").select("c", F.coalesce("to", "root").alias("root")).coalesce(_parts(total)))
        if parts == 1:
            break  # one task's stars are whole components
        here, there = (ends.select(F.col("c").alias(x), F.col("root").alias(y)) for x, y in (("u", "p"), ("v", "q")))
        edges = edges.join(here, "u").join(there, "v").where(F.col("p") != F.col("q")).select(F.col("p").alias("u"), F.col("q").alias("v"))
        edges = checkpointed(edges.distinct())
        left = edges.count()
    renamed = labels.join(_small(moves).withColumnRenamed("c", "comp"), "comp", "left")
    return checkpointed(renamed.select("cid", F.coalesce("root", "comp").alias("comp")))


def near_duplicates(docs: DataFrame, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every input row; see the module's contract."""
    limit = percent / 100
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    own = checkpointed(rows.mapInArrow(_sketch_rows, "doc_id long, n_shingles long, k1 long, k2 long, sketch binary, small binary"))
    keys = ["k1", "k2", "n_shingles"]
    linked = own.where(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0))
    classes = checkpointed(linked.groupBy(*keys).agg(F.min("doc_id").alias("cid"), F.min("sketch").alias("sketch"), F.min("small").alias("small")))
    members = checkpointed(linked.select("doc_id", *keys).join(classes.select(*keys, "cid"), keys).select("doc_id", "cid"))
    labels = checkpointed(classes.select("cid", F.col("cid").alias("comp")).distinct())
    n = labels.count()

    repeats = members.groupBy("doc_id").agg(F.min("cid").alias("a"), F.max("cid").alias("_hi")).where(F.col("a") != F.col("_hi"))
    same = members.join(repeats.drop("_hi"), "doc_id").where(F.col("a") != F.col("cid")).select("a", F.col("cid").alias("b"))
    labels = contracted(labels, checkpointed(same), n)

    # Classes too small to be near one beyond EXACT have no bands.
    wide = classes.where(100 * F.col("n_shingles") >= percent * (EXACT + 1))
    banded = wide.select("cid", "sketch").mapInArrow(_band_keys, "key long, cid long, band int").union(rare_keys(classes, percent))
    buckets = banded.repartition("key").sortWithinPartitions("key", "cid").mapInArrow(_shared, "key long, cid long, band int, block int")
    buckets = checkpointed(buckets)
    sized = classes.select("cid", "n_shingles", "sketch")
    near = _small(checkpointed(buckets.select("cid").distinct()))
    texts = checkpointed(rows.withColumnRenamed("doc_id", "cid").join(near, "cid", "left_semi"))
    fine = checkpointed(texts.mapInArrow(_fine_rows, "cid long, fine binary"))
    for best in (2, None):
        known = sized if best else sized.join(fine, "cid")
        pairs = checkpointed(propose_pairs(buckets, known, labels, limit, best, n))
        labels = contracted(labels, checkpointed(verified(pairs, texts, percent)), n)

    named = members.join(_small(labels, n), "cid").groupBy("doc_id").agg(F.min("comp").alias("component_id"))
    out = own.select("doc_id", "n_shingles").join(named, "doc_id", "left")
    out = out.withColumn("component_id", F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def drop_near_duplicates(docs: DataFrame, percent: int = 80) -> DataFrame:
    """One row of every group, that of the smallest id, with all its columns; rows without id stay.

    Of rows that repeat an id, the first by a hash of the row as JSON stays; columns of any type and name may come along.
    """
    found = checkpointed(near_duplicates(docs, percent).where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.max("kept").alias("kept"), F.count("*").alias("n")
    ))
    dropped = _small(checkpointed(found.where(~F.col("kept")).select("doc_id")))
    columns = [f"`{c.replace('`', '``')}`" for c in docs.columns]
    left = docs.join(dropped, "doc_id", "left_anti").select(*columns)
    repeated = checkpointed(found.where(F.col("kept") & (F.col("n") > 1)).select("doc_id"))
    if repeated.isEmpty():
        return left
    packed = left.join(_small(repeated), "doc_id", "left_semi").select("doc_id", F.struct("*").alias("__row"))
    # A row as JSON has an order and a hash whatever its columns are.
    first = packed.groupBy("doc_id").agg(F.min_by("__row", F.sha2(F.to_json("__row"), 256)).alias("__row")).select("__row.*")
    return left.join(_small(repeated), "doc_id", "left_anti").select(*columns).union(first.select(*columns))
