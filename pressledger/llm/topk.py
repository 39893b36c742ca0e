"""Exact top-k inner products over norm-sorted blocks.

Components become integers floor(scale * x). Vectors are range-sorted by falling length and packed into
blocks; queries are packed too. The longest block gives each query a k-th score to beat. Cauchy-Schwarz
then bounds every other block by |query| x longest vector: blocks come in order of length, so a group of
queries needs a prefix of them, and only those cells are shipped. Inside a cell vectors are processed by falling
length in slices; both sides are rotated by the singular vectors of a sample, partial sums over the
leading coordinates plus the product of the two residual lengths bound each score, and what passes is
scored exactly in integers. Any rotation gives right bounds, so fitting it on a sample loses nothing.

Contract. ``top_inner_products`` returns ``query_id, rank, vec_id, score``: each query's k highest scores
(all, if fewer), equal scores by smaller id, rows of the query's own id left out. A null vector, a null or
non-finite component, or a null id takes no part. Only vectors of one length meet; vectors of no
components score 0. A repeated query id is asked once, with its smallest vector; a candidate row that repeats an
id counts as often as it stands there. Scores must fit a long.
Only the two named columns are read. No group grows with the data: a cell is at most ``GROUPS`` query
blocks against one vector block. The driver sees one length per block and one bounded block.
"""

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from pressledger.llm.common import checkpointed

BLOCK_ROWS = 8192
QUERY_ROWS = 512
SLICE_ROWS = 1024
#: Query blocks that meet a vector block in one task.
GROUPS = 64
SAMPLE_ROWS = 8192
ENERGY = 0.9
SLACK = 1e-9
_PACKED = "dim int, part int, seq int, top double, n int, ids binary, vecs binary"


def whole_components(vector: Column, scale: int) -> Column:
    return F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))


def usable(vector: Column) -> Column:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(False))


def _prepared(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """vec_id, dim, vec (bytes of int64), len: one row per usable vector."""
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("v"))
    rows = rows.where(F.col("vec_id").isNotNull() & usable(F.col("v")))
    rows = rows.select("vec_id", F.size("v").alias("dim"), whole_components(F.col("v"), scale).alias("vec"))
    square = F.aggregate("vec", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    return rows.withColumn("len", F.sqrt(square))


def _packer(rows_each: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Blocks of one dimension from rows sorted by dimension and falling length."""
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        part, seq, dim = 0, 0, None

        def flush():
            nonlocal held, seq
            ids, lens, vecs = (np.concatenate(x) for x in zip(*held, strict=True))
            seq += 1
            held = []
            return pa.RecordBatch.from_pydict({
                "dim": pa.array([dim], pa.int32()), "part": pa.array([part], pa.int32()), "seq": pa.array([seq], pa.int32()),
                "top": pa.array([float(lens.max())], pa.float64()), "n": pa.array([len(ids)], pa.int32()),
                "ids": pa.array([ids.tobytes()], pa.binary()), "vecs": pa.array([vecs.tobytes()], pa.binary()),
            })

        for batch in batches:
            dims = batch.column(1).to_numpy(zero_copy_only=False)
            part = int(batch.column(4)[0].as_py()) if len(batch) else part
            cuts = [0, *(np.flatnonzero(np.diff(dims)) + 1).tolist(), len(dims)]
            for i, j in zip(cuts, cuts[1:]):
                while i < j:
                    if held and int(dims[i]) != dim:
                        yield flush()
                    dim = int(dims[i])
                    step = min(j - i, rows_each - sum(len(x[0]) for x in held))
                    rows = batch.slice(i, step)
                    values = rows.column(3).flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                    held.append((rows.column(0).to_numpy(zero_copy_only=False).astype(np.int64), rows.column(2).to_numpy(zero_copy_only=False), values))
                    i += step
                    if sum(len(x[0]) for x in held) >= rows_each:
                        yield flush()
        if held:
            yield flush()

    return pack


def packed(prepared: DataFrame, rows_each: int) -> DataFrame:
    """Range-sorted by falling length; long runs of one length are split by id."""
    parts = max(1, math.ceil(prepared.count() / rows_each))
    dealt = prepared.repartitionByRange(parts, "dim", F.desc("len"), F.xxhash64("vec_id")).coalesce(parts)
    ordered = dealt.sortWithinPartitions("dim", F.desc("len"), "vec_id")
    rows = ordered.select("vec_id", "dim", "len", "vec", F.spark_partition_id().alias("part"))
    return rows.mapInArrow(_packer(rows_each), _PACKED)


def rotations(prepared: DataFrame, rows: int) -> dict[int, tuple[np.ndarray, int]]:
    """Per dimension the singular vectors of a bounded sample, and how many hold most of its energy."""
    def gram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for dim, vec in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                v = np.array(vec, dtype=np.float64)
                sums[dim] = sums.get(dim, 0) + np.outer(v, v)
        yield pa.RecordBatch.from_pydict({
            "dim": pa.array(list(sums), pa.int32()), "g": pa.array([x.tobytes() for x in sums.values()], pa.binary()),
        })

    sample = prepared.orderBy(F.xxhash64("vec_id", F.lit(3)), "vec_id").limit(rows).select("dim", "vec")
    out = {}
    for r in sample.coalesce(1).mapInArrow(gram, "dim int, g binary").collect():
        if r["dim"]:
            values, vectors = np.linalg.eigh(np.frombuffer(r["g"]).reshape(r["dim"], r["dim"]))
            values, vectors = np.maximum(values[::-1], 0), vectors[:, ::-1]
            share = np.cumsum(values) / max(values.sum(), 1e-300)
            out[r["dim"]] = (np.ascontiguousarray(vectors), min(r["dim"], int(np.searchsorted(share, ENERGY)) + 1))
    return out


def _best(q: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best per query number, by falling score, then id."""
    order = np.lexsort((ids, -scores, q))
    q, ids, scores = q[order], ids[order], scores[order]
    first = np.flatnonzero(np.concatenate(([True], q[1:] != q[:-1]))) if len(q) else np.zeros(0, dtype=np.int64)
    sizes = np.diff(np.append(first, len(q)))
    keep = np.arange(len(q)) - np.repeat(first, sizes) < k
    return q[keep], ids[keep], scores[keep]


def score_cell(qids, qvecs, ids, vecs, rotation, k, floors):
    """Exact best k of a block for each query of a block; floors: a score each query has k times elsewhere.

    Vectors come by falling length. Returns query numbers, ids and scores.
    """
    dim = qvecs.shape[1]
    basis, lead = rotation if rotation is not None else (np.eye(dim), dim)
    qf, vf = qvecs.astype(np.float64), vecs.astype(np.float64)
    qlen, vlen = np.sqrt((qf * qf).sum(1)), np.sqrt((vf * vf).sum(1))
    qrot, vrot = qf @ basis, vf @ basis
    qrest, vrest = (np.sqrt((x[:, lead:] ** 2).sum(1)) for x in (qrot, vrot))
    exact_floats = (qlen.max(initial=0) * vlen.max(initial=0)) < 2**52
    floors = floors.astype(np.float64).copy()
    held = tuple(np.zeros(0, dtype=np.int64) for _ in range(3))
    for at in range(0, len(ids), SLICE_ROWS):
        part = slice(at, at + SLICE_ROWS)
        reach = qlen * vlen[part].max()
        live = np.flatnonzero(reach * (1 + SLACK) + SLACK >= floors)
        if not len(live):
            break
        bound = qrot[live][:, :lead] @ vrot[part, :lead].T + qrest[live, None] * vrest[None, part]
        slack = SLACK * (1 + reach[live, None])
        qi, vi = np.nonzero((bound + slack >= floors[live, None]) & (qids[live, None] != ids[None, part]))
        if not len(qi):
            continue
        if exact_floats and len(qi) * 8 > bound.size:
            scores = (qf[live] @ vf[part].T)[qi, vi].astype(np.int64)
        else:
            scores = np.concatenate([np.einsum("ij,ij->i", qvecs[live[qi[i : i + 65536]]], vecs[part][vi[i : i + 65536]]) for i in range(0, len(qi), 65536)])
        fit = scores >= floors[live[qi]]
        new = live[qi[fit]], ids[part][vi[fit]], scores[fit]
        held = _best(*(np.concatenate(x) for x in zip(held, new, strict=True)), k)
        last = np.flatnonzero(np.bincount(held[0], minlength=len(qids)) >= k)
        if len(last):
            ends = np.searchsorted(held[0], last, side="right") - 1
            floors[last] = np.maximum(floors[last], held[2][ends])
    return held


def _matrix(row_ids: bytes, row_vecs: bytes, dim: int) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(row_ids, dtype=np.int64)
    return ids, np.frombuffer(row_vecs, dtype=np.int64).reshape(len(ids), dim)


def top_inner_products(
    vectors: DataFrame, queries: DataFrame, k: int = 5, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """The k best rows of ``vectors`` for every row of ``queries``; see the module's contract."""
    prepared = checkpointed(_prepared(vectors, id_col, vector_col, scale))
    asked = _prepared(queries, id_col, vector_col, scale).groupBy("vec_id").agg(F.min(F.struct("dim", "vec", "len")).alias("q"))
    asked = checkpointed(asked.select("vec_id", "q.*").select("vec_id", "dim", "vec", "len"))
    turn = rotations(prepared, SAMPLE_ROWS)
    blocks = checkpointed(packed(prepared, BLOCK_ROWS))
    order: list[tuple[int, int, int, int]] = []
    lengths: dict[int, list[float]] = {}
    seeds: dict[int, tuple[int, int]] = {}
    for r in blocks.select("dim", "part", "seq", "top").orderBy("dim", F.desc("top"), "part", "seq").collect():
        order.append((r["dim"], r["part"], r["seq"], len(lengths.setdefault(r["dim"], []))))
        lengths[r["dim"]].append(r["top"])
        seeds.setdefault(r["dim"], (r["part"], r["seq"]))
    first = {}
    for dim, (part, seq) in seeds.items():
        r = blocks.where((F.col("dim") == dim) & (F.col("part") == part) & (F.col("seq") == seq)).first()
        first[dim] = (bytes(r["ids"]), bytes(r["vecs"]))
    tops = {dim: np.array(x) for dim, x in lengths.items()}

    def routed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for each vector block that a query block needs."""
        for batch in batches:
            for r in batch.to_pylist():
                dim = r["dim"]
                if dim not in tops:
                    continue
                qids, qvecs = _matrix(r["ids"], r["vecs"], dim)
                none = np.full(len(qids), -np.inf)
                q, _, scores = score_cell(qids, qvecs, *_matrix(*first[dim], dim), turn.get(dim), k, none)
                floors = none.copy()
                full = np.flatnonzero(np.bincount(q, minlength=len(qids)) >= k)
                floors[full] = scores[np.searchsorted(q, full, side="right") - 1]
                qlen = np.sqrt((qvecs.astype(np.float64) ** 2).sum(1))
                reach = (tops[dim][:, None] * qlen[None, :] * (1 + SLACK) + SLACK >= floors).any(axis=1)
                need = np.flatnonzero(reach)
                group = r["part"] // GROUPS
                for i in need:
                    yield pa.RecordBatch.from_pydict({
                        "dim": pa.array([dim], pa.int32()), "place": pa.array([int(i)], pa.int32()), "grp": pa.array([group], pa.int32()),
                        "ids": pa.array([r["ids"]], pa.binary()), "vecs": pa.array([r["vecs"]], pa.binary()), "floors": pa.array([floors.tobytes()], pa.binary()),
                    })

    cells = checkpointed(packed(asked, QUERY_ROWS).mapInArrow(routed, "dim int, place int, grp int, ids binary, vecs binary, floors binary"))
    # The driver has put the blocks in order already, one small row each.
    columns = [pa.array(x, pa.int32()) for x in zip(*order, strict=True)] or [pa.array([], pa.int32())] * 4
    places = vectors.sparkSession.createDataFrame(pa.Table.from_arrays(columns, names=["dim", "part", "seq", "place"]))
    placed = blocks.join(places, ["dim", "part", "seq"]).select("dim", "ids", "vecs", "place")
    wanted = cells.select("dim", "place", F.col("grp").alias("for_grp")).distinct()
    sides = placed.join(wanted, ["dim", "place"])

    def met(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for b in right.to_pylist():
            ids, vecs = _matrix(b["ids"], b["vecs"], b["dim"])
            for r in left.to_pylist():
                qids, qvecs = _matrix(r["ids"], r["vecs"], r["dim"])
                q, found, scores = score_cell(qids, qvecs, ids, vecs, turn.get(r["dim"]), k, np.frombuffer(r["floors"]))
                out.append((qids[q], found, scores))
        cols = [np.concatenate(x) for x in zip(*out, strict=True)] if out else [np.zeros(0, dtype=np.int64)] * 3
        return pa.table({name: pa.array(x, pa.int64()) for name, x in zip(("query_id", "vec_id", "score"), cols, strict=True)})

    met_in = sides.groupBy("dim", "place", "for_grp")
    pairs = cells.groupBy("dim", "place", "grp").cogroup(met_in).applyInArrow(met, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = pairs.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
