"""A Merkle manifest of a table, and proofs of all rows by octopus multiproofs.

A row is a leaf. Per source the leaves ascend by id; runs of 16 neighbours are hashed into their parent until one node, the subroot, is
left; the subroots, ordered by source, give the root the same way.

Leaves are dealt out by a range sort on source, id and leaf, so a source of any size is spread over many tasks and every task holds
neighbours. Places follow from counts per task and source; no task and no driver sees all rows. Each level is one grouping of
runs, a sixteenth of the one below.

A leaf partition is a block of neighbouring leaves. For its proofs it works out the minimal union of node coordinates that it can't
derive from its own leaves, fetches these once, by one join of all partitions' coordinates with the nodes, derives the inner nodes
that its leaves share, and then expands the single proofs locally. Only the leaves at a block's edges can be asked for by
a neighbour, so only those take part in that join.

Contract. ``build_manifest`` returns the leaves, the nodes and the root; ``prove`` returns ``doc_id, leaf, subroot, root,
proof`` (the siblings' digests joined, level by level via subroot to root, left to right, empty for a single leaf), ``folded_root`` and ``verified``
per row. A proof is folded from the leaf of the changed text where ``tampered`` says so, else from the row's own leaf. A null is
written as ``-``, any other value as its UTF-8 byte count, a colon and the value. A null source is a source of its own and comes first,
as do null ids in their source; rows of one id are ordered by leaf, so equal rows may change places without a trace.
Columns other than the named ones play no part. An empty table has no root, and no proofs.
"""

import hashlib
from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from pressledger.llm.common import checkpointed

#: Children of a node, and the columns of a leaf in their order.
WIDTH = 16
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
#: Leaves in a block as a power of two, so that a block's number is a shifted row number.
BLOCK_BITS = 12
#: The group of the subroots; sources are counted from 0.
TOP = -1


def leaf_of(columns: list[Column]) -> Column:
    """Lower-case hexadecimal SHA-256 of the values, each with its length."""
    parts = []
    for c in columns:
        value = c.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*parts).cast("binary"), 256)


@dataclass
class Manifest:
    """leaves: source, doc_id, leaf, changed, grp, pos, n, row, edge; nodes: grp, level, idx, digest; root: None without rows."""

    leaves: DataFrame
    nodes: DataFrame
    sources: DataFrame
    root: str | None
    n_sources: int


def _levels(bottom: DataFrame) -> Iterator[DataFrame]:
    """From rows grp, idx, digest, n (of the level) level by level the nodes above, until each group has one."""
    here = bottom.where(F.col("n") > 1)
    while not here.isEmpty():
        run = here.groupBy("grp", F.shiftright("idx", 4).alias("idx"), "n").agg(F.array_sort(F.collect_list(F.struct(F.col("idx").alias("i"), "digest"))).alias("run"))
        joined = F.array_join(F.col("run.digest"), "")
        above = run.select("grp", "idx", F.sha2(joined.cast("binary"), 256).alias("digest"), F.floor((F.col("n") + WIDTH - 1) / WIDTH).alias("n"))
        here = checkpointed(above)
        yield here
        here = here.where(F.col("n") > 1)


def _tree(bottom: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All nodes above the leaves as grp, level, idx, digest, and the last node of each group as grp, digest."""
    own = ["grp", "idx", "digest", "n"]
    levels = list(_levels(bottom.select(*own)))
    tops = bottom.where(F.col("n") == 1).select("grp", "digest")
    nodes = None
    for number, level in enumerate(levels, 1):
        rows = level.select("grp", F.lit(number).alias("level"), "idx", "digest")
        nodes = rows if nodes is None else nodes.union(rows)
        tops = tops.union(level.where(F.col("n") == 1).select("grp", "digest"))
    if nodes is None:
        nodes = bottom.limit(0).select("grp", F.lit(0).alias("level"), "idx", "digest")
    return nodes, tops


def placed(leaves: DataFrame) -> DataFrame:
    """Leaves with the number of their source (grp), their place in it (pos), its size (n), a row number and whether they stand at
    the edge of a block. leaves: source, doc_id, leaf and further columns."""
    order = ["source", "doc_id", "leaf"]
    dealt = leaves.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = checkpointed(dealt.withColumn("row", F.monotonically_increasing_id()).withColumn("part", F.shiftright("row", 33)))
    # One row for each source that a task holds some of; neighbouring tasks share one source at most.
    parts = checkpointed(rows.groupBy("part", "source").agg(F.count("*").alias("own"), F.min("row").alias("first")))
    name = F.col("source")
    sources = parts.groupBy("source").agg(F.sum("own").alias("n"), F.min("part").alias("begins"))
    per_task = sources.groupBy("begins").agg(F.count("*").alias("started"))
    before = F.coalesce(F.sum("started").over(Window.orderBy("begins").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    per_task = per_task.select("begins", before.alias("before"))  # a row for each task at most
    inside = F.row_number().over(Window.partitionBy("begins").orderBy("source"))
    sources = sources.withColumn("inside", inside).join(per_task, "begins").select(name.alias("own_source"), "n", (F.col("before") + F.col("inside") - 1).alias("grp"))
    earlier = F.sum("own").over(Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    last = F.max(F.col("first") + F.col("own")).over(Window.partitionBy("part"))
    shape = parts.withColumn("earlier", F.coalesce(earlier, F.lit(0))).withColumn("end", last)
    shape = shape.join(sources, name.eqNullSafe(F.col("own_source"))).select(
        F.col("part").alias("of_part"), "own_source", "n", "grp", (F.col("earlier") - F.col("first")).alias("shift"), "end"
    )
    at = F.col("row").bitwiseAND((1 << BLOCK_BITS) - 1)
    edge = (at < WIDTH - 1) | (at > (1 << BLOCK_BITS) - WIDTH) | (F.col("end") - F.col("row") < WIDTH)
    # A task's rows of one source join one row; both sides are spread by the task's number as well.
    met = rows.join(shape, (F.col("part") == F.col("of_part")) & name.eqNullSafe(F.col("own_source")))
    return met.select(*leaves.columns, "grp", (F.col("row") + F.col("shift")).alias("pos"), "n", "row", edge.alias("edge"))


def build_manifest(docs: DataFrame, tampered: Column | None = None, change: Callable[[Column], Column] | None = None) -> Manifest:
    """The manifest of all rows. Where ``tampered`` holds, ``changed`` is the leaf of the row with ``change`` made to its text."""
    columns = [F.col(c) for c in COLUMNS]
    other = F.lit(None).cast("string")
    if tampered is not None and change is not None:
        text = F.col("text").cast("string")
        other = F.when(F.coalesce(tampered, F.lit(False)), leaf_of([*columns[:-1], change(text)]))
    own = docs.select(F.col("source").cast("string").alias("source"), F.col("doc_id").cast("long").alias("doc_id"), leaf_of(columns).alias("leaf"), other.alias("changed"))
    leaves = checkpointed(placed(own))
    nodes, subroots = _tree(leaves.select("grp", F.col("pos").alias("idx"), F.col("leaf").alias("digest"), "n"))
    subroots = checkpointed(subroots)
    n_sources = subroots.count()
    ranked = subroots.select(F.lit(TOP).cast("long").alias("grp"), F.col("grp").alias("idx"), "digest", F.lit(n_sources).cast("long").alias("n"))
    upper, tops = _tree(ranked)
    root = [r["digest"] for r in tops.limit(1).collect()]
    # The bottom of the upper tree counts as its level 0, like leaves.
    whole = nodes.union(upper).union(ranked.select("grp", F.lit(0).alias("level"), "idx", "digest"))
    return Manifest(leaves, whole, subroots, root[0] if root else None, n_sources)


def widths(n: int) -> list[int]:
    """Nodes on each level of a tree of n leaves."""
    out = [n]
    while out[-1] > 1:
        out.append(-(-out[-1] // WIDTH))
    return out


def missing_nodes(places: list[int], n: int) -> list[tuple[int, int]]:
    """Minimal union of coordinates (level, index) that the proofs of the leaves at these places need and can't derive."""
    out, known = [], set(places)
    for level, width in enumerate(widths(n)[:-1]):
        runs = {i // WIDTH for i in known}
        out += [(level, i) for r in sorted(runs) for i in range(r * WIDTH, min(width, (r + 1) * WIDTH)) if i not in known]
        known = runs
    return out


def _asked(n_sources: int):
    def rows(key: tuple, table: pa.Table) -> pa.Table:
        """Coordinates that one block fetches, of its sources' trees and of the tree above them."""
        own: dict[int, tuple[int, list[int]]] = {}
        for grp, pos, n in zip(*(table.column(c).to_pylist() for c in ("grp", "pos", "n")), strict=True):
            own.setdefault(grp, (n, []))[1].append(pos)
        asked = [(g, level, i) for g, (n, places) in own.items() for level, i in missing_nodes(places, n)]
        asked += [(TOP, level, i) for level, i in missing_nodes(list(own), n_sources)]
        # What a block derives itself, the subroots of its sources, isn't asked for.
        columns = list(zip(*asked, strict=True)) or [(), (), ()]
        return pa.table({
            "grp": pa.array(columns[0], pa.int64()), "level": pa.array(columns[1], pa.int32()), "idx": pa.array(columns[2], pa.int64()),
            "block": pa.array([key[0].as_py()] * len(asked), pa.int64()),
        })

    return rows


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


class _Part:
    """One tree as a block knows it: its own leaves, what it fetched, and what follows from both."""

    def __init__(self, n: int, known: dict[tuple[int, int], str], places: list[int]):
        self.widths, self.known = widths(n), known
        self.runs: dict[tuple[int, int], str] = {}
        here = set(places)
        for level, width in enumerate(self.widths[:-1]):
            here = {i // WIDTH for i in here}
            for r in here:
                joined = "".join(known[level, i] for i in range(r * WIDTH, min(width, (r + 1) * WIDTH)))
                self.runs[level, r] = joined
                known[level + 1, r] = _sha(joined)
        self.top = known[len(self.widths) - 1, 0]
        self.above: dict[tuple[int, int], str] = {}

    def siblings(self, level: int, i: int) -> str:
        joined, at = self.runs[level, i // WIDTH], 64 * (i % WIDTH)
        return joined[:at] + joined[at + 64 :]

    def proof(self, level: int, i: int) -> str:
        """Siblings from a node to the top; those above the first level are worked out once per parent."""
        if level == len(self.widths) - 1:
            return ""
        if level == 0:
            return self.siblings(0, i) + self.proof(1, i // WIDTH)
        if (level, i) not in self.above:
            self.above[level, i] = self.siblings(level, i) + self.proof(level + 1, i // WIDTH)
        return self.above[level, i]

    def folded(self, i: int, digest: str) -> str:
        """The top that follows from a digest in the place of leaf i; known nodes are used as far as the digests agree."""
        for level in range(len(self.widths) - 1):
            if self.known[level, i] == digest:
                return self.top
            joined, at = self.runs[level, i // WIDTH], 64 * (i % WIDTH)
            digest, i = _sha(joined[:at] + digest + joined[at + 64 :]), i // WIDTH
        return digest


_PROVED = "doc_id long, leaf string, subroot string, root string, proof string, folded_root string, verified boolean"


def _expanded(root: str, n_sources: int):
    def proofs(leaves: pa.Table, fetched: pa.Table) -> pa.Table:
        known: dict[int, dict[tuple[int, int], str]] = defaultdict(dict)
        for grp, level, idx, digest in zip(*(fetched.column(c).to_pylist() for c in ("grp", "level", "idx", "digest")), strict=True):
            known[grp][level, idx] = digest
        ids, leaf, changed, grps, pos, n = (leaves.column(c).to_pylist() for c in ("doc_id", "leaf", "changed", "grp", "pos", "n"))
        places: dict[int, list[int]] = defaultdict(list)
        sizes = dict(zip(grps, n, strict=True))
        for g, i, digest in zip(grps, pos, leaf, strict=True):
            known[g][0, i] = digest
            places[g].append(i)
        trees = {g: _Part(sizes[g], known[g], own) for g, own in places.items()}
        for g, tree in trees.items():
            known[TOP][0, g] = tree.top
        upper = _Part(n_sources, known[TOP], list(trees))
        out: dict[str, list] = {x: [] for x in ("subroot", "proof", "folded_root")}
        for g, i, digest, other in zip(grps, pos, leaf, changed, strict=True):
            tree = trees[g]
            out["subroot"].append(tree.top)
            out["proof"].append(tree.proof(0, i) + upper.proof(0, g))
            out["folded_root"].append(upper.folded(g, tree.folded(i, other or digest)))
        return pa.table({
            "doc_id": pa.array(ids, pa.int64()), "leaf": pa.array(leaf, pa.string()), "subroot": pa.array(out["subroot"], pa.string()), "root": pa.array([root] * len(ids), pa.string()),
            "proof": pa.array(out["proof"], pa.string()), "folded_root": pa.array(out["folded_root"], pa.string()),
            "verified": pa.array([x == root for x in out["folded_root"]], pa.bool_()),
        })

    return proofs


def prove(manifest: Manifest) -> DataFrame:
    """doc_id, leaf, subroot, root, proof, folded_root, verified for every row of the manifest; see the module's contract."""
    spark = manifest.leaves.sparkSession
    if manifest.root is None:
        return spark.createDataFrame([], _PROVED)
    leaves = manifest.leaves.withColumn("block", F.shiftright("row", BLOCK_BITS))
    asked = leaves.select("block", "grp", "pos", "n").groupBy("block").applyInArrow(_asked(manifest.n_sources), "grp long, level int, idx long, block long")
    edges = leaves.where("edge").select("grp", F.lit(0).alias("level"), F.col("pos").alias("idx"), F.col("leaf").alias("digest"))
    fetched = asked.join(manifest.nodes.union(edges), ["grp", "level", "idx"]).select("block", "grp", "level", "idx", "digest")
    own = leaves.select("block", "doc_id", "leaf", "changed", "grp", "pos", "n")
    return own.groupBy("block").cogroup(fetched.groupBy("block")).applyInArrow(_expanded(manifest.root, manifest.n_sources), _PROVED)
