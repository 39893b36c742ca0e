"""Manifest and proofs against a plain tree built in memory."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from pressledger.llm import manifest

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


def leaf(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def climb(digests, i, own):
    """Proof of leaf i, the folded top with ``own`` in its place, and the true top."""
    proof, here = [], list(digests)
    while len(here) > 1:
        run = here[i // 16 * 16 : i // 16 * 16 + 16]
        proof += run[: i % 16] + run[i % 16 + 1 :]
        own = sha("".join([*run[: i % 16], own, *run[i % 16 + 1 :]]))
        here = [sha("".join(here[k : k + 16])) for k in range(0, len(here), 16)]
        i //= 16
    return proof, own, here[0]


def expected(rows, changed):
    sources = sorted({r[1] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    held = {s: sorted(((r[0] is not None, r[0] or 0, leaf(r), r) for r in rows if r[1] == s), key=lambda x: x[:3]) for s in sources}
    subroots = [climb([x[2] for x in held[s]], 0, held[s][0][2])[2] for s in sources]
    out = []
    for g, s in enumerate(sources):
        digests = [x[2] for x in held[s]]
        for i, (_, _, own, row) in enumerate(held[s]):
            other = leaf((*row[:4], None if row[4] is None else row[4].lower())) if changed(row) else own
            low, folded, _ = climb(digests, i, other)
            high, folded, root = climb(subroots, g, folded)
            out.append((row[0], own, subroots[g], root, "".join(low + high), folded, folded == root))
    return sorted(out, key=repr)


def check(spark, rows, parts=5):
    docs = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("z") for c in ("grp", "pos", "n", "row", "leaf", "digest", "block", "a.b")})
    bad = F.col("doc_id") % 3 == 0
    built = manifest.build_manifest(docs.repartition(parts), bad, F.lower)
    got = manifest.prove(built)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof", "folded_root", "verified"]
    assert sorted(map(tuple, got.collect()), key=repr) == expected(rows, lambda r: r[0] is not None and r[0] % 3 == 0)


def documents(sizes, seed=1):
    rng = random.Random(seed)
    rows = []
    for source, n in sizes.items():
        rows += [(rng.randrange(10**6), source, rng.choice(["en", None]), rng.choice([1, None]), rng.choice(["Ab c", "é漢", "", None, "lower"])) for _ in range(n)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("sizes", [
    {"a": 1}, {"a": 2, "b": 1}, {"a": 16, None: 17, "é": 1}, {"hot": 700, "a": 257, "b": 256, None: 33, "": 3}, {f"s{i}": 1 + i % 3 for i in range(40)},
])
def test_proofs_of_trees_of_all_shapes(spark, sizes):
    check(spark, documents(sizes))


def test_small_blocks_fetch_what_they_miss(spark, monkeypatch):
    monkeypatch.setattr(manifest, "BLOCK_BITS", 5)
    check(spark, documents({"hot": 900, "b": 300, "c": 1}), parts=3)


def test_odd_rows(spark):
    rows = documents({"a": 40, None: 3})
    rows += [(None, "a", None, None, None), (None, "a", None, None, None), (5, "a", "en", 1, "same"), (5, "a", "en", 1, "same"), (5, "a", "en", 1, "Other"), (6, "a", "x", 2, "Y" * 100_000)]
    check(spark, rows)


def test_empty_table(spark):
    built = manifest.build_manifest(spark.createDataFrame([], SCHEMA))
    assert built.root is None and manifest.prove(built).count() == 0


def test_minimal_union():
    rng = random.Random(4)
    for n in (1, 2, 16, 17, 300, 5000):
        for _ in range(20):
            places = rng.sample(range(n), min(n, rng.randrange(1, 30)))
            asked = manifest.missing_nodes(places, n)
            assert len(asked) == len(set(asked))
            derived, widths = set(places), manifest.widths(n)
            for level, width in enumerate(widths[:-1]):
                fetched = {i for at, i in asked if at == level}
                # Nothing is fetched that could be derived, and every run on the way up is whole.
                assert not fetched & derived
                runs = {i // 16 for i in derived}
                assert derived | fetched == {i for r in runs for i in range(16 * r, min(width, 16 * r + 16))}
                derived = runs
            assert derived == {0}
