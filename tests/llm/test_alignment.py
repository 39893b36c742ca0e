"""Alignment against a walk over both tokenisations, with ids straight from the libraries."""

import collections
import random

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pressledger.llm import alignment
from pressledger.llm.pretokens import vocabulary

A, B = vocabulary(), vocabulary("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string"
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]


@pytest.fixture(scope="module")
def libraries():
    first = Tokenizer.from_file(A)
    first.encode_special_tokens = True
    return first, sentencepiece.SentencePieceProcessor(model_file=B), alignment.Sides(A, B)


def groups_of(text, libraries):
    first, second, both = libraries
    if not text:
        return []
    ids_a, ids_b = first.encode(" " + text, add_special_tokens=False).ids, second.encode(text)
    whole = (" " + text).encode()
    if b"".join(both.bytes_a[i] for i in ids_a) != whole or b"".join(both.bytes_b[i] for i in ids_b) != whole:
        return []
    out, own_a, own_b, j, end_a, end_b = [], [], [], 0, 0, 0
    for i in ids_a:
        own_a.append(i)
        end_a += len(both.bytes_a[i])
        while j < len(ids_b) and end_b + len(both.bytes_b[ids_b[j]]) <= end_a:
            end_b += len(both.bytes_b[ids_b[j]])
            own_b.append(ids_b[j])
            j += 1
        if end_a == end_b:
            out.append((own_a, own_b))
            own_a, own_b = [], []
    assert not own_a and not own_b and j == len(ids_b)
    return out


def expected(rows, libraries):
    cut = [groups_of(t, libraries) for _, t in rows]
    counts = collections.Counter(p for groups in cut for p in {(a, b) for x, y in groups for a in x for b in y})
    most = collections.Counter()
    for (a, _), n in counts.items():
        most[a] = max(most[a], n)
    out = []
    for (doc_id, _), groups in zip(rows, cut, strict=True):
        links = [(a, b) for x, y in groups for a in x for b in y]
        out.append((
            doc_id, sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups), len(links), sum(counts[p] == most[p[0]] for p in links),
            sum(counts[p] for p in links), ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups),
        ))
    return sorted(out, key=repr)


def found(spark, rows, parts=4):
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("z") for c in ("block", "bucket", "data", "n_a", "groups", "a.b")})
    got = alignment.align(df.repartition(parts), A, B)
    assert got.columns == COLUMNS
    return sorted(map(tuple, got.collect()), key=repr)


def odd_rows(seed=2, n=120):
    rng = random.Random(seed)
    words = ["the", "Zerbolid", "straße", "naïve", "漢字", "don't", "1234567", "foo_bar", "</s>", "<|endoftext|>", "\n", "a\tb", "😀😀", "x" * 40, "е́", " ", " x"]
    joins = [" ", " ", " ", "  ", "\n", " \n ", "   ", ""]
    rows = [(i, "".join(rng.choice(words) + rng.choice(joins) for _ in range(rng.randrange(1, 60)))) for i in range(n)]
    rows += [
        (900, None), (901, ""), (902, " "), (903, "  leading"), (904, "trailing  "), (905, "with ▁ mark"), (906, "▁"), (None, "no id here"), (907, "same"), (907, "same"),
        (908, "word " * 30_000), (909, "y" * 100_000), (910, "\0 nul"), (911, "<0x41> <unk> <s>"), (912, "\n\n a"), (913, "  b"), (914, "é́ ́"),
    ]
    return rows


def test_against_both_libraries(spark, libraries):
    rows = odd_rows()
    assert found(spark, rows) == expected(rows, libraries)


def test_small_blocks_and_many_buckets(spark, libraries, monkeypatch):
    monkeypatch.setattr(alignment, "BLOCK_CHARS", 2000)
    monkeypatch.setattr(alignment, "LEAST_BUCKETS", 301)
    rows = odd_rows(5, 60)
    assert found(spark, rows, parts=2) == expected(rows, libraries)


def test_test_tables(spark, small, libraries):
    rows = [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    assert found(spark, rows) == expected(rows, libraries)


def test_empty_table(spark):
    assert found(spark, []) == []


def test_terminals_of_random_cuts():
    rng = np.random.default_rng(6)
    for _ in range(50):
        size = int(rng.integers(2, 400))
        a, b = (np.unique(np.append(rng.choice(size, rng.integers(0, size // 2 + 1), replace=False) + 1, size)) for _ in range(2))
        common = np.intersect1d(a, b)
        last_a, last_b = alignment.terminals(a, b)
        assert (a[last_a] == common[np.searchsorted(common, a)]).all() and (a[last_b] == common[np.searchsorted(common, b)]).all()


def test_a_long_chain_without_common_ends_converges():
    a = np.append(np.arange(1, 100_001, 2), 100_001)
    b = np.append(np.arange(2, 100_000, 2), 100_001)
    last_a, last_b = alignment.terminals(np.unique(a), np.unique(b))
    assert len(set(last_a.tolist())) == 1 and set(last_b.tolist()) == set(last_a.tolist())


def test_numbers_survive_packing():
    arrays = [np.array([], dtype=np.int64), np.array([0, 255]), np.array([-5, 1 << 60]), np.arange(70_000), np.array([1 << 40])]
    for x, y in zip(arrays, alignment.unpacked(alignment.packed(*arrays)), strict=True):
        assert x.tolist() == y.tolist()
