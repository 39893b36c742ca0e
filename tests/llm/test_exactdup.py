"""Exact groups against a dictionary: hot and cold digests, forced digest clashes, odd rows."""

import collections
import hashlib

import pytest
from pyspark.sql import functions as F

from pressledger.llm import exactdup

SCHEMA = "doc_id long, text string, source string"


def rows_of(n=400):
    rows = [(i, f"text {i % 37}" if i % 3 else f"only {i}", "s") for i in range(n)]
    rows += [(n + i, "hot text " * 50, "hot") for i in range(300)]
    rows += [
        (2001, None, None), (2002, "", "a"), (2003, " ", "a"), (2003, " ", "a"), (None, "text 5", "a"), (None, "no id", None), (None, "no id", "b"),
        (2004, "long " * 50_000, "a"), (2005, "long " * 50_000, "a"), (2006, "Text 5", "a"), (2007, "漢字 é", "a"), (2008, "漢字 é", "a"),
    ]
    return rows


def table(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    clashing = {c: F.lit("z") for c in ("digest", "salt", "keep_id", "hot", "n", "group_size", "sha", "id", "row", "a.b")}
    return df.withColumns(clashing).withColumn("kinds", F.create_map(F.lit("k"), F.col("source"))).repartition(5)


def expected(rows, change=lambda t: t):
    groups = collections.defaultdict(list)
    for i, t, _ in rows:
        groups[change(t or "")].append(i)
    out = []
    for i, t, _ in rows:
        own = groups[change(t or "")]
        keep = max((x for x in own if x is not None), default=None)
        out.append((i, keep, len(own), i == keep, hashlib.sha256(change(t or "").encode()).hexdigest()))
    return sorted(out, key=repr)


def found(df):
    assert df.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("one_in", [4096, 8, 1])
def test_groups_whatever_is_hot(spark, one_in):
    rows = rows_of()
    assert found(exactdup.exact_groups(table(spark, rows), one_in=one_in)) == expected(rows)


def test_texts_that_share_a_digest_stay_apart(spark):
    rows = rows_of()
    first_letter = lambda text: F.substring(text, 1, 1).cast("binary")
    for one_in in (4096, 4):
        assert found(exactdup.exact_groups(table(spark, rows), digest=first_letter, one_in=one_in)) == expected(rows)


def test_normalised_texts(spark):
    rows = rows_of(60)
    assert found(exactdup.exact_groups(table(spark, rows), normalise=F.lower)) == expected(rows, str.lower)


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert exactdup.exact_groups(empty).count() == 0 and exactdup.drop_copies(empty).count() == 0


def test_one_whole_row_of_each_group_is_left(spark):
    rows = rows_of()
    docs = table(spark, rows)
    left = exactdup.drop_copies(docs)
    assert left.columns == docs.columns
    got = left.select("doc_id", "text", "source", F.col("`a.b`").alias("ab"), "kinds").collect()
    assert len(got) == len({t or "" for _, t, _ in rows}) and {r.ab for r in got} == {"z"}
    best = {t or "": max((i for i, u, _ in rows if (u or "") == (t or "") and i is not None), default=None) for _, t, _ in rows}
    assert {r.text or "": r.doc_id for r in got} == best


def test_copies_are_combined_before_the_shuffle(spark):
    """Of a hot text a task sends one row; the rows that meet its salts are no more than tasks."""
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("the same long text").alias("text")).repartition(6)
    rows = exactdup._rows(docs, None, exactdup.sha256_of)
    hot = exactdup.hot_digests(rows.select("doc_id", "digest"), 4096)
    frequent, rest = exactdup.combined(rows, hot)
    assert [tuple(r)[1:] for r in frequent.collect()] == [(3999, 4000)] and rest.count() == 0
