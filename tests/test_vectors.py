import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from pressledger import rules
from pressledger.operators import similarity, tfidf


def brute_force(ids, matrix, n):
    """Top n others by rounded score, then position."""
    scores = np.round(matrix @ matrix.T, 8)
    out = {}
    for i in range(len(ids)):
        order = sorted((j for j in range(len(ids)) if j != i), key=lambda j: (-scores[i, j], j))[:n]
        out[ids[i]] = [ids[j] for j in order]
    return out


def lists_of(spark, matrix, n=3, **options):
    ids = [f"a{i:04d}" for i in range(len(matrix))]
    rows = [(a, i, [float(x) for x in v]) for i, (a, v) in enumerate(zip(ids, matrix))]
    df = spark.createDataFrame(rows, "article_id string, position bigint, embedding array<double>").repartition(5)
    found = similarity.similar_list(df, n, **options)
    return ids, {r.article_id: [x.article_id for x in r.neighbours] for r in found.collect()}


@pytest.mark.parametrize("seed", [0, 1])
def test_neighbours_equal_brute_force_with_copies_zeros_and_clusters(spark, seed):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, 8))
    rows = centres[rng.integers(0, 6, 120)] + 0.05 * rng.normal(size=(120, 8))
    rows /= np.linalg.norm(rows, axis=1, keepdims=True)
    copies = np.repeat(rows[:1], 60, axis=0)  # a third of all rows
    matrix = np.vstack([rows, copies, np.zeros((3, 8)), rows[5:8]])
    matrix = matrix[rng.permutation(len(matrix))]
    ids, got = lists_of(spark, matrix, block_rows=8, max_pivots=4, target_rows=20)
    assert got == brute_force(ids, matrix, 3)


def test_vectors_need_not_be_unit_length(spark):
    rng = np.random.default_rng(5)
    matrix = rng.normal(size=(70, 4)) * rng.uniform(0.1, 20, size=(70, 1))
    ids, got = lists_of(spark, matrix, block_rows=4, max_pivots=3)
    assert got == brute_force(ids, matrix, 3)


def test_few_vectors(spark):
    ids, got = lists_of(spark, np.array([[1.0, 0], [0.9, 0.1], [0, 1], [-1, 0]]))
    assert all(len(v) == 3 and k not in v and len(set(v)) == 3 for k, v in got.items())
    ids, got = lists_of(spark, np.array([[1.0, 0], [1.0, 0]]))
    assert got == {"a0000": ["a0001"], "a0001": ["a0000"]}
    ids, got = lists_of(spark, np.array([[1.0, 0]]))
    assert got == {"a0000": []}


def test_bridge_and_ids(spark):
    rows = [(f"a{i}", i, v) for i, v in enumerate([[1.0, 0.0], [0.8, 0.6], [0.0, 1.0], [1.0, 0.0]])]
    df = spark.createDataFrame(rows, "article_id string, position bigint, embedding array<float>")
    lists = similarity.similar_list(df)
    bridge = similarity.similarity_bridge(lists)
    assert bridge.count() == 12
    first = bridge.filter("source_article_id = 'a0'").orderBy("similarity_rank").collect()
    assert [(r.similar_article_id, r.similarity_rank) for r in first] == [("a3", 1), ("a1", 2), ("a2", 3)]
    assert [r.similarity_score for r in first] == pytest.approx([1.0, 0.8, 0.0])
    ids = {r.article_id: r.top_similar_articles for r in similarity.similar_ids(lists).collect()}
    assert ids["a0"] == ["a3", "a1", "a2"]


def test_vector_checks(spark):
    rows = [("a", [1.0, 0.0]), ("b", [float("nan"), 0.0]), ("c", [float("inf"), 0.0]), ("d", [1.0]), ("e", None), ("f", [3.0, 4.0])]
    df = spark.createDataFrame(rows, "article_id string, embedding array<double>")
    assert sorted(r.article_id for r in similarity.bad_vectors(df, 2).collect()) == ["b", "c", "d", "e"]
    unit = similarity.normalize_vectors(df.filter("article_id IN ('a', 'f')"))
    assert {r.article_id: r.embedding for r in unit.collect()} == {"a": [1.0, 0.0], "f": [0.6, 0.8]}
    assert similarity.vector_profile(df).first().non_finite == 2


DOCS = [
    "The market for cloud software grew; cloud software wins.",
    "Cloud growth: AI_ML models and big data",
    "Étude du marché — big data, big data!",
    "a I the of",
    "",
]


def by_hand(docs, size):
    def terms(text):
        words = [w for w in re.findall(r"[^\W]{2,}", text.lower()) if w not in rules.STOP_WORDS]
        return words + [f"{a} {b}" for a, b in zip(words, words[1:])]
    counted = [Counter(terms(d)) for d in docs]
    corpus = sum(counted, Counter())
    kept = sorted(sorted(corpus, key=lambda t: (-corpus[t], t))[:size])
    df = {t: sum(t in c for c in counted) for t in kept}
    idf = {t: math.log((1 + len(docs)) / (1 + df[t])) + 1 for t in kept}
    vectors = []
    for c in counted:
        v = np.array([c[t] * idf[t] for t in kept])
        norm = np.linalg.norm(v)
        vectors.append(v / norm if norm else v)
    return kept, idf, corpus, df, vectors


@pytest.mark.parametrize("size", [5, 384])
def test_tfidf_equals_hand_computation(spark, size):
    kept, idf, corpus, df, vectors = by_hand(DOCS, size)
    docs = spark.createDataFrame(list(enumerate(DOCS)), "id int, text string")
    vocabulary = {r.term: r for r in tfidf.vocabulary_frame(docs, "text", size).collect()}
    assert sorted(vocabulary, key=lambda t: vocabulary[t].idx) == kept
    for t in kept:
        assert (vocabulary[t].corpus_count, vocabulary[t].document_frequency) == (corpus[t], df[t])
        assert vocabulary[t].idf == pytest.approx(idf[t])
    model = tfidf.fit_tfidf(docs, "text", size)
    got = {r.id: r.embedding for r in model.transform(docs, "text").collect()}
    for i, v in enumerate(vectors):
        assert got[i] == pytest.approx(list(v))
    weights = tfidf.term_weights(model.transform(docs, "text"), model, "id")
    assert weights.count() == sum(int((v != 0).sum()) for v in vectors)


def test_transform_is_one_narrow_stage(spark):
    docs = spark.createDataFrame(list(enumerate(DOCS)), "id int, text string")
    plan = tfidf.fit_tfidf(docs, "text").transform(docs, "text")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
