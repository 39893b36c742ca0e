"""Steps whose cost must not grow faster than their input."""

import pytest
from pyspark.sql import functions as F

from pressledger.operators import tfidf
from tests.test_vectors import DOCS
from workloads.queries import QUERIES


@pytest.mark.parametrize("size", [1, 3, 5, 9])
def test_terms_that_cannot_be_frequent_are_not_counted(spark, size):
    docs = spark.createDataFrame(list(enumerate(DOCS * 3 + ["cloud market cloud market", "rare words here only"])), "id int, text string")
    some = tfidf.with_frequent_terms(docs.select("text"), "text", "terms", tfidf.rules.STOP_WORDS, size)
    every = tfidf.with_terms(docs.select("text"), "text")
    counted = tfidf.term_counts(some).count()
    assert counted < tfidf.term_counts(every).count()
    order = lambda df: [tuple(r) for r in tfidf.fit_vocabulary(df, docs.count(), size=size).orderBy("idx").collect()]
    assert order(some) == order(every)


def test_few_words_keep_all_pairs(spark):
    docs = spark.createDataFrame([("alpha beta",), ("beta alpha",)], "text string")
    assert tfidf.frequent_words(docs.select(tfidf.words(F.col("text")).alias("w")), "w", 3) is None
    assert sorted(r.term for r in tfidf.vocabulary_frame(docs, "text", 4).collect()) == ["alpha", "alpha beta", "beta", "beta alpha"]


def test_fingerprint_has_no_fixed_number_of_partitions(spark, small):
    plan = QUERIES["input_fingerprint"](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert "REBALANCE_PARTITIONS_BY_COL" in plan and "RoundRobinPartitioning(3)" not in plan


def test_vectors_are_hashed_once_and_not_sorted(spark, monkeypatch):
    """Only keys and positions are checkpointed and sorted for finding copies."""
    from pressledger.operators import similarity

    seen = []
    original = similarity.checkpointed
    monkeypatch.setattr(similarity, "checkpointed", lambda df: seen.append(df.columns) or original(df))
    rows = [(i, i, [float(i % 3), 1.0]) for i in range(30)]
    vectors = spark.createDataFrame(rows, "article_id bigint, position bigint, embedding array<double>")
    assert similarity.similar_list(vectors).count() == 30
    assert seen == [["article_id", "position", "vector_key"], ["vector_key", "members"]]
    keys = vectors.select("embedding", similarity.vector_key(F.col("embedding")).alias("k")).distinct()
    assert keys.count() == 3 and {len(r.k) for r in keys.collect()} == {16}


def test_generated_parsing_methods_stay_small_enough_for_the_jit(spark, capsys):
    """The JVM never compiles a method of more than 8,000 bytes."""
    import re

    from pressledger.functions.money import parse_arr

    raw = spark.range(3).selectExpr("concat('$', id, 'M') AS revenue_raw").localCheckpoint()
    limit = spark.conf.get("spark.sql.codegen.hugeMethodLimit")
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", 65535)
    try:
        parse_arr(raw).explain("codegen")
    finally:
        spark.conf.set("spark.sql.codegen.hugeMethodLimit", limit)
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
    assert sizes and max(sizes) < 8000


def test_first_store_update_compares_nothing(spark, small, tmp_path, monkeypatch):
    from pressledger.plans import incremental, model
    from workloads import testdata as td

    seen = []
    original = incremental.detect_changes
    monkeypatch.setattr(incremental, "detect_changes", lambda *a: seen.append(1) or original(*a))
    prepared = model.prepare_articles(td.orders_articles(spark, small))
    first = incremental.update_store(spark, str(tmp_path), prepared, 4)
    assert seen == [] and {r.change for r in first.changes.select("change").distinct().collect()} == {"INSERTED"}
    again = incremental.update_store(spark, str(tmp_path), prepared, 4)
    assert seen == [1] and again.cleaned == 0 and again.rewritten == [] and again.folders == first.folders


def test_kept_rows_of_the_store_are_not_shuffled(spark, tmp_path, monkeypatch):
    """Before: all old rows of touched buckets were shuffled twice, by id and by bucket."""
    from pressledger.plans import incremental

    rows = spark.range(300).selectExpr("concat('a', id) AS article_id", "id AS n", "int(id % 2) AS bucket")
    rows.repartition(2).write.partitionBy("bucket").parquet(str(tmp_path / "rows"))
    old = spark.read.parquet(str(tmp_path / "rows"))
    gone = incremental._placed(old).where("n % 7 = 3 OR n > 250").select("article_id", "bucket", "_file", "_row")
    want = sorted(n for n in range(300) if n % 7 != 3 and n <= 250)
    monkeypatch.setattr(incremental, "BITMAP_ROWS", 16)
    for most, shuffled in ((1000, False), (0, True)):
        monkeypatch.setattr(incremental, "MAX_BITMAPS", most)
        left = incremental._without(old, gone)
        assert sorted(r.n for r in left.select("n").collect()) == want
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            plan = incremental._without(old, gone).select("n")._jdf.queryExecution().executedPlan().toString()
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        assert ("hashpartitioning" in plan) == shuffled
