import csv
import os
import random
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from pressledger.operators.fuzzy import fuzzy_suggest
from pressledger.operators.joins import lookup_join
from pressledger.operators.matching import (
    distinct_names, master_points, normalize_name, resolve_companies, with_fuzzy_confidence,
)
from pressledger.plans.model import build_dim_company
from pressledger.sources.master import alias_table, ambiguous_table

MASTER = (
    "company_name string, master_order bigint, founded_year int, headquarters string, employee_count int, "
    "industry string, is_public boolean, stock_ticker string"
)


def golden():
    path = os.path.join(os.path.dirname(__file__), "data", "golden_companies.csv")
    with open(path, encoding="utf-8", newline="") as f:
        return list(csv.DictReader(f))


@pytest.fixture(scope="module")
def master(spark):
    rows = [
        (
            r["company_name"], order, int(float(r["founded_year"])), r["headquarters"], int(float(r["employee_count"])),
            r["industry_raw"], r["is_public"] == "True", r["stock_ticker"] or None,
        )
        for order, r in enumerate(golden())
        if r["has_company_metadata"] == "True"
    ]
    return spark.createDataFrame(rows, MASTER)


def resolved(spark, master, names, aliases=None):
    articles = spark.createDataFrame(list(enumerate(names, start=2)), "source_row_number bigint, company_name_raw string")
    found = resolve_companies(
        distinct_names(articles), master, aliases if aliases is not None else alias_table(spark), ambiguous_table(spark)
    )
    return with_fuzzy_confidence(found, master)


def test_published_dimension_is_reproduced(spark, master):
    expected = golden()
    names = [r["company_name_raw"] for r in expected]
    dim = build_dim_company(master, resolved(spark, master, names), "run")
    got = {r.company_name: r for r in dim.collect()}
    assert len(got) == len(expected) == 27
    for want in expected:
        row = got[want["company_name"]]
        for column in (
            "company_id", "company_name_raw", "company_match_status", "company_match_method",
            "industry_standardized", "company_size_category", "record_hash",
        ):
            assert getattr(row, column) == want[column], (want["company_name"], column)
        assert row.company_match_confidence == float(want["company_match_confidence"])


def test_last_mention_lends_name_and_unmentioned_stay(spark, master):
    found = resolved(spark, master, ["Stripe", "stripe", " Stripe Inc. ", "Cohere", "COHERE!"])
    rows = {r.company_name: r for r in build_dim_company(master, found, "run").collect()}
    assert (rows["Stripe"].company_name_raw, rows["Stripe"].company_match_method) == ("Stripe Inc.", "ALIAS")
    assert (rows["Uber"].company_match_status, rows["Uber"].company_match_method) == ("METADATA_ONLY", "METADATA_KEY")
    assert rows["Cohere"].company_name_raw == "Cohere" and "COHERE!" not in rows


def test_cascade_order(spark, master):
    names = ["AWS", "Amazon Web Services", "Nvidia", "ＮＶＩＤＩＡ", "Cohere", "The Boring Company / SpaceX", "日本", ""]
    rows = {r.company_name_raw: r for r in resolved(spark, master, names).collect()}
    assert rows["AWS"].company_match_method == "ALIAS"
    assert rows["AWS"].company_id == rows["Amazon Web Services"].company_id
    assert rows["Nvidia"].company_match_method == rows["ＮＶＩＤＩＡ"].company_match_method == "NORMALIZED"
    assert rows["Cohere"].company_match_status == "UNRESOLVED" and rows["Cohere"].company_name_canonical is None
    ambiguous = rows["The Boring Company / SpaceX"]
    assert (ambiguous.company_match_status, ambiguous.company_name_canonical) == ("AMBIGUOUS", None)
    assert rows["日本"].company_id == rows[""].company_id
    assert rows["日本"].company_match_confidence == 0.0


def test_later_master_name_wins_a_shared_normal_form(spark):
    master = spark.createDataFrame(
        [("A-B", 0, 1, "", 1, "", True, None), ("a b", 1, 1, "", 1, "", True, None)], MASTER
    )
    rows = {r.company_name_raw: r for r in resolved(spark, master, ["A-B", "A B!"]).collect()}
    assert (rows["A-B"].company_match_method, rows["A-B"].company_name_canonical) == ("EXACT", "A-B")
    assert rows["A B!"].company_name_canonical == "a b"


def test_normal_form(spark):
    cases = {" Ａcme—Corp ": "acme corp", "Straße": "strasse", "a__b": "a b", "ﬁn": "fin", "!": ""}
    df = spark.createDataFrame([(k,) for k in cases], "n string")
    assert {r.n: r.m for r in df.select("n", normalize_name(F.col("n")).alias("m")).collect()} == cases


def test_fuzzy_equals_brute_force(spark):
    rng = random.Random(3)
    def name():
        return " ".join("".join(rng.choice("abcde12") for _ in range(rng.randint(1, 7))) for _ in range(rng.randint(1, 3)))
    master = sorted({name() for _ in range(150)} | {"long " + "ab" * 60})
    rng.shuffle(master)
    queries = sorted({name() for _ in range(90)} | {"", "x" * 80} - set(master))
    points = spark.createDataFrame([(m, m.upper(), i) for i, m in enumerate(master)], "name_norm string, company_name string, master_order bigint")
    found = {
        r.name_norm: (r.suggestion, r.score)
        for r in fuzzy_suggest(
            spark.createDataFrame([(q,) for q in queries], "name_norm string"), points, block_rows=8, max_pivots=4
        ).collect()
    }
    for q in queries:
        scores = [SequenceMatcher(None, q, m).ratio() for m in master]
        best = max(scores)
        assert found[q] == (master[scores.index(best)].upper(), round(best, 4)), q


def test_no_master_names_means_no_suggestion(spark):
    points = spark.createDataFrame([], "name_norm string, company_name string, master_order bigint")
    assert fuzzy_suggest(spark.createDataFrame([("a",)], "name_norm string"), points).count() == 0
    none = master_points(spark.createDataFrame([], MASTER))
    assert none.count() == 0


def test_hot_key_is_salted_and_rows_stay_whole(spark):
    rows = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id"))).alias("key"))
    counts = rows.groupBy("key").agg(F.count("*").alias("n"))
    lookup = rows.filter("id % 7 <> 1").select("key").distinct().withColumn("value", F.length("key"))
    joined = lookup_join(rows, lookup, "key", F.col("id"), counts, target_rows=500)
    plain = rows.join(lookup, "key", "left")
    assert sorted(map(tuple, joined.select("id", "key", "value").collect())) == sorted(map(tuple, plain.select("id", "key", "value").collect()))
    small = lookup_join(rows, lookup, "key", F.col("id"), counts, lookup_rows=10)
    assert small.count() == 3000
