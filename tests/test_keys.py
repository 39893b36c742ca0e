import hashlib
import json
import uuid

from pyspark.sql import functions as F

from pressledger import rules
from pressledger.functions.keys import arr_observation_id, company_id, issue_id, record_hash


def test_uuid5_agrees_with_the_standard_library(spark):
    names = ["airbnb", "", "naïve 漢字", "x" * 300]
    rows = spark.createDataFrame([(n,) for n in names], "n string").select("n", company_id(F.col("n")).alias("id")).collect()
    for row in rows:
        assert row.id == str(uuid.uuid5(uuid.UUID(rules.COMPANY_NAMESPACE), "company:" + row.n))


def test_observation_and_issue_ids(spark):
    row = spark.range(1).select(
        arr_observation_id(F.lit("A1")).alias("a"),
        issue_id(F.lit("t"), F.lit("r"), F.lit("f"), F.lit("c")).alias("i"),
    ).first()
    assert row.a == str(uuid.uuid5(uuid.UUID(rules.ARR_NAMESPACE), "A1:reported_arr"))
    assert row.i == str(uuid.uuid5(uuid.UUID(rules.ISSUE_NAMESPACE), "t:r:f:c"))


def test_record_hash_equals_json_and_sha256(spark):
    records = [
        ("plain", "text", None),
        ("", None, None),
        ('quote " and \\ slash', "tab\t newline\n return\r feed\f back\b", "\x01\x1f\x7f"),
        ("é ü ß", "漢字", "emoji 😀 and 𝒜"),
        ("a", "€10M", "[x]"),
    ]
    df = spark.createDataFrame(records, "a string, b string, c string")
    got = [r.h for r in df.select(record_hash(F.col("a"), F.col("b"), F.col("c")).alias("h")).collect()]
    want = [
        hashlib.sha256(json.dumps(list(r), separators=(",", ":")).encode()).hexdigest() for r in records
    ]
    assert got == want


def test_record_hash_of_trailing_line_breaks(spark):
    values = ["abc\n", "a\r\n", "a\u2028", "a\x85", "plain", 'q"\\', "\u00e9\U0001f600"]
    rows = spark.createDataFrame([(v,) for v in values], "v string").select("v", record_hash(F.col("v"), F.lit(None).cast("string")).alias("h")).collect()
    for r in rows:
        text = json.dumps([r.v, None], separators=(",", ":"))
        assert r.h == hashlib.sha256(text.encode()).hexdigest()
