import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from pressledger.functions.dates import parse_published_date
from pressledger.functions.money import parse_arr
from pressledger.functions.taxonomy import (
    company_age, company_size, lenient_long, standardize_category, standardize_industry,
)
from pressledger.functions.text import article_text, clean_optional

AMOUNTS = {
    "5.2B": 5_200_000_000,
    "$5,200,000,000": 5_200_000_000,
    "5.2 billion": 5_200_000_000,
    "500M USD": 500_000_000,
    "$10M - $20M": 15_000_000,
    "€2.1B": 2_310_000_000,
    "£100M": 127_000_000,
    "¥15B": 100_000_000,
    "75000.0M USD": 75_000_000_000,
    "10 - 20M": 15_000_000,
    "1,2,3": 123,
    "0": 0,
    "10,USD": 10,
    "75 JPY": 1,
    "74 jpy": 0,
    "+7k": 7_000,
    " 5 thousand ": 5_000,
    "1 -\t2": 2,  # 1.5 rounds half up
    "1.123456789B": 1_123_456_789,
    "9000000000 billion": 9_000_000_000_000_000_000,
}
REJECTED = {
    "garbage": "amount does not match a supported format",
    "$-5M": "negative amounts are not valid ARR",
    "$20M - $10M": "range lower bound exceeds upper bound",
    "€10M USD": "multiple currency markers found",
    "$10M-$20M": "amount does not match a supported format",
    "10m - 20 million": "range endpoints use different scales",
    "1 - 2 - 3": "range has more than two endpoints",
    "500MUSD": "amount does not match a supported format",
    "USD$10": "amount does not match a supported format",
    "-1 - x": "negative amounts are not valid ARR",
    "x - -1": "amount does not match a supported format",
    "99000000000 billion": "amount exceeds the supported range",
}


@pytest.fixture(scope="module")
def parsed(spark):
    texts = [*AMOUNTS, *REJECTED, None, "", "  ", "N/A", "NaN", "Not disclosed", " UNDISCLOSED "]
    df = spark.createDataFrame([(t,) for t in texts], "revenue_raw string")
    return {r.revenue_raw: r for r in parse_arr(df).collect()}


def test_amounts(parsed):
    for text, usd in AMOUNTS.items():
        row = parsed[text]
        assert (row.arr_parse_status, row.arr_usd, row.arr_parse_reason) == ("PARSED", usd, None), text


def test_rejected_amounts(parsed):
    for text, reason in REJECTED.items():
        row = parsed[text]
        assert (row.arr_parse_status, row.arr_usd, row.arr_parse_reason) == ("INVALID_FORMAT", None, reason), text
        assert row.source_currency == (None if reason.startswith("multiple") else "USD")


def test_missing_and_undisclosed(parsed):
    for text in (None, "", "  ", "N/A", "NaN"):
        assert parsed[text].arr_parse_status == "MISSING"
    for text in ("Not disclosed", " UNDISCLOSED "):
        assert parsed[text].arr_parse_status == "UNDISCLOSED"
        assert parsed[text].source_currency is None


def test_bounds_stay_in_source_currency(parsed):
    row = parsed["$10M - $20M"]
    assert (row.lower_bound_source, row.upper_bound_source) == (Decimal(10_000_000), Decimal(20_000_000))
    assert parsed["€2.1B"].lower_bound_source == Decimal(2_100_000_000)
    assert (parsed["£100M"].source_currency, parsed["¥15B"].source_currency) == ("GBP", "JPY")


def test_filter_does_not_copy_the_parse(spark):
    df = spark.range(3).select(F.col("id").cast("string").alias("revenue_raw"))
    kept = parse_arr(df).filter("arr_parse_status = 'PARSED' AND arr_usd > 0")
    assert kept.count() == 2
    assert len(kept._jdf.queryExecution().optimizedPlan().toString()) < 20_000


DATES = {
    "2023-05-12": (dt.date(2023, 5, 12), None),
    "2023-05-12T00:00:00Z": (dt.date(2023, 5, 12), None),
    "05/12/2023": (dt.date(2023, 5, 12), "ambiguous numeric date interpreted as MM/DD/YYYY"),
    "12-05-2023": (dt.date(2023, 5, 12), None),
    "12 May 2023": (dt.date(2023, 5, 12), None),
    "12 mAY  2023": (dt.date(2023, 5, 12), None),
    "May 12, 2023": (dt.date(2023, 5, 12), None),
    "04/05/2023": (dt.date(2023, 4, 5), "ambiguous numeric date interpreted as MM/DD/YYYY"),
    "04/15/2023": (dt.date(2023, 4, 15), None),
    "2023-5-2": (dt.date(2023, 5, 2), None),
    "29 Feb 2024": (dt.date(2024, 2, 29), None),
    "1 September 2023": None,
    "2023-02-30": None,
    "31/12/2023": None,
    "2023-05-12T24:00:00Z": None,
    "2023-05-12 00:00:00": None,
    "23-05-12": None,
    "0000-01-01": None,
}


def test_dates(spark):
    df = spark.createDataFrame([(t,) for t in [*DATES, None, "", " n/a "]], "published_date_raw string")
    rows = {r.published_date_raw: r for r in parse_published_date(df).collect()}
    for text, expected in DATES.items():
        row = rows[text]
        if expected is None:
            assert (row.date_parse_status, row.published_date) == ("INVALID", None), text
        else:
            day, reason = expected
            assert (row.published_date, row.date_parse_reason) == (day, reason), text
            assert (row.published_year, row.published_quarter, row.published_month) == (
                day.year, (day.month - 1) // 3 + 1, day.month,
            )
    for text in (None, "", " n/a "):
        assert (rows[text].date_parse_status, rows[text].date_parse_reason) == ("MISSING", "missing published date")


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def test_codes_sizes_and_ages(spark):
    lit = F.lit
    assert list(one(
        spark,
        standardize_category(lit(" Artificial Intelligence ")), standardize_category(lit("Cloud Services")),
        standardize_category(lit("new category")), standardize_category(lit(None).cast("string")),
        standardize_industry(lit("AI/ML")), standardize_industry(lit("cloud")),
    )) == ["AI_ML", "CLOUD", "UNMAPPED", "UNMAPPED", "AI_ML", "UNMAPPED"]
    sizes = [9999, 10000, 30000, 30001, -1, None]
    assert list(one(spark, *[company_size(lit(n).cast("int")) for n in sizes])) == [
        "SMALL", "MEDIUM", "MEDIUM", "LARGE", "UNKNOWN", "UNKNOWN",
    ]
    ages = [(2010, 2023), (2024, 2023), (None, 2023), (2010, None)]
    assert list(one(spark, *[company_age(lit(f).cast("int"), lit(y).cast("int")) for f, y in ages])) == [13, None, None, None]
    assert list(one(spark, *[lenient_long(lit(t)) for t in ("12", "12.0", "x", "", "nan")])) == [12, 12, None, None, None]


def test_texts(spark):
    text = article_text(F.lit("  Title\n"), F.lit(None).cast("string"))
    both = article_text(F.lit("Title "), F.lit("\tBody "))
    assert list(one(spark, text, both, clean_optional(F.lit(" 　 ")))) == ["Title", "Title\n\nBody", None]


def test_amounts_keep_every_digit(spark):
    rows = [("\u20ac0.0000000014B", 2, "1.400000000"), ("\u00a5123456789012345678", 823045260082305, "123456789012345678.000000000"), ("$0.0000015M", 2, "1.500000000"), ("$1.23456789012B", 1234567890, "1234567890.120000000")]
    got = parse_arr(spark.createDataFrame([(r[0],) for r in rows], "revenue_raw string")).collect()
    assert [(r.revenue_raw, r.arr_usd, str(r.lower_bound_source)) for r in got] == rows
    huge = parse_arr(spark.createDataFrame([("$99999999999999999999",)], "revenue_raw string")).first()
    assert huge.arr_parse_status == "INVALID_FORMAT" and huge.arr_parse_reason == "amount exceeds the supported range"


def test_lower_case_timestamp_marks(spark):
    got = parse_published_date(spark.createDataFrame([("2023-05-12t00:00:00z",)], "published_date_raw string")).first()
    assert str(got.published_date) == "2023-05-12"
