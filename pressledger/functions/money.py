"""Free-text revenue to an integer US-dollar amount, as native expressions."""

from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from pressledger import rules
from pressledger.functions.text import WS, clean_optional, evaluated_once, strip

ARR_COLUMNS = [
    "arr_usd", "source_currency", "lower_bound_source", "upper_bound_source",
    "arr_parse_status", "arr_parse_reason",
]

# --- fixed values: reason texts and the shape of one amount ---
REASON_MISSING = "missing revenue"
REASON_UNDISCLOSED = "revenue not disclosed"
REASON_CURRENCIES = "multiple currency markers found"
REASON_ENDPOINTS = "range has more than two endpoints"
REASON_FORMAT = "amount does not match a supported format"
REASON_NEGATIVE = "negative amounts are not valid ARR"
REASON_SCALES = "range endpoints use different scales"
REASON_BOUNDS = "range lower bound exceeds upper bound"
REASON_TOO_LARGE = "amount exceeds the supported range"
_AMOUNT = (
    r"(?iu)^([+-]?[0-9]+(?:\.[0-9]+)?)" + WS + "*(?:" + "|".join(rules.SCALE_WORDS) + r")?$"
)

_NOT_WORD_BEFORE = r"(?<![\p{L}\p{N}_])"
_NOT_WORD_AFTER = r"(?![\p{L}\p{N}_])"

# Bounds are exact to 9 decimals after scaling; a total that could fit a bigint in any currency has 23 integer digits.
_TOTAL = "decimal(32,9)"
_BOUND = "decimal(38,9)"


def _code_pattern(codes: str) -> str:
    return f"(?iu){_NOT_WORD_BEFORE}(?:{codes}){_NOT_WORD_AFTER}"


def currency_marks(text: Column, upper: Column) -> dict[str, Column]:
    """Per currency, whether its symbol or stand-alone code appears; the regex sees candidates only."""
    return {
        f"_arr_is_{code}": text.contains(symbol) | (upper.contains(code) & text.rlike(_code_pattern(code)))
        for symbol, code in rules.CURRENCY_SYMBOLS.items()
    }


def strip_currency(text: Column, has_code: Column) -> Column:
    """Remove symbols, then stand-alone codes, then commas; the order decides edge cases."""
    no_symbols = F.translate(text, "".join(rules.CURRENCY_SYMBOLS), "")
    codes = "|".join(rules.CURRENCY_SYMBOLS.values())
    no_codes = F.when(has_code, F.regexp_replace(no_symbols, _code_pattern(codes), "")).otherwise(no_symbols)
    return strip(F.translate(no_codes, ",", ""))


def _scale(text: Column, digits: Column) -> Column:
    """What follows the number, in lower case; NULL when nothing does or nothing matched."""
    rest = F.lower(strip(F.substr(text, F.length(digits) + 1)))
    return F.when((digits != "") & (rest != ""), rest)


def _amount_parts(digits: Column) -> dict[str, Column]:
    """Digits before and after the decimal point, without a sign."""
    plain = F.translate(digits, "+-", "")
    return {"whole": F.substring_index(plain, ".", 1), "part": F.when(plain.contains("."), F.substring_index(plain, ".", -1)).otherwise("")}


def _places(scale: Column) -> Column:
    """By how many places a scale word moves the decimal point."""
    pairs = [F.lit(x) for word, factor in rules.SCALE_WORDS.items() for x in (word, len(str(factor)) - 1)]
    return F.coalesce(F.element_at(F.create_map(*pairs), scale), F.lit(0))


def _moved(whole: Column, part: Column, places: Column) -> Column:
    """All digits of the amount with its scale word applied; the decimal point comes after ``whole`` and ``places``."""
    return F.concat(whole, F.rpad(part, F.greatest(places, F.length(part)), F.lit("0")))


def _scaled(digits: Column, row: Column, point: Column) -> Column:
    """The amount with its scale word applied, by moving the decimal point in the text; no digit is lost before that."""
    text = F.concat(F.substr(row, F.lit(1), point), F.lit("."), F.substr(row, point + 1), F.lit("0"))
    return F.when(digits != "", text.try_cast(_BOUND))


def to_usd(total_of_bounds: Column, currency: Column) -> Column:
    """Half of lower + upper, converted and rounded half up once; NULL beyond bigint."""
    total = total_of_bounds.try_cast(_TOTAL)
    halves = [F.lit(x) for code, rate in rules.USD_PER_UNIT.items() for x in (code, Decimal(rate) / 2)]
    usd = F.round(total * F.element_at(F.create_map(*halves), currency).cast("decimal(4,3)"), 0).cast("decimal(38,0)")
    for code, units in rules.UNITS_PER_USD.items():
        divided = F.round(total / F.lit(Decimal(2 * units)).cast("decimal(4,0)"), 0).cast("decimal(38,0)")
        usd = F.when(currency == code, divided).otherwise(usd)
    return usd.try_cast("bigint")


def parse_arr(df: DataFrame, column: str = "revenue_raw") -> DataFrame:
    """Add the six ``ARR_COLUMNS`` parsed from a text column.

    The steps are separate projections, so each intermediate is computed once per row. They come in three groups, each behind
    ``evaluated_once``: a generated method of all of them would be too large for the JIT.
    """
    text = F.col("_arr_text")
    parts = F.col("_arr_parts")
    marks = currency_marks(text, F.col("_arr_upper"))
    found = reduce(lambda a, b: a + b, [F.when(F.col(m), 1).otherwise(0) for m in marks])
    single = F.coalesce(*[F.when(F.col(m), m.removeprefix("_arr_is_")) for m in marks], F.lit("USD"))
    staged = (
        df.withColumn("_arr_text", clean_optional(F.col(column)))
        .withColumn("_arr_upper", F.upper(text))
        .withColumns(marks | {
            "_arr_marker": F.lower(F.coalesce(text, F.lit(""))),
            "_arr_parts": F.when(text.contains("-"), F.split(text, f"{WS}+-{WS}+", -1)).otherwise(F.array(text)),
            "_arr_has_code": reduce(
                lambda a, b: a | b, [F.col("_arr_upper").contains(code) for code in rules.CURRENCY_SYMBOLS.values()]
            ),
        })
        .withColumns({
            "_arr_found": found,
            "_arr_currency": F.when(found <= 1, single),
            "_arr_ends": F.size(parts),
            "_arr_a": strip_currency(F.get(parts, 0), F.col("_arr_has_code")),
            "_arr_b": strip_currency(F.get(parts, 1), F.col("_arr_has_code")),
        })
    )
    known = ["_arr_marker", "_arr_found", "_arr_currency", "_arr_ends"]
    staged = staged.select(*df.columns, evaluated_once(F.struct(*known, "_arr_a", "_arr_b")))
    staged = (
        staged.withColumns({f"_arr_digits_{end}": F.regexp_extract(f"_arr_{end}", _AMOUNT, 1) for end in "ab"})
        .withColumns({
            # For its sign only. A text without a number is not cast: an exception for each such row is dear.
            f"_arr_n{i}": F.when(F.col(f"_arr_digits_{end}") != "", F.col(f"_arr_digits_{end}")).try_cast("double") for i, end in enumerate("ab")
        } | {
            f"_arr_s{i}": _scale(F.col(f"_arr_{end}"), F.col(f"_arr_digits_{end}")) for i, end in enumerate("ab")
        } | {
            f"_arr_{name}_{end}": c for end in "ab" for name, c in _amount_parts(F.col(f"_arr_digits_{end}")).items()
        })
    )
    amounts = ["_arr_digits_a", "_arr_digits_b", "_arr_n0", "_arr_n1", "_arr_s0", "_arr_s1", "_arr_whole_a", "_arr_part_a", "_arr_whole_b", "_arr_part_b"]
    staged = staged.select(*df.columns, evaluated_once(F.struct(*known, *amounts)))
    staged = (
        staged.withColumns({"_arr_places_a": _places(F.coalesce("_arr_s0", "_arr_s1")), "_arr_places_b": _places(F.coalesce("_arr_s1", "_arr_s0"))})
        .withColumns({f"_arr_row_{end}": _moved(*[F.col(f"_arr_{x}_{end}") for x in ("whole", "part", "places")]) for end in "ab"} | {
            f"_arr_point_{end}": F.length(f"_arr_whole_{end}") + F.col(f"_arr_places_{end}") for end in "ab"
        })
        .withColumn("_arr_lo", _scaled(F.col("_arr_digits_a"), F.col("_arr_row_a"), F.col("_arr_point_a")))
        # Without a second end there is no second scale word, so both bounds are the same.
        .withColumn("_arr_hi", F.when(
            F.col("_arr_ends") == 2, _scaled(F.col("_arr_digits_b"), F.col("_arr_row_b"), F.col("_arr_point_b"))
        ).otherwise(F.col("_arr_lo")))
        .withColumn("_arr_usd", to_usd(F.col("_arr_lo").try_cast(_TOTAL) + F.col("_arr_hi").try_cast(_TOTAL), F.col("_arr_currency")))
    )

    marker, ends = F.col("_arr_marker"), F.col("_arr_ends")
    n0, n1 = F.col("_arr_n0"), F.col("_arr_n1")
    reason = (
        F.when(marker.isin(list(rules.MISSING_MARKERS)), REASON_MISSING)
        .when(marker.isin(list(rules.UNDISCLOSED_MARKERS)), REASON_UNDISCLOSED)
        .when(F.col("_arr_found") > 1, REASON_CURRENCIES)
        .when(ends > 2, REASON_ENDPOINTS)
        .when(n0.isNull(), REASON_FORMAT)
        .when(n0 < 0, REASON_NEGATIVE)
        .when((ends == 2) & n1.isNull(), REASON_FORMAT)
        .when((ends == 2) & (n1 < 0), REASON_NEGATIVE)
        .when(F.col("_arr_s0") != F.col("_arr_s1"), REASON_SCALES)
        .when(F.col("_arr_lo") > F.col("_arr_hi"), REASON_BOUNDS)
        .when(F.col("_arr_usd").isNull(), REASON_TOO_LARGE)
    )
    status = (
        F.when(F.col("_arr_reason").isNull(), "PARSED")
        .when(F.col("_arr_reason") == REASON_MISSING, "MISSING")
        .when(F.col("_arr_reason") == REASON_UNDISCLOSED, "UNDISCLOSED")
        .otherwise("INVALID_FORMAT")
    )
    parsed = F.col("_arr_status") == "PARSED"
    result = F.struct(
        F.when(parsed, F.col("_arr_usd")).alias("arr_usd"),
        F.when(F.col("_arr_status").isin("PARSED", "INVALID_FORMAT"), F.col("_arr_currency")).alias("source_currency"),
        F.when(parsed, F.col("_arr_lo").cast(_BOUND)).alias("lower_bound_source"),
        F.when(parsed, F.col("_arr_hi").cast(_BOUND)).alias("upper_bound_source"),
        F.col("_arr_status").alias("arr_parse_status"),
        F.col("_arr_reason").alias("arr_parse_reason"),
    )
    final = staged.withColumn("_arr_reason", reason).withColumn("_arr_status", status)
    return final.select(*df.columns, evaluated_once(result))
