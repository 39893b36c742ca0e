"""Multi-format publication dates with an explicit ambiguity policy."""

from pyspark.sql import Column, DataFrame, functions as F

from pressledger import rules
from pressledger.functions.text import WS, clean_optional, evaluated_once

DATE_COLUMNS = [
    "published_date", "published_year", "published_quarter", "published_month",
    "date_parse_status", "date_parse_reason",
]

# --- fixed values: reason texts ---
REASON_MISSING = "missing published date"
REASON_INVALID = "unsupported or invalid date"
REASON_AMBIGUOUS = "ambiguous numeric date interpreted as MM/DD/YYYY"

_Y, _M, _D = r"([0-9]{4})", r"([0-9]{1,2})", r"([0-9]{1,2}| [1-9])"
_CLOCK = r"[Tt](?:[01]?[0-9]|2[0-3]):[0-5]?[0-9]:[0-5]?[0-9][Zz]"
_FULL = "(" + "|".join(rules.MONTH_NAMES) + ")"
_SHORT = "(" + "|".join(m[:3] for m in rules.MONTH_NAMES) + ")"

_SLASH = f"^{_M}/{_D}/{_Y}$"
# (pattern, group of year, group of month, group of day); the shapes exclude each other.
_SHAPES = (
    (f"^{_Y}-{_M}-{_D}(?:{_CLOCK})?$", 1, 2, 3),
    (_SLASH, 3, 1, 2),
    (f"^{_D}-{_M}-{_Y}$", 3, 2, 1),
    (f"(?iu)^{_D}{WS}+{_SHORT}{WS}+{_Y}$", 3, 2, 1),
    (f"(?iu)^{_FULL}{WS}+{_D},{WS}+{_Y}$", 3, 1, 2),
)

FORMATS = ("ISO", "MONTH_DAY_YEAR", "DAY_MONTH_YEAR", "DAY_MONTH_NAME", "MONTH_NAME_DAY")  # of the shapes, in order


def date_format_name(c: Column) -> Column:
    """Which of the supported shapes a date text has, whether or not there is such a day: one of FORMATS, BLANK or OTHER."""
    text = clean_optional(c)
    case = F.when(F.lower(F.coalesce(text, F.lit(""))).isin(list(rules.MISSING_MARKERS)), "BLANK")
    for (pattern, *_), name in zip(_SHAPES, FORMATS, strict=True):
        case = case.when(text.rlike(pattern), name)
    return case.otherwise("OTHER")


def _month_number(name: Column) -> Column:
    """Number of a month name, by its first three letters."""
    short = F.array(*[F.lit(m[:3]) for m in rules.MONTH_NAMES])
    return F.array_position(short, F.lower(F.substring(name, 1, 3))).cast("string")


def iso_text(text: Column) -> Column:
    """``y-m-d`` text of the one shape that matches, NULL when none does."""
    case = F
    for pattern, year, month, day in _SHAPES:
        month_text = F.regexp_extract(text, pattern, month)
        case = case.when(
            text.rlike(pattern),
            F.concat_ws(
                "-",
                F.regexp_extract(text, pattern, year),
                _month_number(month_text) if pattern.startswith("(?iu)") else month_text,
                F.trim(F.regexp_extract(text, pattern, day)),
            ),
        )
    return case


def parse_published_date(df: DataFrame, column: str = "published_date_raw") -> DataFrame:
    """Add the six ``DATE_COLUMNS`` parsed from a text column."""
    text, day = F.col("_date_text"), F.col("_date_day")
    staged = (
        df.withColumn("_date_text", clean_optional(F.col(column)))
        .withColumn("_date_iso", iso_text(text))
        .withColumn(
            "_date_day",
            F.when(~F.col("_date_iso").startswith("0000"), F.col("_date_iso")).try_cast("date"),
        )
    )
    missing = F.lower(F.coalesce(text, F.lit(""))).isin(list(rules.MISSING_MARKERS))
    both_could_be_months = text.rlike(_SLASH) & (F.regexp_extract(text, _SLASH, 1).try_cast("int") <= 12) & (
        F.trim(F.regexp_extract(text, _SLASH, 2)).try_cast("int") <= 12
    )
    result = F.struct(
        day.alias("published_date"),
        F.year(day).alias("published_year"),
        F.quarter(day).alias("published_quarter"),
        F.month(day).alias("published_month"),
        F.when(missing, "MISSING").when(day.isNull(), "INVALID").otherwise("PARSED").alias("date_parse_status"),
        F.when(missing, REASON_MISSING)
        .when(day.isNull(), REASON_INVALID)
        .when(both_could_be_months, REASON_AMBIGUOUS)
        .alias("date_parse_reason"),
    )
    return staged.select(*df.columns, evaluated_once(result))


def observation_status(observation_date: Column) -> Column:
    return F.when(observation_date.isNotNull(), "DATED").otherwise("UNDATED")
