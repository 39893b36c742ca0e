"""Category and industry codes, and attributes derived from company master data."""

from pyspark.sql import Column, functions as F

from pressledger import rules
from pressledger.functions.text import lookup_code


def standardize_category(c: Column, codes: dict[str, str] = rules.CATEGORY_CODES) -> Column:
    return lookup_code(c, codes, rules.UNMAPPED)


def standardize_industry(c: Column, codes: dict[str, str] = rules.INDUSTRY_CODES) -> Column:
    return lookup_code(c, codes, rules.UNMAPPED)


def company_size(employees: Column) -> Column:
    n = employees.try_cast("bigint")
    return (
        F.when(n.isNull() | (n < 0), "UNKNOWN")
        .when(n < rules.SMALL_BELOW, "SMALL")
        .when(n <= rules.MEDIUM_UP_TO, "MEDIUM")
        .otherwise("LARGE")
    )


def company_age(founded_year: Column, published_year: Column) -> Column:
    age = published_year.try_cast("int") - founded_year.try_cast("int")
    return F.when(age >= 0, age)


def lenient_long(c: Column) -> Column:
    """Integer from text; anything that is not a whole number becomes NULL."""
    number = c.try_cast("double")
    return F.coalesce(
        c.try_cast("bigint"), F.when(F.rint(number) == number, number.try_cast("bigint"))
    )


def display_name(canonical: Column, raw: Column) -> Column:
    return F.coalesce(canonical, raw)
