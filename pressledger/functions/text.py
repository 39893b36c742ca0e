"""String helpers."""

from functools import reduce

from pyspark.sql import Column, functions as F

# Whitespace as Python's str.strip sees it; Spark's trim alone removes spaces only.
WS_CHARS = "".join(chr(i) for i in range(0x3001) if chr(i).isspace())
WS = "[" + "".join(f"\\x{{{ord(ch):x}}}" for ch in WS_CHARS) + "]"


def strip(c: Column) -> Column:
    return F.trim(c, F.lit(WS_CHARS))


def clean_optional(c: Column) -> Column:
    """Stripped text, or NULL when nothing is left."""
    return F.nullif(strip(c), F.lit(""))


def article_text(title: Column, summary: Column) -> Column:
    """Title and summary joined by one blank line, with no outer blanks."""
    def part(c):
        return strip(F.coalesce(c, F.lit("")))
    return strip(F.concat(part(title), F.lit("\n\n"), part(summary)))


def lookup_code(c: Column, codes: dict[str, str], default: str) -> Column:
    """Case-insensitive lookup of a small code table as one CASE of set tests."""
    label = F.lower(strip(c))
    by_code: dict[str, list[str]] = {}
    for key, code in codes.items():
        by_code.setdefault(code, []).append(key)
    branches = reduce(
        lambda case, item: case.when(label.isin(item[1]), F.lit(item[0])), by_code.items(), F
    )
    return branches.otherwise(F.lit(default))


def evaluated_once(result: Column) -> Column:
    """The fields of a struct as columns that later filters cannot pull apart.

    A filter on a projected column is pushed down by copying its expression, and a long parse
    would be copied with every reference. Generated columns are not copied.
    """
    return F.inline(F.array(result))
