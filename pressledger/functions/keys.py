"""Deterministic identifiers and record hashes, byte-equal to Python's uuid5 and json + sha256."""

from pyspark.sql import Column, functions as F

from pressledger import rules


def uuid5(namespace: str, name: Column) -> Column:
    """RFC 4122 version 5: SHA-1 of namespace bytes and name, with version and variant set."""
    digest = F.sha1(
        F.concat(F.unhex(F.lit(namespace.replace("-", ""))), F.encode(name, "UTF-8"))
    )
    variant = F.translate(
        F.substring(digest, 17, 1), "0123456789abcdef", "89ab" * 4
    )
    return F.concat(
        F.substring(digest, 1, 8), F.lit("-"),
        F.substring(digest, 9, 4), F.lit("-5"),
        F.substring(digest, 14, 3), F.lit("-"),
        variant, F.substring(digest, 18, 3), F.lit("-"),
        F.substring(digest, 21, 12),
    )


def company_id(normalized_name: Column) -> Column:
    return uuid5(rules.COMPANY_NAMESPACE, F.concat(F.lit("company:"), normalized_name))


def arr_observation_id(article_id: Column) -> Column:
    """Depends on the article only, so a corrected amount keeps its id."""
    return uuid5(rules.ARR_NAMESPACE, F.concat(article_id, F.lit(":reported_arr")))


def issue_id(table: Column, record: Column, field: Column, rule: Column) -> Column:
    return uuid5(rules.ISSUE_NAMESPACE, F.concat_ws(":", table, record, field, rule))


def _unicode_escape(code: Column) -> Column:
    return F.concat(F.lit("\\u"), F.lpad(F.lower(F.hex(code)), 4, "0"))


def _escaped_char(ch: Column) -> Column:
    code = F.ascii(ch)
    return (
        F.when(ch == '"', '\\"')
        .when(ch == "\\", "\\\\")
        .when(ch == "\n", "\\n")
        .when(ch == "\r", "\\r")
        .when(ch == "\t", "\\t")
        .when(ch == "\f", "\\f")
        .when(ch == "\b", "\\b")
        .when((code >= 32) & (code <= 126), ch)
        .when(code < 65536, _unicode_escape(code))
        .otherwise(
            F.concat(
                _unicode_escape(F.lit(0xD800) + F.shiftright(code - 65536, 10)),
                _unicode_escape(F.lit(0xDC00) + (code - 65536) % 1024),
            )
        )
    )


# \z and not $, which also matches before a final line break.
_PLAIN = r"^[ !#-\[\]-~]*\z"


def _json_string(c: Column) -> Column:
    """A JSON string in ASCII; only text that needs it is taken apart."""
    chars = F.regexp_extract_all(c, F.lit("(?s)."), F.lit(0))
    body = F.when(c.rlike(_PLAIN), c).otherwise(F.array_join(F.transform(chars, _escaped_char), ""))
    return F.concat(F.lit('"'), body, F.lit('"'))


def record_hash(*values: Column) -> Column:
    """SHA-256 of a compact JSON array of the values as strings; NULL stays null.

    Records without quotes, controls or non-ASCII characters take a branch that only concatenates.
    """
    quoted = [F.coalesce(F.concat(F.lit('"'), v, F.lit('"')), F.lit("null")) for v in values]
    escaped = F.array_join(F.transform(F.array(*values), _json_string), ",", "null")
    plain = F.concat_ws("", *values).rlike(_PLAIN)
    body = F.when(plain, F.concat_ws(",", *quoted)).otherwise(escaped)
    return F.sha2(F.concat(F.lit("["), body, F.lit("]")), 256)


def bool_text(c: Column) -> Column:
    return F.when(c, "True").when(~c, "False")
