"""Text clean-up, byte lengths, semi-structured values and column names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# All characters that count as white space at the ends of a CSV field (fixed values).
WHITESPACE = (
    "\t\n\x0b\x0c\r \u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000\ufeff"
)

# One well-formed UTF-8 sequence, written over bytes read as ISO-8859-1.
_UTF8_SEQUENCE = (
    "(?:[\\x00-\\x7f]|[\\xc2-\\xdf][\\x80-\\xbf]|\\xe0[\\xa0-\\xbf][\\x80-\\xbf]"
    "|[\\xe1-\\xec\\xee\\xef][\\x80-\\xbf]{2}|\\xed[\\x80-\\x9f][\\x80-\\xbf]"
    "|\\xf0[\\x90-\\xbf][\\x80-\\xbf]{2}|[\\xf1-\\xf3][\\x80-\\xbf]{3}"
    "|\\xf4[\\x80-\\x8f][\\x80-\\xbf]{2})"
)


def trim_all(c: Column) -> Column:
    # visible ASCII at both ends: nothing to trim, and two comparisons cost far less than the search for blanks
    first, last = (c >= "!") & (c < "\x7f"), F.right(c, F.lit(1)).between("!", "~")
    return F.when(first & last, c).otherwise(F.trim(c, F.lit(WHITESPACE)))


def empty_as_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def present(c: Column) -> Column:
    """Trimmed text, or null when nothing is left."""
    return empty_as_null(trim_all(c))


def truncate_bytes_sql(c: str, limit: int) -> str:
    """SQL that cuts text ``c`` to ``limit`` bytes of UTF-8 without splitting a character.

    A character has at most four bytes, so one of four cuts falls between characters. SQL text
    because the load of a wide table needs it a hundred times over.
    """
    cuts = ", ".join(str(limit - k) for k in range(4))
    whole = (
        f"get(filter(transform(array({cuts}), n -> CAST(left(CAST({c} AS BINARY), n) AS STRING)),"
        " s -> is_valid_utf8(s)), 0)"
    )
    # null is not longer than the limit: it must not reach the costly branch
    return f"CASE WHEN octet_length({c}) > {limit} THEN {whole} ELSE {c} END"


def blank_as_null_sql(c: str) -> str:
    # a text that begins with visible ASCII is not blank, which two comparisons tell
    visible = f"{c} >= '!' AND {c} < '\x7f'"
    return f"CASE WHEN {visible} THEN {c} WHEN trim(BOTH '{WHITESPACE}' FROM {c}) <> '' THEN {c} END"


def replace_invalid_bytes(c: Column, replacement: str = "?") -> Column:
    """Put ``replacement`` in place of every byte that is not part of valid UTF-8."""
    as_bytes = F.decode(c.cast("binary"), "ISO-8859-1")
    fixed = F.regexp_replace(as_bytes, f"({_UTF8_SEQUENCE}*+)[\\x80-\\xff]", f"$1{replacement}")
    return F.when(F.is_valid_utf8(c), c).otherwise(F.encode(fixed, "ISO-8859-1").cast("string"))


def as_variant(c: Column) -> Column:
    """Text that is JSON becomes that document; other text becomes a JSON string."""
    text = empty_as_null(c)
    return F.coalesce(F.try_parse_json(text), text.cast("variant"))


def normalize_variant(v: Column) -> Column:
    """The same rule for a value that is already a variant: a string inside it is parsed,
    an empty string or JSON null becomes null, anything else stays."""
    is_text = F.schema_of_variant(v) == "STRING"
    return F.when(F.is_variant_null(v), F.lit(None)).when(
        is_text, as_variant(F.try_variant_get(v, "$", "string"))
    ).otherwise(v)


def json_text(v: Column) -> Column:
    return F.to_json(v, {"ignoreNullFields": "false"})


def scalar_text(v: Column) -> Column:
    """A variant as the text a plain column holds: strings bare, booleans and numbers as
    written, nested values as JSON; null, missing and empty become null."""
    kind = F.schema_of_variant(v)
    nested = kind.startswith("OBJECT") | kind.startswith("ARRAY")
    plain = F.when(nested, F.to_json(v)).otherwise(F.try_variant_get(v, "$", "string"))
    return empty_as_null(plain)


def safe_column_name(c: Column) -> Column:
    """A header as a column name; null when no usable name is left."""
    name = F.regexp_replace(c, "[^a-zA-Z0-9_]", "_")
    name = F.regexp_replace(name, "^([0-9])", "_$1")
    name = F.lower(F.regexp_replace(name, "_+", "_"))
    return F.when(~name.isin("", "_"), name)


def url_parts(c: Column) -> tuple[Column, Column]:
    """(bucket, key) of an object URL; both null when the text is not one."""
    pattern = r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/]+)/(.+)"
    return (
        empty_as_null(F.regexp_extract(c, pattern, 1)),
        empty_as_null(F.regexp_extract(c, pattern, 2)),
    )


def leading_integer(c: Column) -> Column:
    return F.regexp_extract(c, r"^\s*([+-]?\d+)", 1).try_cast("bigint")


def file_name_numbers(path: Column) -> tuple[Column, Column]:
    """The integers that start the first and second dash-separated part of a file name."""
    parts = F.split(F.element_at(F.split(path, "/"), -1), "-")
    return leading_integer(F.get(parts, F.lit(0))), leading_integer(F.get(parts, F.lit(1)))
