"""Splitting one CSV line with quote-toggling rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from eventmart.functions.values import trim_all

# The loops are possessive, so a long quoted field costs no stack and no backtracking.
_QUOTED = r'"([^"]*+(?:""[^"]*+)*+)(?:"|\z)'
_FIELD = r',((?:[^",]++|"[^"]*+(?:""[^"]*+)*+(?:"|\z))*+)'


def _no_edge_space(line: Column, quoted: bool) -> Column:
    """True when no field can begin or end with white space, from a few plain text searches."""
    ascii_only = F.octet_length(line) == F.length(line)
    clean = ~line.startswith(" ") & ~line.endswith(" ")
    for text in (", ", " ,", *(('" ', ' "') if quoted else ()), "\t", "\x0b", "\x0c", "\r"):
        clean = clean & ~line.contains(text)
    return clean & ascii_only


def split_fields(line: Column) -> Column:
    """Fields of a CSV line as ``array<string>``.

    A quote opens or closes a quoted stretch anywhere in a field, two quotes inside one are
    a quote, commas separate only outside, and every field is trimmed. A quoted stretch
    that is not closed runs to the end of the line.

    Lines without quotes and without white space beside a comma, the bulk of an export, are
    only split; trimming field by field costs several times as much on wide rows.
    """
    # the comma put in front keeps an empty first field
    raw = F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(_FIELD), F.lit(1))

    def unquote(x: Column) -> Column:
        bare = F.replace(F.regexp_replace(x, _QUOTED, "$1"), F.lit('""'), F.lit('"'))
        return F.when(x.contains('"'), bare).otherwise(x)

    return (
        F.when(
            line.contains('"'),
            F.when(_no_edge_space(line, True), F.transform(raw, unquote)).otherwise(
                F.transform(F.transform(raw, unquote), trim_all)
            ),
        )
        .when(_no_edge_space(line, False), F.split(line, ","))
        .otherwise(F.transform(F.split(line, ","), trim_all))
    )
