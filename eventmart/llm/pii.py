"""Personal data: regular expressions propose spans, checksums confirm them, context scores them.

Everything is SQL expressions. Positions come from the pieces between the matches of a pattern:
piece, match, piece, match ... are the text, so running lengths are code-point offsets.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Possessive quantifiers and run starts (\G or a look-behind) keep long runs linear and leave every
# match as it is: what follows a run is never in the run's own class.
_LOCAL = "A-Za-z0-9._%+-"

# Characters of an IBAN by country, those of the registry and those in partial use.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "AO CV GW LY MZ PT ST",
    26: "DZ IR IS TR", 27: "BI CF CG CM DJ FR GA GQ GR IT KM MC MG MR SM TD",
    28: "AL AZ BF BJ BY CI CY DO EG GT HN HU LB MA ML NE NI PL SN SV TG", 29: "BR PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
# The whole IBAN from its start: as long as its country has it; with other codes as long as it goes on.
_IBAN_WHOLE = "^(?:{}|(?!{})[A-Z]{{2}}[0-9]{{2}}(?: ?[A-Z0-9]){{11,30}})".format(
    "|".join(f"(?:{c.replace(' ', '|')})[0-9]{{2}}(?: ?[A-Z0-9]){{{n - 4}}}" for n, c in IBAN_LENGTHS.items()),
    "|".join(IBAN_LENGTHS.values()).replace(" ", "|"),
)
_IBAN_REACH = 4 + 2 * 30  # code points with a blank before each


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    needs: str  # a text without a match of this cheap pattern has no span of the kind
    base: bool
    score: float
    context: str  # words near a span that raise its score
    whole: str = ""  # ``pattern`` only finds starts; this one takes the hit from there


KINDS = (
    Kind("email", rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@", True, 0.9, "mail|contact|write"),
    Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"[0-9]\.[0-9]", True, 0.6, "ip|host|server|address|login"),
    Kind("card", r"[0-9](?:[\x20-]?+[0-9])++", r"[0-9][\x20-]?[0-9]", True, 0.8, "card|visa|credit|payment|pay"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9]", True, 0.7, "phone|call|tel|mobile|fax"),
    Kind("iban", r"(?<![A-Za-z0-9-])[A-Z]{2}[0-9]{2}(?=(?: ?[A-Z0-9]){11})", r"[A-Z][0-9][0-9]", False, 0.9, "iban|account|bank|transfer", _IBAN_WHOLE),
    Kind("ssn", r"[0-9]{3}-[0-9]{2}-[0-9]{4}", r"[0-9]-[0-9][0-9]-[0-9]", False, 0.4, "ssn|social|security|tax"),
)
NEAR = 40  # code points before a span in which context words count
CONTEXT_BONUS = 0.2
THRESHOLD = 0.5  # added spans below this score are dropped; base spans stay
SPAN = "struct<start:bigint,rank:int,kind:string,end:bigint,score:double>"

_DIGITS = "regexp_replace(hit, '[^0-9]', '')"
_LUHN = (
    f"aggregate(transform(filter(split(reverse({_DIGITS}), ''), c -> c != ''), "
    "(c, i) -> if(i % 2 = 0, int(c), if(int(c) > 4, 2 * int(c) - 9, 2 * int(c)))), 0, (a, b) -> a + b) % 10 = 0"
)
_IBAN = "replace(hit, ' ', '')"
_MOD97 = (
    f"aggregate(filter(split(concat(substring({_IBAN}, 5), substring({_IBAN}, 1, 4)), ''), c -> c != ''), 0, "
    "(a, c) -> if(c between '0' and '9', a * 10 + int(c), a * 100 + ascii(c) - 55) % 97) = 1"
)
_ALONE = "not (before rlike '[A-Za-z0-9-]$' or after rlike '^[A-Za-z0-9-]')"
# What a proposed ``hit`` must fulfil; ``before`` and ``after`` are its surroundings.
VALID = {
    "email": "true",
    "ip": "forall(split(hit, '[.]'), p -> length(ltrim('0', p)) <= 3 and coalesce(int(nullif(right(ltrim('0', p), 3), '')), 0) <= 255)",
    "card": f"length({_DIGITS}) between 12 and 19 and {_LUHN}",
    "phone": f"length({_DIGITS}) between 9 and 15",
    "iban": f"length({_IBAN}) between 15 and 34 and {_ALONE} and {_MOD97}",
    "ssn": f"{_ALONE} and not substring(hit, 1, 3) rlike '000|666|9..' and substring(hit, 5, 2) != '00' and substring(hit, 8) != '0000'",
}


def _found(kind: Kind, rank: int, text: str, hits: str) -> str:
    """SQL for the spans of one kind from its raw matches."""
    valid = VALID[kind.name]
    pattern = kind.pattern.replace("\\", "\\\\")
    placed = (
        f"aggregate(zip_with(split({text}, '{pattern}', -1), {hits}, (p, h) -> named_struct('piece', p, 'hit', h)), "
        "named_struct('at', 0L, 'out', cast(array() as array<struct<start:bigint,hit:string>>)), "
        "(a, x) -> if(x.hit is null, a, named_struct('at', a.at + length(x.piece) + length(x.hit), "
        "'out', concat(a.out, array(named_struct('start', a.at + length(x.piece), 'hit', x.hit)))))).out"
    )
    if kind.whole:
        placed = (
            f"transform({placed}, x -> named_struct('start', x.start, 'hit', "
            f"regexp_extract(substring({text}, int(x.start) + 1, {_IBAN_REACH}), '{kind.whole}', 0)))"
        )
    around = (
        f"transform({placed}, x -> named_struct('start', x.start, 'hit', x.hit, "
        f"'before', substring({text}, int(greatest(x.start - {NEAR}, 0L)) + 1, int(least(x.start, {NEAR}L))), "
        f"'after', substring({text}, int(x.start) + length(x.hit) + 1, 1)))"
    )
    valid = re.sub(r"\b(hit|before|after)\b", r"x.\1", valid)
    score = f"double({kind.score}) + if(lower(x.before) rlike '{kind.context}', {CONTEXT_BONUS}D, 0D)"
    spans = (
        f"transform(filter({around}, x -> {valid}), x -> named_struct('start', x.start, 'rank', {rank}, "
        f"'kind', '{kind.name}', 'end', x.start + length(x.hit), 'score', {score}))"
    )
    if kind.whole:  # starts are found within hits too
        spans = (
            f"aggregate({spans}, cast(array() as array<{SPAN}>), "
            "(a, s) -> if(size(a) > 0 and s.start < element_at(a, -1).end, a, concat(a, array(s))))"
        )
    if not kind.base:
        spans = f"filter({spans}, s -> s.score >= {THRESHOLD}D)"
    return f"if(size({hits}) = 0, cast(array() as array<{SPAN}>), {spans})"


def with_spans(df: DataFrame, text_col: str = "text", out: str = "spans", kinds: tuple[Kind, ...] = KINDS) -> DataFrame:
    """``df`` with ``out``: array of (start, rank, kind, end, score) by start, then kind as listed.

    Offsets are code points, ends exclusive. Within a kind, spans are the leftmost non-overlapping
    matches that pass its check; spans of two kinds may overlap. A null or empty text has an empty
    array; repeated rows, other columns and empty tables pass through.
    """
    text = "__pii_text"
    named = df.withColumn(text, F.coalesce(F.col(f"`{text_col}`"), F.lit("")))
    raw = named.withColumns({
        f"__pii_{k.name}": F.when(
            _needs(F.col(text), k), F.regexp_extract_all(F.col(text), F.lit(k.pattern), F.lit(0))
        ).otherwise(F.array().cast("array<string>"))
        for k in kinds
    })
    found = raw.withColumns({f"__pii_{k.name}": F.expr(_found(k, i, text, f"__pii_{k.name}")) for i, k in enumerate(kinds)})
    spans = F.array_sort(F.flatten(F.array(*(F.col(f"__pii_{k.name}") for k in kinds))))
    return found.withColumn(out, spans).drop(text, *(f"__pii_{k.name}" for k in kinds))


def _needs(text: Column, kind: Kind) -> Column:
    return text.contains("@") if kind.needs == "@" else text.rlike(kind.needs)


def mask(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``df`` with every span of its text replaced by ``[KIND]``; a null text stays null.

    Overlapping spans are replaced together, under the kind of the first.
    """
    found = with_spans(df, text_col, "__pii_spans")
    merged = F.expr(
        "aggregate(__pii_spans, cast(array() as array<struct<start:bigint,end:bigint,kind:string>>), (a, s) -> "
        "if(size(a) > 0 and s.start < element_at(a, -1).end, "
        "concat(slice(a, 1, size(a) - 1), array(named_struct('start', element_at(a, -1).start, "
        "'end', greatest(element_at(a, -1).end, s.end), 'kind', element_at(a, -1).kind))), "
        "concat(a, array(named_struct('start', s.start, 'end', s.end, 'kind', s.kind)))))"
    )
    pieces = F.expr(
        f"concat(array_join(transform(__pii_merged, (s, i) -> concat(substring(`{text_col}`, "
        "int(if(i = 0, 0L, __pii_merged[i - 1].end)) + 1, int(s.start - if(i = 0, 0L, __pii_merged[i - 1].end))), "
        f"'[', upper(s.kind), ']')), ''), substring(`{text_col}`, int(element_at(__pii_merged, -1).end) + 1))"
    )
    done = found.withColumn("__pii_merged", merged).withColumn(
        text_col, F.when(F.size("__pii_merged") > 0, pieces).otherwise(F.col(f"`{text_col}`"))
    )
    return done.select([F.col(f"`{c}`") for c in df.columns])


def digest(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, counts of the base kinds, hash of the base spans, all spans as text."""
    spans = with_spans(df.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")), text_col, "found")
    base = [k.name for k in KINDS if k.base]
    line = "transform({}, s -> concat(s.kind, ':', s.start, ':', s.end))"
    return spans.select(
        id_col,
        *(F.expr(f"cast(size(filter(found, s -> s.kind = '{k}')) as bigint)").alias(f"n_{k}") for k in base),
        F.sha2(F.array_join(F.expr(line.format(f"filter(found, s -> s.rank < {len(base)})")), ","), 256).alias("base_sha256"),
        F.array_join(F.expr(line.format("found")), ",").alias("spans"),
    )
