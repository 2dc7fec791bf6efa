"""Time parsing. All results are zone-free timestamps; the session zone is UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
COMPACT = "yyyyMMddHHmmss"
SECONDS_BELOW = 946684800  # numbers under this are seconds, others milliseconds
MAX_EPOCH_MILLIS = 8.64e15  # a larger number is not a time at all

MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]
ZONE_HOURS = {
    "z": 0, "ut": 0, "utc": 0, "gmt": 0, "est": -5, "edt": -4, "cst": -6, "cdt": -5, "mst": -7,
    "mdt": -6, "pst": -8, "pdt": -7,
}
SLASHED_FORMATS = ["M/d/yyyy", "M/d/yyyy HH:mm", "M/d/yyyy HH:mm:ss"]

_NUMBER = r"^\s*([+-]?(?:\d+\.?\d*(?:[eE][+-]?\d+)?|\.\d+(?:[eE][+-]?\d+)?))"
# Written dates: weekday, month word and day in either order, year, time, half of day, zone word,
# offset, and a remark in brackets. All but month, day and year may be absent.
_MONTH = "(" + "|".join(MONTHS) + r")[a-z]*\.?"
_GAP = r"[\s,./-]+"
_WORDED = (
    r"(?i)^\s*(?:(?:sun|mon|tue|wed|thu|fri|sat)[a-z]*\.?,?\s+)?"
    rf"(?:{_MONTH}{_GAP}(\d{{1,2}})(?:st|nd|rd|th)?|(\d{{1,2}})(?:st|nd|rd|th)?{_GAP}{_MONTH}){_GAP}(\d{{4}})"
    r"(?:(?:,?\s+(?:at\s+)?|t)(\d{1,2}):(\d{2})(?::(\d{2})(?:\.\d*)?)?(?:\s*([ap])\.?m\.?)?)?"
    r"(?:\s*(" + "|".join(sorted(ZONE_HOURS, key=len, reverse=True)) + r"))?"
    r"(?:\s*([+-])(\d{2}):?(\d{2}))?\s*(?:\(.*\))?\s*$"
)


def ntz(c: Column) -> Column:
    return c.cast("timestamp_ntz")


def _let(value: Column, body) -> Column:
    """``body`` over a value that is computed once, also inside a lambda."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _parse(c: Column, formats: list[str]) -> Column:
    """The first format that fits; the formats are constants, so each formatter is built once."""
    return ntz(F.coalesce(*[F.try_to_timestamp(c, F.lit(f)) for f in formats]))


def parse_compact(c: Column) -> Column:
    """14 digits, year to second. Out-of-range parts give null."""
    return F.when(c.rlike(r"^\d{14}\z"), ntz(F.try_to_timestamp(c, F.lit(COMPACT))))


def parse_worded(c: Column) -> Column:
    """A written date, shifted to UTC if it names a zone or an offset, cut to the second.

    ``Jan 5, 2024``, ``5 January 2024 10:00:30``, ``January 5, 2024 3:04 PM``, ``Jan-05-2024``,
    ``Jan 5, 2024 10:00 EST``, ``Jan 5, 2024 10:00 +0200`` and
    ``Fri Jan 05 2024 10:00:00 GMT+0530 (India Standard Time)`` are such dates. A day, hour or
    minute that does not exist gives null.
    """

    # one match, its groups side by side
    groups = F.regexp_replace(c, _WORDED, "|".join(f"${i}" for i in range(1, 14)))
    return F.when(c.rlike(_WORDED), _let(F.split(groups, r"\|", -1), _from_parts))


def _from_parts(parts: Column) -> Column:
    def part(i: int) -> Column:
        return F.nullif(F.get(parts, F.lit(i - 1)), F.lit(""))

    def number(i: int) -> Column:
        return part(i).cast("int")

    # each month word takes four characters of the list
    month = F.floor((F.instr(F.lit(" ".join(MONTHS)), F.lower(F.coalesce(part(1), part(4)))) + 3) / 4).cast("int")
    hour, half = F.coalesce(number(6), F.lit(0)), F.lower(part(9))
    hour = (
        F.when(half.isNull(), hour)
        .when(hour.between(1, 12), hour % 12 + F.when(half == "p", 12).otherwise(0))
        .otherwise(F.lit(99))
    )
    zone = F.create_map(*[F.lit(x) for pair in ZONE_HOURS.items() for x in pair])
    minutes = F.coalesce(F.element_at(zone, F.lower(part(10))) * 60, F.lit(0)) + F.coalesce(
        F.concat(part(11), F.lit("1")).cast("int") * (number(12) * 60 + number(13)), F.lit(0)
    )
    local = F.try_make_timestamp_ntz(
        number(5), month, F.coalesce(number(2), number(3)), hour,
        F.coalesce(number(7), F.lit(0)), F.coalesce(number(8), F.lit(0)),
    )
    return ntz(F.timestamp_seconds(F.unix_seconds(local.cast("timestamp")) - minutes * 60))


def parse_iso(c: Column) -> Column:
    return F.when(c.rlike(r"^\s*\d{4}-\d{1,2}-\d{1,2}"), ntz(c.try_cast("timestamp_ntz")))


def _millis_to_ts(millis: Column) -> Column:
    # years 1 to 9999; a time outside them cannot be stored
    storable = millis.between(-62135596800000, 253402300799999)
    return F.when(storable, ntz(F.timestamp_seconds(F.floor(millis / 1000).cast("bigint"))))


def resolve_time(c: Column, mode: str = "reference") -> Column:
    """One candidate value as ``struct(found, ts)``.

    ``found`` with a null ``ts`` is a value that is taken as the time but cannot be stored:
    no further candidate is tried and the row becomes a reject.

    ``reference`` reads numbers before date text, so ``2024-11-01`` is the number 2024.
    ``corrected`` reads ISO text first and takes numbers under 1e11 as seconds.
    """
    limit = SECONDS_BELOW if mode == "reference" else 1e11

    def taken(ts: Column) -> Column:
        return F.struct(F.lit(True).alias("found"), ts.alias("ts"))

    def from_words(c: Column) -> Column:
        return _let(
            parse_worded(c), lambda ts: F.struct(ts.isNotNull().alias("found"), ts.alias("ts"))
        )

    def from_number(number: Column) -> Column:
        # whole milliseconds, cut towards zero
        scaled = F.when(number < limit, number * 1000).otherwise(number)
        return _let(
            scaled,
            lambda ms: F.when(
                F.abs(ms) <= MAX_EPOCH_MILLIS,
                taken(_millis_to_ts(F.signum(ms) * F.floor(F.abs(ms)))),
            ).otherwise(from_words(c)),
        )

    def from_number_or_words() -> Column:
        return _let(F.regexp_extract(c, _NUMBER, 1).try_cast("double"), from_number)

    compact = c.rlike(r"^\d{14}\z")
    if mode == "reference":
        return F.when(compact, taken(parse_compact(c))).otherwise(from_number_or_words())
    if mode == "corrected":
        return F.when(compact, taken(parse_compact(c))).otherwise(
            _let(
                parse_iso(c),
                lambda iso: F.when(iso.isNotNull(), taken(iso)).otherwise(from_number_or_words()),
            )
        )
    raise ValueError(f"unknown time mode {mode!r}")


def first_time(candidates: Column, as_of: Column, mode: str = "reference") -> Column:
    """The first candidate of an array that is a time, else ``as_of``; null only for a
    value that is taken but cannot be stored."""
    start = F.struct(
        F.lit(False).alias("found"), F.lit(None).cast("timestamp_ntz").alias("ts")
    )
    best = F.aggregate(
        candidates, start, lambda acc, x: F.when(acc["found"], acc).otherwise(resolve_time(x, mode))
    )
    return _let(best, lambda b: F.when(b["found"], b["ts"]).otherwise(ntz(as_of)))


def strict_date(c: Column) -> Column:
    head = F.substring(c, 1, 10)
    return F.when(head.rlike(r"^\d{4}-\d{2}-\d{2}\z"), F.try_to_date(head, "yyyy-MM-dd"))


def strict_timestamp(c: Column) -> Column:
    head = F.substring(c, 1, 19)
    shaped = head.rlike(r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}\z")
    return F.when(shaped, ntz(F.try_to_timestamp(head, F.lit("yyyy-MM-dd HH:mm:ss"))))


def passthrough_timestamp(c: Column) -> Column:
    return F.nullif(c, F.lit("")).try_cast("timestamp_ntz")


def auto_timestamp(c: Column) -> Column:
    """Automatic time format of a load: ISO, 14 digits, slashed and worded forms."""
    return F.coalesce(
        parse_iso(c), parse_compact(c), _parse(c, SLASHED_FORMATS), parse_worded(c)
    )


def auto_date(c: Column) -> Column:
    eight = F.when(c.rlike(r"^\d{8}\z"), F.try_to_date(c, "yyyyMMdd"))
    return F.coalesce(auto_timestamp(c).cast("date"), eight)
