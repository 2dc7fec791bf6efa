"""Typed load: required fields, casts, truncation, null rules, rejects."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventmart.functions.times import auto_date, auto_timestamp
from eventmart.functions.values import (
    blank_as_null_sql,
    normalize_variant,
    truncate_bytes_sql,
)
from eventmart.schemas import LOAD_TIME_COLUMNS, MAX_BYTES, REQUIRED
from eventmart.sources.ndjson import RAW, SOURCE

REASON = "_reject_reason"


@dataclass(frozen=True)
class LoadPolicy:
    """Options of one load. ``max_errors`` is the number of rejects at which the load fails;
    without it the first reject fails it."""

    truncate_columns: bool = True
    blanks_as_null: bool = True
    empty_as_null: bool = True
    max_errors: int | None = None
    accept_invalid_bytes: bool = False
    parse_json_text: bool = False

    @property
    def limit(self) -> int:
        """The number of rejects at which a load fails."""
        return self.max_errors if self.max_errors is not None else 1

    def fails(self, rejects: int) -> bool:
        return rejects >= self.limit


# The four loads.
ATTRIBUTION_LOAD = LoadPolicy(max_errors=10)
CANONICAL_LOAD = LoadPolicy(max_errors=100, accept_invalid_bytes=True)
PATH_LOAD = LoadPolicy()
DOCUMENT_LOAD = LoadPolicy(max_errors=10)

# Reasons of the receiving check.
EMPTY_PAYLOAD = "Empty payload"
MISSING_FIELDS = "Missing required fields"


class LoadFailed(RuntimeError):
    """Raised when a load has too many rejects; nothing of the batch becomes visible."""


def _decimal(c: Column, kind: T.DecimalType) -> Column:
    # digits beyond the scale are cut, not rounded
    cut = F.regexp_replace(c, r"^(\s*[+-]?\d*\.\d{%d})\d+(\s*)$" % kind.scale, "$1$2")
    return cut.try_cast(kind)


def _cast(c: Column, kind: T.DataType) -> Column:
    """A cleaned text value as a typed one, null if it cannot be cast."""
    if isinstance(kind, T.TimestampNTZType):
        return auto_timestamp(c)
    if isinstance(kind, T.DateType):
        return auto_date(c)
    if isinstance(kind, T.DecimalType):
        return _decimal(c, kind)
    return c.try_cast(kind)


def _caster(kind: T.DataType):
    return lambda x: F.when(x.isNotNull(), _cast(x, kind))


def check_required(df: DataFrame, raw: str | None = None) -> DataFrame:
    """Add the receiving check's ``_reject_reason``: an empty payload, or a required field that
    is missing or empty. ``raw`` names a column with the payload text, if there is one."""
    if raw is not None:
        empty = F.coalesce(F.size(F.json_object_keys(F.col(raw))), F.lit(0)) <= 0
    else:
        columns = [c for c in df.columns if c not in (RAW, SOURCE)]
        empty = F.expr("coalesce(" + ", ".join(f"CAST(`{c}` AS STRING)" for c in columns) + ") IS NULL")
    lacking = F.lit(False)
    for name in REQUIRED:
        lacking = lacking | F.coalesce(F.col(name) == "", F.lit(True))
    return df.withColumn(REASON, F.when(empty, EMPTY_PAYLOAD).when(lacking, MISSING_FIELDS))


def cast_rows(df: DataFrame, table: T.StructType, policy: LoadPolicy) -> DataFrame:
    """Text columns -> table columns plus ``_reject_reason`` (null for a good row).

    One pass, no shuffle. A column that the input lacks is null. Columns of one type are cast
    together, as one array, which keeps the generated code of wide tables small; plain text
    columns stay on their own and can be pruned.
    """
    kinds = dict(df.dtypes)
    fields = [f for f in table.fields if f.name not in LOAD_TIME_COLUMNS]
    clean: dict[str, str] = {}
    out: dict[str, str] = {}
    groups: dict[str, list[T.StructField]] = {}
    for f in fields:
        c, kind = f"`{f.name}`", f.dataType.simpleString()
        if f.name not in kinds:
            out[f.name] = f"CAST(NULL AS {kind})"
        elif kind == "variant":
            out[f.name] = c
        elif kinds[f.name] != "string":
            out[f.name] = f"CAST({c} AS {kind})"
        else:
            if policy.blanks_as_null:
                clean[f.name] = blank_as_null_sql(c)
            elif policy.empty_as_null:
                clean[f.name] = f"nullif({c}, '')"
            if kind == "string":
                limit = f.metadata.get(MAX_BYTES)
                cut = limit is not None and policy.truncate_columns
                out[f.name] = truncate_bytes_sql(c, limit) if cut else c
            else:
                groups.setdefault(kind, []).append(f)

    arrays: dict[str, Column] = {}
    failures: list[Column] = []
    for g, (kind, members) in enumerate(groups.items()):
        name = f"_g{g}"
        if len(members) == 1:  # a column alone needs no array
            f = members[0]
            arrays[name] = _caster(f.dataType)(F.col(f.name))
            bad = F.col(f.name).isNotNull() & F.col(name).isNull()
            failures.append(F.when(bad, F.lit(f"{f.name}: not a {kind}")))
            out[f.name] = name
            continue
        texts = F.array(*[f.name for f in members])
        arrays[name] = F.transform(texts, _caster(members[0].dataType))
        labels = F.expr("array(" + ", ".join(f"'{f.name}: not a {kind}'" for f in members) + ")")
        failed = F.zip_with(texts, F.col(name), lambda x, y: x.isNotNull() & y.isNull())
        named = F.zip_with(failed, labels, lambda bad, label: F.when(bad, label))
        failures.append(F.get(F.array_compact(named), F.lit(0)))
        for i, f in enumerate(members):
            out[f.name] = f"get({name}, {i})"

    earlier = [F.col(REASON)] if REASON in kinds else []
    malformed = [F.when(F.col(RAW).isNotNull(), "not JSON")] if RAW in kinds else []
    reason = F.coalesce(*malformed, *earlier, *failures, F.lit(None).cast("string"))
    if policy.parse_json_text:
        documents = [f.name for f in fields if kinds.get(f.name) == "variant"]
        df = df.withColumns({c: normalize_variant(F.col(c)) for c in documents})
    cleaned = df.selectExpr(*[f"{clean[c]} AS `{c}`" if c in clean else f"`{c}`" for c in df.columns])
    return (
        cleaned.withColumns(arrays)
        .withColumn(REASON, reason)
        .selectExpr(
            *[f"{out[f.name]} AS `{f.name}`" for f in fields],
            REASON,
            *[c for c in (RAW, SOURCE) if c in kinds],
        )
    )


def stamp(df: DataFrame, batch_time: Column) -> DataFrame:
    """Load-time defaults: one time per batch, so a replay writes the same rows."""
    return df.withColumns({c: batch_time.cast("timestamp_ntz") for c in LOAD_TIME_COLUMNS})


def project_to(df: DataFrame, table: T.StructType) -> DataFrame:
    """Exactly the table's columns in table order, null for missing ones."""
    have = set(df.columns)
    return df.selectExpr(
        *[
            f"CAST({f'`{f.name}`' if f.name in have else 'NULL'} AS {f.dataType.simpleString()})"
            f" AS `{f.name}`"
            for f in table.fields
        ]
    )


def good(df: DataFrame) -> DataFrame:
    return df.where(F.col(REASON).isNull()).drop(REASON, RAW, SOURCE)


def rejected(df: DataFrame) -> DataFrame:
    return df.where(F.col(REASON).isNotNull())
