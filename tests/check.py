"""Runs registered queries against their SQL in DuckDB. ``compare`` is also used by the tests."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if isinstance(v, decimal.Decimal):
        return str(v)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return v if v is None else f"{type(v).__name__}:{v}"


def type_name(t) -> str:
    names = {
        "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
        "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMPTZ",
    }
    s = t.simpleString()
    return names.get(s, s.upper())


def compare(spark, con, name, fn, sql, sf_dir):
    """(ok, message, rows)"""
    df = fn(spark, sf_dir)
    rows = df.collect()
    if sql is None:
        return True, "no oracle", len(rows)
    rel = con.sql(sql)
    want_types = dict(zip(rel.columns, map(str, rel.types)))
    got_types = {f.name: type_name(f.dataType) for f in df.schema.fields}
    want = rel.fetchall()
    if set(want_types) != set(got_types):
        return False, f"columns {sorted(got_types)} != {sorted(want_types)}", len(rows)
    diff = {
        c: (got_types[c], want_types[c])
        for c in got_types
        if got_types[c].replace(" ", "") != want_types[c].replace(" ", "")
    }
    cols = sorted(want_types)
    idx = {c: i for i, c in enumerate(rel.columns)}
    a = sorted(repr([norm(r[c]) for c in cols]) for r in rows)
    b = sorted(repr([norm(r[idx[c]]) for c in cols]) for r in want)
    if a != b:
        extra = [x for x in a if x not in set(b)][:3]
        lack = [x for x in b if x not in set(a)][:3]
        return False, f"rows {len(a)} vs {len(b)}\n   spark only {extra}\n   duck only {lack}", len(rows)
    if diff:
        return False, f"types {diff}", len(rows)
    return True, "ok", len(rows)


def main():
    from pyspark.sql import SparkSession

    import __spark_entry__ as e

    sf = sys.argv[1]
    wanted = sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = duck(sf), []
    oracles = e.oracle_sql()
    for name, fn in e.queries().items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        t = time.time()
        try:
            ok, message, n = compare(spark, con, name, fn, oracles.get(name), sf)
        except Exception as ex:  # report and go on
            ok, message, n = False, f"{type(ex).__name__}: {str(ex)[:1500]}", -1
        print(f"{'ok  ' if ok else 'FAIL'} {name} rows={n} {time.time() - t:.1f}s {'' if message == 'ok' else message}", flush=True)
        if not ok:
            bad.append(name)
    print("failed:", bad)


if __name__ == "__main__":
    main()
