"""The registered queries on the smallest tables, and the pipeline stage by stage."""

from collections import Counter, defaultdict
from pathlib import Path

import frames
import pytest
import zstandard
from check import compare, duck

import __spark_entry__ as driver
import corpus_pipeline
from eventmart.llm import compression_bands, pii
from eventmart.session import materialize

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="no test data")
QUERIES, ORACLES = driver.queries(), driver.oracle_sql()
OPS = sorted(k for k in QUERIES if k.startswith("op") and k[2].isdigit())


def test_every_operator_has_a_query():
    assert {int(k[2:].split("_")[0]) for k in OPS} == set(range(1, 14)) and "pipeline" in QUERIES


@pytest.mark.parametrize("name", OPS)
def test_query(spark, name):
    ok, message, rows = compare(spark, duck(SF), name, QUERIES[name], ORACLES.get(name), SF)
    assert ok, message
    conversations = duck(SF).sql("select count(distinct conv_id) from conversations").fetchall()[0][0]
    expect = {"op3": 1 + conversations, "op12": conversations}.get(name.split("_")[0], 200)
    assert rows >= expect


def test_pipeline(spark):
    """Each stage against what it should do to its own input."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, z = docs.columns, zstandard.ZstdCompressor(level=3)
    tables = [docs]
    for name, stage in corpus_pipeline.STAGES:
        tables.append(materialize(stage(spark, tables[-1], SF), f"test-{name}"))
    rows = [t.collect() for t in tables]
    for t in tables[:-1]:
        assert t.columns == columns
    key = lambda rs: Counter((r.doc_id, r.text) for r in rs)

    kept = [r for r in rows[0] if compression_bands.measure(r.text or "", compression_bands.Bands(), z)[6]]
    assert key(rows[1]) == key(kept) and len(kept) < len(rows[0])

    plain = [(r.doc_id, r.text, r.source) for r in rows[1]]
    groups = frames.groups_by_brute_force(plain)
    assert key(rows[2]) == Counter((d, t) for i, (d, t, _) in enumerate(plain) if groups[i] == d)
    assert len(rows[2]) < len(rows[1])

    assert sorted(r.doc_id for r in rows[3]) == sorted(r.doc_id for r in rows[2])
    assert pii.with_spans(tables[3]).where("exists(spans, s -> s.kind in ('email', 'ip', 'card', 'phone'))").count() == 0
    assert all(r.n_chars == len(r.text) for r in rows[3])

    assert set(key(rows[4])) <= set(key(rows[3])) and max(key(rows[4]).values()) <= 3
    packed = defaultdict(int)
    for r in rows[5]:
        packed[r.doc_id] += r.n_words
    words = defaultdict(int)
    for r in rows[4]:
        words[r.doc_id] += len(frames.word_list(r.text))
    assert packed == words
    bins = defaultdict(list)
    for r in rows[5]:
        bins[r.bin_id].append(r)
    assert all(sum(r.n_words for r in b) <= 2048 and len({r.source for r in b}) == len(b) for b in bins.values())

    again = corpus_pipeline.run(spark, SF).collect()
    assert Counter((r.doc_id, r.piece, r.n_words) for r in again) == Counter((r.doc_id, r.piece, r.n_words) for r in rows[5])
