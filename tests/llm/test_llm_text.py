"""Operators on single texts: quality rules, classifier, personal data, chat."""

import hashlib
import random
import re
import zlib
from pathlib import Path

import frames
import numpy as np
import pyarrow as pa
import pytest
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from eventmart.llm import chat, cnn_quality, compression_bands, pii
from eventmart.llm.textbatch import pack_arrays, packed, shingles, unpack_arrays, word_bounds

SF = "/root/testdata/sf0.01"


# ---- words and shingles ------------------------------------------------------------------
@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet=" \t\nabé 🙂Z", max_size=30), max_size=6))
def test_words_and_shingles(texts):
    data, offsets = packed(pa.array(texts, pa.string()))
    starts, ends = word_bounds(data, offsets)
    raw = data.tobytes()
    assert [raw[a:b].decode() for a, b in zip(starts, ends)] == [w for t in texts for w in frames.word_list(t)]
    hashes, at = shingles(data, offsets, 5, lower=True)
    known: dict = {}
    for i, t in enumerate(texts):
        w = frames.word_list(frames.lower(t))
        want = [tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))] if w else []
        got = hashes[at[i] : at[i + 1]].tolist()
        assert len(got) == len(want)
        for g, x in zip(got, want):
            assert known.setdefault(x, g) == g
    assert len(set(known.values())) == len(known)


def test_packed_arrays():
    arrays = [np.arange(5, dtype=np.uint64) << np.uint64(40), np.zeros(0, np.int64), np.array([1, 2], np.uint8)]
    assert all((a == b).all() and a.dtype == b.dtype for a, b in zip(arrays, unpack_arrays(pack_arrays(*arrays))))


# ---- quality rules -----------------------------------------------------------------------
def rules_by_brute_force(text):
    text = text or ""
    words = frames.word_list(text)
    lines, dup = [], 0
    for line in text.split("\n"):
        if frames.word_list(line):
            dup += line in lines
            lines.append(line)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    marked = {i + j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(3)}
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(marked),
        len(words) < 50 or 100 * len(marked) > 50 * len(words),
    )


RULE_TEXTS = [
    None, "", " \n\t", "a b c a b c a", "x\nx\n\n \ny\nx", "é" * 10 + " #$ <|>", frames.prose(49, 1), frames.prose(50, 1),
    "Und " * 300, frames.prose(400, 2) + "\n" + frames.prose(400, 2), "a b\x1cc\x85d", "日本語 " * 20,
]


def test_rules(spark):
    df = spark.createDataFrame(list(enumerate(RULE_TEXTS)), "doc_id long, text string").repartition(2)
    got = {r.doc_id: r for r in compression_bands.assess(df).collect()}
    for i, t in enumerate(RULE_TEXTS):
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == rules_by_brute_force(t), t
        assert not (r.base_failed and r.kept)


def test_bands():
    z, bands = zstandard.ZstdCompressor(level=3), compression_bands.Bands()
    rng = np.random.default_rng(1)
    prose = frames.prose(3000, 3)
    # random hexadecimal words hardly repeat but have few symbols: within the bands or not, by ratio
    noise = " ".join(rng.bytes(30).hex() + chr(0x4E00 + int(i)) * 9 for i in rng.integers(0, 20000, 400))
    table = "\n".join(f"row {i} | 0 | 0 | 0 | 0 | 0 | 0 | 0 | n{i}" for i in range(900))
    for text in (prose, noise, table):
        data = text.encode()
        whole, bad = compression_bands.ratios(data, bands, z)
        assert whole == len(z.compress(data)) / len(data)
        _, low, high = max(b for b in bands.whole if b[0] <= len(data))
        m = compression_bands.measure(text, bands, z)
        assert m[6] == (not m[5] and low <= whole <= high and bad <= bands.chunk_share)
    assert not compression_bands.measure(table, bands, z)[6]


def test_rules_keep_clean_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id")
    r = compression_bands.assess(docs).join(docs.select("doc_id", "quality"), "doc_id").where("not base_failed and quality = 1")
    assert r.where("not kept").count() == 0


def long_prose(n):
    """Words by Zipf's law: whole ratios of 0.36 to 0.37 from 0.25 MB on, hardly a window twice."""
    words = list(dict.fromkeys(frames.prose(12000, 3).replace(".", "").split()))
    return " ".join(random.Random(3).choices(words, [1 / (i + 20) for i in range(len(words))], k=n))


def test_long_clean_texts_are_kept():
    z, bands = zstandard.ZstdCompressor(level=3), compression_bands.Bands()
    for n, size in ((45_000, 0.25), (180_000, 1), (700_000, 4)):
        text = long_prose(n)
        assert len(text) > size * 1e6 and compression_bands.measure(text, bands, z)[6], n


@pytest.mark.parametrize("name", ["GPL-2", "GPL-3", "LGPL-2", "LGPL-2.1", "GFDL-1.2", "GFDL-1.3"])
def test_ordinary_english_is_kept(name):
    path = Path("/usr/share/common-licenses") / name
    if not path.exists():
        pytest.skip("no such text here")
    assert compression_bands.measure(path.read_text(), compression_bands.Bands(), zstandard.ZstdCompressor(level=3))[6]


def test_long_forms_are_rejected():
    """A form filled in over and over: no window comes twice and each chunk looks clean, the whole text does not."""
    z, bands, words = zstandard.ZstdCompressor(level=3), compression_bands.Bands(), frames.prose(1200, 4).split()
    for n in (4, 10, 40, 120):
        text = " ".join(w if i % 3 else str(1200 * k + i) for k in range(n) for i, w in enumerate(words))
        m = compression_bands.measure(text, bands, z)
        assert not m[5] and m[8] == 0 and not m[6], n


def test_rules_edge_cases(spark):
    df = frames.documents(spark, clashing=True)
    assert compression_bands.assess(df).count() == df.count()
    kept = compression_bands.keep(df)
    assert kept.columns == df.columns and 0 < kept.count() < df.count()
    assert compression_bands.assess(frames.empty(spark)).count() == 0 == compression_bands.keep(frames.empty(spark)).count()


# ---- classifier --------------------------------------------------------------------------
def test_features_cover_the_whole_text():
    rng = np.random.default_rng(0)
    model = cnn_quality.Model(rng.normal(size=(6, 256, 24)).astype(np.float32), rng.normal(size=24).astype(np.float32), np.ones(48, np.float32), 0.0)
    texts = ["", "a", frames.prose(10, 1), frames.prose(100, 2), None, frames.prose(9000, 3), "b" * 256, "c" * 257]
    data, offsets = packed(pa.array(texts, pa.string()))
    got = cnn_quality._pool(model, data, offsets)
    for i, t in enumerate(texts):
        raw = np.frombuffer((t or "").encode(), np.uint8)
        if not len(raw):
            assert not got[i].any()
            continue
        z = np.zeros((len(raw), 24), np.float32)
        for j in range(6):
            z += model.filters[j][np.append(raw, np.zeros(6, np.uint8))[j : j + len(raw)]]
        blocks = [np.tanh(z[k : k + 256].max(axis=0) + model.bias) for k in range(0, len(raw), 256)]
        chunks = [np.maximum(a, b) for a, b in zip(blocks, blocks[1:])] or blocks
        assert np.allclose(got[i], np.concatenate([np.mean(chunks, axis=0), np.max(chunks, axis=0)]), atol=1e-4)


def test_classifier_on_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    model = cnn_quality.fit(docs, labels)
    rows = cnn_quality.score(docs, model).join(labels, "doc_id").where("held_out").collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in rows)
    assert np.mean([r.predicted == r.quality for r in rows]) >= 0.95
    junk, clean = ([r.score for r in rows if r.quality == q] for q in (0, 1))
    assert np.mean(clean) > np.mean(junk) + 0.5


def test_classifier_edge_cases(spark):
    df = frames.documents(spark, clashing=True)
    for labels in ([], [(1, 1, 0), (2, 1, 0)], [(1, None, None), (None, 1, 0)]):
        model = cnn_quality.fit(df, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
        rows = cnn_quality.score(df, model).collect()
        assert len(rows) == df.count() and all(0 <= r.score <= 1 for r in rows)
    assert cnn_quality.score(frames.empty(spark), model).count() == 0


# ---- personal data -----------------------------------------------------------------------
BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    return sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(map(int, reversed(digits)))) % 10 == 0


def base_spans(text):
    out = []
    for rank, (kind, pattern) in enumerate(BASE.items()):
        for m in re.finditer(pattern, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            ok = {
                "email": True, "ip": kind != "ip" or all(int(p) <= 255 for p in m[0].split(".")),
                "card": 12 <= len(d) <= 19 and luhn(d), "phone": 9 <= len(d) <= 15,
            }[kind]
            if ok:
                out.append((m.start(), rank, kind, m.end()))
    return sorted(out)


PII_TEXTS = [
    None, "", "mail a.b+c@d-e.co.uk, x@y.z_w@e.f a@b a@b.c.d@e.f", "a@@b.c é🙂 q@r.st", "1.2.3.4.5.6.7.8 256.1.1.1 0001.2.3.4 1.2.3 9" * 2,
    "pay 4111 1111 1111 1111 or 4111-1111-1111-1112, 4111111111111111 5500005555555559", "+1 (555) 123-4567 ++49 30 901820 +1 +12345678",
    "IBAN DE89 3704 0044 0532 0130 00 and GB82WEST12345698765432, DE89370400440532013001", "my ssn 123-45-6789 but 987-65-4321 and 123-45-6789-1",
    "🙂🙂 a@b.co 🙂 +4930901820123 10.0.0.1", "9" * 5000 + " " + "a" * 5000, "1-" * 3000 + "x@y.org", "+1" + " " * 4000,
]


def test_spans(spark):
    df = spark.createDataFrame(list(enumerate(PII_TEXTS)), "doc_id long, text string").repartition(2)
    got = {r.doc_id: r for r in pii.digest(df).collect()}
    for i, t in enumerate(PII_TEXTS):
        want = base_spans(t)
        assert got[i].base_sha256 == hashlib.sha256(",".join(f"{k}:{a}:{b}" for a, _, k, b in want).encode()).hexdigest(), (t, got[i].spans)
        assert [got[i][f"n_{k}"] for k in BASE] == [sum(w[2] == k for w in want) for k in BASE]
    extra = lambda i, kind: [s for s in got[i].spans.split(",") if s.startswith(kind)]
    assert extra(7, "iban") == ["iban:5:32", "iban:37:59"]
    assert extra(8, "ssn") == ["ssn:7:18"]


IBANS = ["DE89370400440532013000", "GB82 WEST 1234 5698 7654 32", "NO9386011117947", "FR14 2004 1010 0505 0001 3M02 606"]
IBAN_TEXTS = [
    ("{0} BIC COBADEFFXXX", [0]), ("{0} 2024", [0]), ("{1} A payment", [1]), ("{0} {1}", [0, 1]), ("{1} {0} {3} {2} 7 X", [1, 0, 3, 2]),
    ("🙂 {2} {2}, {3}", [2, 2, 3]), ("AT12 {0} X", [0]), ("AB12 {1} 99", [1]), ("x{0} {0}x {0}-1 -{0} {0}1", []), ("DE89370400440532013001 2", []),
    ("QQ93 0000 0000 0000 0", []), ("{3}" + " {0}" * 40, [3] + [0] * 40),
]


def test_ibans_end_where_their_country_ends_them(spark):
    texts = [t.format(*IBANS) for t, _ in IBAN_TEXTS]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    found = {r.doc_id: [(s.start, s.end) for s in r.spans if s.kind == "iban"] for r in pii.with_spans(df).collect()}
    masked = {r.doc_id: r.text for r in pii.mask(df).collect()}
    for i, (text, (_, which)) in enumerate(zip(texts, IBAN_TEXTS)):
        assert [text[a:b] for a, b in found[i]] == [IBANS[k] for k in which], text
        assert not which or not any(x in masked[i] for x in IBANS), masked[i]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet="a@.-+ 0123459()é_", max_size=40), min_size=1, max_size=20))
def test_spans_of_random_texts(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    for r in pii.with_spans(df).collect():
        assert [(s.start, s.rank, s.kind, s.end) for s in r.spans if s.rank < 4] == base_spans(r.text)


def test_mask(spark):
    df = spark.createDataFrame([(i, t, "z") for i, t in enumerate(PII_TEXTS)], "doc_id long, text string, spans string")
    for r in pii.mask(df).collect():
        t = PII_TEXTS[r.doc_id]
        assert r.spans == "z" and (r.text is None) == (t is None)
        if t is not None:
            out, end, kinds = "", 0, pii.with_spans(df.where(F.col("doc_id") == r.doc_id), out="found").first().found
            merged = []
            for s in kinds:
                if merged and s.start < merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], s.end)
                else:
                    merged.append([s.start, s.end, s.kind])
            for a, b, k in merged:
                out, end = out + t[end:a] + f"[{k.upper()}]", b
            assert r.text == out + t[end:]
    df = frames.documents(spark, clashing=True)
    assert pii.mask(df).columns == df.columns and pii.mask(df).count() == df.count()
    assert pii.mask(frames.empty(spark)).count() == 0 == pii.digest(frames.empty(spark)).count()


def test_pii_is_native(spark):
    plan = pii.digest(frames.documents(spark))._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


# ---- chat --------------------------------------------------------------------------------
@settings(max_examples=10, deadline=None)
@given(st.lists(st.text(alphabet="<[\\|>/sINST] \nend_turn", max_size=30), min_size=1, max_size=20))
def test_escapes_are_reversible(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string").coalesce(1)
    for r in df.select("t", chat.escape(F.col("t")).alias("e"), chat.unescape(chat.escape(F.col("t"))).alias("u")).collect():
        assert r.u == r.t
        assert not any(c in r.e for c in (chat.TURN, chat.TEXT, chat.END, "</s>", "[INST]", "[/INST]", "<|"))


LOG = "conv_id long, seq long, message_id long, kind string, role string, text string"


def test_log_is_folded(spark):
    log = [
        (1, 0, 10, "message", "user", "hi"), (1, 3, 11, "delta", None, "lo"), (1, 2, 11, "delta", "assistant", "hel"),
        (1, 4, 12, "delta", "user", "typo"), (1, 5, 12, "edit", "user", "fixed"), (1, 6, 13, "delta", "assistant", "bad"),
        (1, 7, 13, "regenerate", None, None), (1, 8, 13, "delta", None, "go"), (1, 9, 13, "delta", None, "od"),
        (2, None, None, "message", None, None), (2, 1, None, "message", "assistant", "a<|end|>\\["), (2, 1, None, "message", "assistant", "a<|end|>\\["),
        (None, 0, 1, None, "user", "x"), (3, 0, 1, "regenerate", "assistant", "lost"),
    ]
    done = chat.render(chat.fold(spark.createDataFrame(log, LOG).repartition(4)))
    got = {r.conv_id: r for r in done.select("conv_id", chat.parse(F.col("formatted")).alias("turns"), "segments", "formatted").collect()}
    turns = {k: [(t.role, t.text) for t in r.turns] for k, r in got.items()}
    assert turns == {
        1: [("user", "hi"), ("assistant", "hello"), ("user", "fixed"), ("assistant", "good")],
        2: [("", ""), ("assistant", "a<|end|>\\["), ("assistant", "a<|end|>\\[")],
        None: [("user", "x")],
        3: [("assistant", "")],
    }
    assert [s.text for s in got[1].segments if s.loss] == ["hello", "good"]
    for r in got.values():
        assert "".join(s.text for s in r.segments) == r.formatted


def test_chat_edge_cases(spark):
    empty = spark.createDataFrame([], LOG)
    assert chat.digest(chat.render(chat.fold(empty))).count() == 0
    big = "word " * 100_000
    rows = [(5, i, None, "message", "assistant" if i % 2 else "user", big if i == 1 else f"t{i}") for i in range(3000)]
    r = chat.digest(chat.render(chat.fold(spark.createDataFrame(rows, LOG)))).first()
    loss = "".join(x[5] for x in rows if x[4] == "assistant")
    assert (r.n_turns, r.loss_chars) == (3000, len(loss))
    assert r.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    assert r.turns_sha256 == hashlib.sha256("".join(f"{x[4]}\n{x[5]}\n" for x in rows).encode()).hexdigest()
    plan = chat.digest(chat.render(chat.fold(spark.createDataFrame(rows[:3], LOG))))._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_iban_spans_equal_sql(spark):
    """IBANs followed by capitals and digits, side by side, with blanks, of no country, and one that starts in another."""
    import duckdb
    import pyarrow as pa

    from eventmart.llm import sql

    texts = [
        "DE89370400440532013000 2024", "DE89370400440532013000 BIC COBADEFFXXX", "GB82 WEST 1234 5698 7654 32 A payment",
        "GB82WEST12345698765432 DE89370400440532013000", "xDE89370400440532013000", "DE89370400440532013000x", "DE8937040044053201300",
        "AB12 DE89 3704 0044 0532 0130 00 and ZZ68539007547034", "NO9386011117947.", None, "", "ZZ12ABCDEFGHIJKLMN",
        "FR1420041010050500013M02606 FR14 2004 1010 0505 0001 3M02 606 7", "write a@b.co ssn 123-45-6789, +1 (555) 010-0000, 4111 1111 1111 1111",
    ]
    rows = [(i, t, "s") for i, t in enumerate(texts)]
    got = sorted(tuple(r) for r in pii.digest(frames.documents(spark, rows)).select("doc_id", "base_sha256", "spans").collect())
    con = duckdb.connect()
    con.register("documents", pa.table({"doc_id": list(range(len(texts))), "text": texts}))
    assert got == sorted(con.sql(f"SELECT doc_id, base_sha256, spans FROM ({sql.PII})").fetchall())
    assert sum(s.count("iban") for _, _, s in got) >= 8
