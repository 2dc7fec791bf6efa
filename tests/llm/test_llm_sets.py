"""Operators across documents: fingerprints, joins, repeats, tokens, mixing, packing."""

import hashlib
import io
import json
import random
import zlib
from collections import Counter, defaultdict

import frames
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from eventmart.llm import jaccard_join, linking, minhash, mixing, packing, simple8b, suffix_array, suffix_dedup


# ---- fingerprints ------------------------------------------------------------------------
def order_of(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))


@pytest.mark.parametrize("parts", ["1", "3", "8"])
def test_fingerprints(spark, parts):
    rows = [r for r in frames.texts() if r[0] is not None]
    rows = list({r[0]: r for r in rows}.values())
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        got = {r.doc_id: r for r in minhash.fingerprints(frames.documents(spark, rows, clashing=True)).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    rows = order_of(rows)
    assert len(got) == len(rows)
    sig = {t or "": s for (_, t, _), s in zip(rows, minhash.signatures([t or "" for _, t, _ in rows]))}
    for (i, t, _), (_, u, _) in zip(rows, rows[1:] + rows[:1]):
        t, u = t or "", u or ""
        new, r = minhash.edited(t, u), got[i]
        n = len(t) // 4
        assert new == t[: len(t) - n] + u[:n] and r.n_chars == len(t)
        assert r.edited_sha256 == hashlib.sha256(new.encode()).hexdigest()
        assert r.fingerprint == minhash.fingerprint(sig[t])
        assert r.edited_fingerprint == minhash.fingerprint(minhash.signatures([new])[0])
        for value, other in ((r.near_edited, new), (r.near_next, u)):
            x, y = frames.shingle_set(t), frames.shingle_set(other)
            true = len(x & y) / len(x | y) if x | y else 1.0
            assert abs(value - true) < 0.2


def test_fingerprint_edge_cases(spark):
    one = frames.documents(spark, [(5, frames.prose(60, 1), "s")])
    assert minhash.fingerprints(one).first().near_next == 1.0
    assert minhash.fingerprints(frames.empty(spark)).count() == 0
    rows = frames.texts()
    assert minhash.fingerprints(frames.documents(spark, rows)).count() == len(rows)


def test_long_text_has_the_same_signature_in_steps(monkeypatch):
    t = frames.prose(5000, 2)
    whole = minhash.signatures([t])
    monkeypatch.setattr(minhash, "_STEP", 7)
    assert (whole == minhash.signatures([t])).all()


# ---- joins -------------------------------------------------------------------------------
def check_groups(result, rows):
    want = Counter((rows[i][0], len(frames.shingle_set(rows[i][1])), c) for i, c in frames.groups_by_brute_force(rows).items())
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in result.collect()) == want


def test_join(spark):
    rows = frames.texts()
    df = frames.documents(spark, rows, clashing=True)
    result, links = jaccard_join.join(df)
    check_groups(result, rows)
    sets = {jaccard_join.class_id(_grams(t)): frames.shingle_set(t) for _, t, _ in rows}
    for r in links.collect():
        x, y = sets[r.a], sets[r.b]
        assert r.shared == len(x & y) and 100 * r.shared >= 75 * len(x | y)


def _grams(text):
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array([0]), pa.array([text or ""])], names=["doc_id", "text"])
    return next(jaccard_join.distinct_shingles(batch, 1))[1][0]


def test_join_of_random_near_copies(spark):
    """Chains and stars of copies around the limit, in which no one document is like all others."""
    seed = 1
    rng = random.Random(seed)
    rows, n = [], 0
    for g in range(6):
        text = frames.prose(rng.randint(20, 90), 100 * seed + g)
        for _ in range(14):
            rows.append((n, text, f"s{n % 3}"))
            n += 1
            if rng.random() < 0.5:
                text = frames.near(text, rng.randint(20, 45), n)
    check_groups(jaccard_join.join(frames.documents(spark, rows))[0], rows)
    check_groups(minhash.near_duplicates(frames.documents(spark, rows))[0], rows)


def test_join_edge_cases(spark):
    result, links = jaccard_join.join(frames.empty(spark))
    assert result.count() == 0 == links.count()
    nothing = [(1, None, "s"), (2, "", "s"), (None, " ", None)]
    check_groups(jaccard_join.join(frames.documents(spark, nothing))[0], nothing)
    result, links = minhash.near_duplicates(frames.documents(spark, nothing))
    check_groups(result, nothing)


def test_dedupe(spark):
    rows = frames.texts()
    df = frames.documents(spark, rows, clashing=True)
    kept = jaccard_join.dedupe(df)
    assert kept.columns == df.columns
    groups, got = frames.groups_by_brute_force(rows), Counter((r.doc_id, r.text) for r in kept.collect())
    want = Counter({(d, t) for i, (d, t, _) in enumerate(rows) if groups[i] == d})
    assert got == want


def test_prefix_filter_bounds():
    for n in range(1, 60):
        for m in range(n, 60):
            need = -(-75 * (n + m) // 175)
            if need <= n:  # sets that could be alike share an element among the first of each
                assert jaccard_join.prefix_length(n) >= n - need + 1
    assert not linking.possible(np.array([10]), np.array([20]), np.array([0]), np.array([0]), 75)[0]


@settings(max_examples=30, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1), unique=True, max_size=200), st.lists(st.integers(0, 2**64 - 1), unique=True, max_size=200))
def test_sketch_never_exceeds_the_difference(x, y):
    a, b = (linking.sketch(np.array(sorted(v), np.uint64)) for v in (x, y))
    assert linking.differing(a, b) <= len(set(x) ^ set(y))
    many = np.random.default_rng(len(x)).integers(0, 1 << 64, 3000, dtype=np.uint64)
    assert linking.differing(a, linking.sketch(np.concatenate([np.array(x, np.uint64), many]))) <= len(many)


def test_components(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(0, 40)] + [(100 + rng.randint(0, 60), 100 + rng.randint(0, 60)) for _ in range(50)] + [(500, 500 + i) for i in range(1, 80)] + [(7, 7)]
    up = {x: x for e in edges for x in e}

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, b in edges:
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    got = {r.node: r.component for r in linking.components(spark.createDataFrame(edges, "a long, b long").repartition(3)).collect()}
    assert got == {x: top(x) for x in up if any(a != b and x in (a, b) for a, b in edges)}


def test_components_in_small_chunks(spark, monkeypatch):
    """Edges of one node that lie in several chunks and tasks: a chain, a hub of the largest id, repeated edges."""
    monkeypatch.setattr(linking, "_CHUNK", 4)
    edges = [(i, i + 1) for i in range(0, 40)] + [(i, 999) for i in range(100, 130)] + [(200, 201)] * 5 + [(7, 7)]
    got = linking.components(spark.createDataFrame(edges, "a long, b long").repartition(5)).collect()
    want = {i: 0 for i in range(41)} | {i: 100 for i in [*range(100, 130), 999]} | {200: 200, 201: 200}
    assert sorted((r.node, r.component) for r in got) == sorted(want.items())
    assert linking.components(spark.createDataFrame([], "a long, b long")).count() == 0


# ---- repeated strings --------------------------------------------------------------------
@settings(max_examples=80, deadline=None)
@given(st.integers(1, 5), st.lists(st.integers(0, 4), max_size=80), st.booleans())
def test_suffix_array(symbols, values, recurse):
    text = np.array([v % symbols for v in values], np.uint8)
    before, suffix_array.SWEEP_SYMBOLS = suffix_array.SWEEP_SYMBOLS, 10**9 if recurse else 2
    try:
        sa = suffix_array.suffix_array(text, symbols)
    finally:
        suffix_array.SWEEP_SYMBOLS = before
    listed = text.tolist()
    assert sa.tolist() == sorted(range(len(listed)), key=lambda i: listed[i:])
    common = suffix_array.permuted_lcp(text, sa, 50)
    for a, b in zip(sa, sa[1:]):
        k = 0
        while k < 50 and max(a, b) + k < len(text) and text[a + k] == text[b + k]:
            k += 1
        assert common[b] == k


def repeats_by_brute_force(rows):
    data = [(d if d is not None else suffix_dedup.NO_ID, (t or "").encode()) for d, t, _ in rows]
    owner: dict = {}
    for d, b in data:
        for i in range(len(b) - 49):
            s = b[i : i + 50]
            owner[s] = min(owner.get(s, d), d)
    out = Counter()
    for (doc_id, _, _), (d, b) in zip(rows, data):
        hit = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - 49):
            if owner[b[i : i + 50]] < d:
                hit[i : i + 50] = True
        kept = bytes(np.frombuffer(b, np.uint8)[~hit[:-1]])
        spans = int((hit[:-1] & ~np.concatenate([[False], hit[:-2]])).sum()) if len(b) else 0
        out[(doc_id, len(b), int(hit.sum()), spans, hashlib.sha256(kept).hexdigest())] += 1
    return out


def check_repeats(spark, rows, **kw):
    got = suffix_dedup.digest(frames.documents(spark, rows, **kw)).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == repeats_by_brute_force(rows)


def test_repeats(spark):
    check_repeats(spark, frames.texts(), clashing=True)


def test_repeats_around_the_length(spark, monkeypatch):
    rng, rows = random.Random(5), []
    passages = [frames.prose(12, 900 + i)[:n] for i, n in enumerate((48, 49, 50, 51, 52, 70))]
    for i in range(80):
        rows.append((rng.randint(0, 60), "".join(rng.choice(passages) + frames.prose(rng.randint(0, 9), rng.randint(0, 400)) for _ in range(4)), "s"))
    rows += [(70 + i, "ab" * rng.randint(20, 300), "s") for i in range(6)]
    check_repeats(spark, rows)


def test_repeats_edge_cases(spark):
    assert suffix_dedup.digest(frames.empty(spark)).count() == 0
    check_repeats(spark, [(1, None, "s"), (2, "", "s"), (3, "x" * 49, "s"), (4, "x" * 49, "s"), (None, "y" * 60, "s"), (None, "y" * 60, "s")])


# ---- tokens ------------------------------------------------------------------------------
@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 1), st.integers(0, 60000), st.integers(0, 2**64 - 1)), max_size=700))
def test_simple8b(values):
    ids = np.array(values, np.uint64)
    words, per_block = simple8b.encode(ids)
    assert per_block.sum() == len(words) and (simple8b.decode(words) == ids).all() and len(simple8b.decode(words)) == len(ids)
    at = np.concatenate([[0], np.cumsum(per_block)])
    for b in range(len(per_block)):  # each block alone
        assert (simple8b.decode(words[at[b] : at[b + 1]]) == ids[b * simple8b.BLOCK : (b + 1) * simple8b.BLOCK]).all()


def test_words_are_as_full_as_they_can_be():
    words, _ = simple8b.encode(np.array([1] * 60 + [3] * 30 + [2**61, 0], np.uint64))
    assert (words & np.uint64(15)).tolist()[:2] == [0, 1] and len(words) == 5  # the wide id: escape and itself


ODD = [
    "", " ", "a", " a", "a  b", "a\nb", "a\n\nb", "x \n y", "\n", "a\t b", "don't  I'll <|endoftext|> x", "é b", "a b ", "a\n", "\na",
    "it's 12 34 !! ?\nok", "a\xa0b c", "naïve café — 日本語 🙂　x", "a\r\nb", "x​y z", "a\x1fb c\x85d e", "..\n,, a.,b", "'s 't\n'm",
]


def vocabulary():
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def test_encoder_equals_the_tokenizer():
    e = simple8b.Encoder(vocabulary())
    texts = ODD + [t or "" for _, t, _ in frames.texts()] + ["\n".join(frames.prose(9, i) for i in range(50))]
    for some in (texts, texts[::-1]):
        for t, got, want in zip(some, e.encode(some), e._whole(some)):
            assert got.tolist() == want, t


def test_encoder_equals_the_library_with_added_tokens():
    from tokenizers import Tokenizer

    plain, e = Tokenizer.from_file(vocabulary()), simple8b.Encoder(vocabulary())
    texts = [
        "a <|endoftext|> b", "x<|endoftext|>", "<|endoftext|>", "<|endoftext|><|endoftext|>", "a<|endoftext|>.b\nc", "a\n<|endoftext|>\nb",
        "<|endoftext|", "a <|endoftext |> b", "end of text|>", "a b", "it's 12.\nok", *ODD,
    ]
    for some in (texts, texts[::-1]):
        for t, got in zip(some, e.encode(some)):
            assert got.tolist() == plain.encode(t, add_special_tokens=False).ids, t
    assert e.encode(["a <|endoftext|> b"])[0].tolist() == [64, 220, 50256, 275]


def test_encoder_that_forgets(monkeypatch):
    monkeypatch.setattr(simple8b, "CACHED_PIECES", 60)
    e = simple8b.Encoder(vocabulary())
    for i in range(40):
        texts = [frames.prose(30, i % 7), frames.prose(25, i) + "\nThe, end.", ODD[i % len(ODD)]]
        assert [x.tolist() for x in e.encode(texts)] == [list(x) for x in e._whole(texts)]
        assert len(e.codes) == len(e.start) == len(e.hits)


def test_encoder_looks_a_part_up_once_a_call(monkeypatch):
    class Counted(simple8b._Codes):
        def get(self, *a):
            looked.append(a[0])
            return super().get(*a)

    looked: list = []
    monkeypatch.setattr(simple8b, "_Codes", Counted)
    e = simple8b.Encoder(vocabulary())
    texts = ["on and on. on", "on. and", "on\nand on..\non. x_ on²"] * 5
    assert [x.tolist() for x in e.encode(texts)] == [list(x) for x in e._whole(texts)]
    assert looked and len(looked) == len(set(looked))
    e._forget()  # the marks behind words go with the words
    assert [x.tolist() for x in e.encode(texts)] == [list(x) for x in e._whole(texts)]


def test_batches_are_encoded_together(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(simple8b, "CUT_CHARS", 10)
    rows = [(1, "abcd"), (None, ""), (2, "efgh"), (3, "a b c d"), (4, "x" * 30), (5, "\ny")]
    batches = [pa.RecordBatch.from_arrays([pa.array([i], pa.int64()), pa.array([t])], names=["doc_id", "text"]) for i, t in rows]
    got = list(simple8b._gathered(iter(batches)))
    assert [k for k, _ in got] == [[1, None, 2, 3], [4], [5]]
    assert [r for k, t in got for r in zip(k, t)] == rows and not list(simple8b._gathered(iter([])))
    e, texts = simple8b.Encoder(vocabulary()), [t for _, t in rows] + ODD
    assert [x.tolist() for x in e.encode(texts)] == [list(x) for x in e._whole(texts)] and e.encode([]) == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab. \n\t,'s1é ", max_size=25), max_size=8))
def test_encoder_on_random_texts(texts):
    e = _ENCODER.setdefault("e", simple8b.Encoder(vocabulary())) if not _ENCODER else _ENCODER["e"]
    assert [x.tolist() for x in e.encode(texts)] == [list(x) for x in e._whole(texts)]


_ENCODER: dict = {}


def test_token_files(spark, monkeypatch):
    rows = frames.texts() + [(300 + i, t, "s") for i, t in enumerate(ODD)]
    folder = simple8b.new_folder(spark)
    manifest = simple8b.write(frames.documents(spark, rows, clashing=True), vocabulary(), folder)
    got = simple8b.digest(manifest, folder).collect()
    e = simple8b.Encoder(vocabulary())
    want = Counter()
    for d, t, _ in rows:
        ids = np.append(np.array(e._whole([t or ""])[0], "<u4"), np.uint32(0)).astype("<u4")
        want[(d, len(ids), zlib.crc32(ids.tobytes()))] += 1
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == want
    back = {(r.start, r.n_tokens, zlib.crc32(np.array(r.ids, "<u4").tobytes())) for r in simple8b.read(manifest, folder).collect()}
    assert back == {(r.start, r.n_tokens, r.ids_crc32) for r in got}
    got.sort(key=lambda r: r.start)
    assert [r.start for r in got] == np.concatenate([[0], np.cumsum([r.n_tokens for r in got])])[:-1].tolist()
    ids = [r.doc_id for r in got]
    assert ids == sorted(ids, key=lambda d: (d is not None, d or 0))
    simple8b.write(frames.empty(spark), vocabulary(), folder + "-none")
    assert simple8b.digest(simple8b.write(frames.empty(spark), vocabulary(), folder + "-0"), folder).count() == 0


def test_file_in_many_groups(monkeypatch):
    monkeypatch.setattr(simple8b, "GROUP", 2)
    rng = np.random.default_rng(2)
    ids = [rng.integers(0, 50257, n).astype(np.uint32) for n in (0, 1, 700, 256, 1500, 3)]
    out = io.BytesIO()
    assert simple8b.write_file(out, [5, None, 7, 8, 9, -3], ids) == sum(map(len, ids))
    doc_ids, n, flat = simple8b.read_file(out.getvalue())
    assert doc_ids == [5, None, 7, 8, 9, -3] and n.tolist() == [len(x) for x in ids] and (flat == np.concatenate(ids)).all()


# ---- mixing ------------------------------------------------------------------------------
def targets_by_rounds(sizes: dict) -> dict:
    """Hand the excess of full sources to the others, round by round."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    out, free, left = {}, set(names), float(sum(sizes.values()))
    while free:
        total = sum(weight[s] for s in free)
        full = {s for s in free if left * weight[s] / total > 3 * sizes[s]}
        if not full:
            return out | {s: left * weight[s] / total for s in free}
        for s in full:
            out[s] = 3.0 * sizes[s]
        left -= sum(out[s] for s in full)
        free -= full
    return out


MIXED = [(i, frames.prose(random.Random(i).randint(0, 900), i), s) for i, s in enumerate(["a"] * 150 + ["b"] * 40 + ["Z"] * 8 + ["é"] * 30 + [None] * 60)]


@pytest.mark.parametrize("rows", [frames.texts(), MIXED])
def test_mix(spark, rows):
    df = frames.documents(spark, rows, clashing=True)
    mixed, slots = mixing.mix(mixing.units_of(df))
    got = mixed.collect()
    assert len(got) == len(rows)
    sizes: dict = defaultdict(int)
    for _, t, s in rows:
        sizes[s] += len(frames.word_list(t))
    want, taken = targets_by_rounds(sizes), defaultdict(int)
    for r in got:
        assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6 * max(1, r.target)
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source] += r.taken
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 4 * mixing.BLOCK_WORDS + 0.02 * want[s], (s, taken[s], want[s])
    again, _ = mixing.mix(mixing.units_of(df.repartition(7)))
    key = lambda rs: Counter((r.doc_id, r.size, r.taken) for r in rs)
    assert key(got) == key(again.collect())


def test_schedule_is_even(spark):
    """Any prefix of the mix is close to the weights, and blocks of a source go round."""
    sources = spark.createDataFrame([(i + 1, f"s{i}", 100_000 * (i + 1), 1, 60_000.0 * (3 - i)) for i in range(3)], "sid int, source string, source_size long, weight int, target double")
    slots = sorted((r.slot, r.sid, r.rank, r.block) for r in mixing.schedule(sources).collect())
    total = sum(60_000.0 * (3 - i) for i in range(3))
    for upto in (10, 50, 300, len(slots)):
        seen = Counter(s for _, s, _, _ in slots[:upto])
        assert all(abs(seen[i + 1] - upto * 60_000.0 * (3 - i) / total) <= 5 for i in range(3))
    for sid in (1, 2, 3):
        mine = [(r, b) for _, s, r, b in slots if s == sid]
        blocks = 100_000 * sid // mixing.BLOCK_WORDS
        assert mine == [(k, k % blocks) for k in range(len(mine))]


def test_mix_applied(spark):
    df = frames.documents(spark, MIXED, clashing=True)
    out = mixing.apply(df)
    assert out.columns == df.columns
    taken = {r.doc_id: (r.size, r.taken) for r in mixing.mix(mixing.units_of(df))[0].collect()}
    got = Counter(r.doc_id for r in out.collect())
    for d, (size, t) in taken.items():
        assert abs(got[d] - (t / size if size else 0)) <= 0.5
    assert mixing.apply(frames.empty(spark)).count() == 0
    assert mixing.mix(mixing.units_of(frames.empty(spark)))[0].count() == 0
    wordless = frames.documents(spark, [(1, None, None), (2, " ", "x")])
    assert [r.taken for r in mixing.mix(mixing.units_of(wordless))[0].collect()] == [0, 0]
    assert mixing.apply(wordless).count() == 0
    rows = [(1, "some words here", "x"), (2, "", "x"), (3, None, None), (None, " \t", "y"), (1, "some words here", "x"), (4, "more", None)]
    assert {r.doc_id for r in mixing.apply(frames.documents(spark, rows)).collect()} == {1, 4}


# ---- packing -----------------------------------------------------------------------------
def pack_by_brute_force(sizes, sources, clusters, capacity):
    bins, out = [], []  # (room, sources, clusters)
    for n, s, c in zip(sizes, sources, clusters):
        fit = [(room, i) for i, (room, ss, cc) in enumerate(bins) if room >= n and s not in ss and (c < 0 or c not in cc)]
        if fit:
            i = min(fit)[1]
        else:
            bins.append((capacity, set(), set()))
            i = len(bins) - 1
        room, ss, cc = bins[i]
        out.append((i, capacity - room))
        bins[i] = (room - n, ss | {s}, cc | {c})
    return out


@settings(max_examples=80, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 20), st.integers(0, 4), st.integers(-1, 3)), max_size=60))
def test_pack_takes_the_tightest_compatible_bin(items):
    items.sort(reverse=True)
    sizes, sources, clusters = (list(x) for x in zip(*items)) if items else ([], [], [])
    assert packing.pack(sizes, sources, clusters, 20) == pack_by_brute_force(sizes, sources, clusters, 20)


@pytest.mark.parametrize("shard_pieces", [10, 4096])
def test_bins(spark, shard_pieces):
    rows = frames.texts()
    got = packing.best_fit(frames.documents(spark, rows, clashing=True).drop("cluster"), 500, shard_pieces).collect()
    pieces, bins = defaultdict(list), defaultdict(list)
    for r in got:
        pieces[(r.doc_id, r.source)].append((r.piece, r.first_word, r.n_words))
        bins[r.bin_id].append(r)
    sizes = defaultdict(list)
    for d, t, s in rows:
        sizes[(d, s)].append(len(frames.word_list(t)))
    for k, some in pieces.items():
        assert sum(n for _, _, n in some) == sum(sizes[k])
        assert all(f == p * 500 and n <= 500 for p, f, n in some)
    for some in bins.values():
        some.sort(key=lambda r: (r.bin_offset, r.n_words))
        assert sum(r.n_words for r in some) <= 500
        assert all(a.bin_offset + a.n_words == b.bin_offset for a, b in zip(some, some[1:]))
        assert len({r.source for r in some}) == len(some)
    copies = [r.bin_id for r in got if r.doc_id is not None and r.doc_id >= 200]
    assert len(set(copies)) == len(copies) == 15


def test_packing_edge_cases(spark):
    assert packing.best_fit(frames.empty(spark)).count() == 0
    r = packing.best_fit(frames.documents(spark, [(None, None, None)])).first()
    assert (r.doc_id, r.n_words, r.piece, r.bin_offset) == (None, 0, 0, 0)
    df = frames.documents(spark, [(i, f"w{i}", f"s{i}") for i in range(6)]).withColumn("cluster", F.lit(None).cast("int"))
    assert packing.best_fit(df).select("bin_id").distinct().count() == 1
    assert packing.best_fit(df.withColumn("cluster", F.lit(1))).select("bin_id").distinct().count() == 6
