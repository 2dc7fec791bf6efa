"""Ranked search, conversation repair and exact top-k search against plain versions."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import frames
import numpy as np
import pytest

from eventmart.llm import conversation_repair as repair
from eventmart.llm import lexical_search as lexical
from eventmart.llm import pivot_index as pivot

# ---- ranked search -----------------------------------------------------------------------------
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(frames.lower(text))


def ranked_by_brute_force(docs, items, k):
    """Counter of (item_id, rank, doc_id, score); ``docs`` of (doc_id, text), ``items`` of (item_id, text)."""
    bags = [(d, Counter(terms(t))) for d, t in docs]
    bags = [(d, b) for d, b in bags if b]
    n, words = len(bags), sum(b.total() for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = Counter()
    for item, text in set(items):
        scored = []
        for d, b in bags:
            m = 100 - 50 + (50 * b.total() * n) // words
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * b[t]) // (1000 * b[t] + 20 * m))
                for t in set(terms(text)) if b[t]
            )
            if score > 0:
                scored.append((-score, d is None, d or 0, d))
        for rank, (score, _, _, d) in enumerate(sorted(scored)[:k], 1):
            out[item, rank, d, -score] += 1
    return out


def items_of(rows):
    picked = [t for _, t, _ in rows if t and len(t) > 100]
    items = [(i, " ".join(t.split()[3 * i : 3 * i + 25])) for i, t in enumerate(picked)]
    items += [(50, items[0][1] + " " + items[1][1]), (51, items[0][1]), (51, items[0][1]), (51, "two Three UND"), (52, None), (53, "")]
    return items + [(54, "... !"), (None, "naïve 日本語"), (55, "nowhere")]


@pytest.mark.parametrize("block", [1 << 15, 40])
def test_lexical_search(spark, monkeypatch, block):
    monkeypatch.setattr(lexical, "BLOCK_TERMS", block)
    rows = frames.texts()
    items = items_of(rows)
    asked = spark.createDataFrame([(i, t, 1, "z") for i, t in items], "item_id long, text string, rank int, key string")
    got = lexical.search(frames.documents(spark, rows, clashing=True), asked, 7).collect()
    assert Counter(tuple(r) for r in got) == ranked_by_brute_force([(d, t) for d, t, _ in rows], items, 7)


def test_lexical_search_on_empty_tables(spark):
    docs, none = frames.documents(spark), spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "und one")], "item_id long, text string")
    assert lexical.search(docs, none).count() == 0
    assert lexical.search(frames.empty(spark), some).count() == 0
    assert lexical.search(frames.documents(spark, [(1, None, "s"), (2, "?", "s")]), some).count() == 0


def test_long_document_is_counted_whole(spark):
    rows = [(1, frames.prose(400_000, 3) + " needle", "s"), (2, "needle hay", "s"), (3, "hay", "s")]
    asked = spark.createDataFrame([(1, "NEEDLE hay")], "item_id long, text string")
    got = lexical.search(frames.documents(spark, rows), asked).collect()
    assert Counter(tuple(r) for r in got) == ranked_by_brute_force([(d, t) for d, t, _ in rows], [(1, "NEEDLE hay")], 50)


@pytest.mark.parametrize("seed", range(6))
def test_shared_sets_are_added_once(seed):
    rng = random.Random(seed)
    sets = [rng.sample(range(60), rng.randint(1, 20)) for _ in range(30)]
    sets += [sets[0] + [t for t in range(60) if t not in sets[0]], sets[0], [5]]
    graph = lexical.mine(sets, 60)
    values = np.random.default_rng(seed).integers(0, 10**9, (60, 5))
    assert (graph.evaluate(values) == np.array([values[s].sum(axis=0) for s in sets])).all()
    plain = sum(len(s) - 1 for s in sets)
    shared = len(graph.left) + len(graph.parts) - len(sets)
    assert shared < plain
    again = lexical.mine([list(range(40))] * 25, 40)  # a set that all queries have: one sum for all
    assert len(again.left) == 39 and len(again.parts) == 25


# ---- conversation repair -----------------------------------------------------------------------
def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        show = lambda x: " " if x is None else str(x)
        role, text = show(role), show(text)
        kind = zlib.crc32(f"{show(conv)}:{show(turn)}".encode()) % 20
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def repaired_by_brute_force(rows):
    """(gaps, blank, duplicate, truncated, illegal, cost, audit, hash) of one conversation: least over all ways, forwards."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
    turns = [r[1] for r in rows if r[1] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    faults, seen = [], set()
    for _, _, role, text in rows:
        body = re.findall(r"[^\x20\x09-\x0D]", text)
        faults.append("b" if not body else "d" if (role, text) in seen else "t" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    illegal = sum(x[2][:1] + y[2][:1] not in ("su", "ua", "au") for x, y in zip(rows, rows[1:]))
    after = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}
    said = {2: "user", 3: "assistant"}
    nxt = {0: 2, 1: 2, 2: 3, 3: 2}
    ways = {0: (0, "", ())}

    def better(to, q, way):
        if q not in to or way[:2] < to[q][:2]:
            to[q] = way
            return True

    def insert(ways):
        again = True
        while again:
            again = False
            for q, (c, a, t) in list(ways.items()):
                again = better(ways, nxt[q], (c + 2, a + "I", (*t, said[nxt[q]] + ":"))) or again

    for (_, _, role, text), fault in zip(rows, faults):
        insert(ways)
        new: dict = {}
        for q, (c, a, t) in ways.items():
            better(new, q, (c + 3, a + "D", t))
            if fault not in ("b", "d"):
                if (k := after.get((role[:1], q))) is not None:
                    better(new, k, (c + (fault == "t"), a + "K", (*t, f"{role}:{text}")))
                better(new, nxt[q], (c + 2 + (fault == "t"), a + "R", (*t, f"{said[nxt[q]]}:{text}")))
        ways = new
    insert(ways)
    cost, audit, turns = min(ways[q] for q in (0, 3) if q in ways)
    count = Counter(faults)
    return gaps, count["b"], count["d"], count["t"], illegal, cost, audit, hashlib.sha256("\n".join(turns).encode()).hexdigest()


def logs(seed, n=60):
    rng = random.Random(seed)
    roles = ["user", "assistant", "system", "tool", "", "u", "User", None]
    texts = ["Hello there.", "yes", "What?", "", " \t ", None, "naïve 日本語!", "ends. ", "a\nb.", "no"]
    rows = []
    for c in [None, *range(n)]:
        for t in range(rng.choice([1, 2, 4, 9, 30])):
            turn = rng.choice([t, t, t, t, None, max(0, t - 1), t + 3])
            role = ["user", "assistant"][t % 2] if rng.random() < 0.6 else rng.choice(roles)
            rows.append((c, turn, role, rng.choice(texts) if rng.random() < 0.5 else f"Text {rng.randint(0, 99)}."))
    return rows + rows[:7]


FIELDS = "gaps blank duplicate truncated illegal cost audit repaired_sha256".split()


@pytest.mark.parametrize("bits", [10, 2, 0])
def test_repair(spark, monkeypatch, bits):
    """Pieces of 1024, 4 and 1 rows give the same."""
    monkeypatch.setattr(repair, "BLOCK_BITS", bits)
    rows = logs(bits)
    df = spark.createDataFrame([(*r, "z", 1) for r in rows], "conv_id long, turn long, role string, text string, pos string, block int")
    got = repair.audit_damage(df.repartition(3)).collect()
    after = damaged(rows)
    want = {c: repaired_by_brute_force([r for r in after if r[0] == c]) for c in {r[0] for r in rows}}
    assert {r.conv_id: tuple(r[f] for f in FIELDS) for r in got} == want
    assert len(got) == len(want)


def test_repaired_turns(spark):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "assistant", "Yes."), (1, 2, "assistant", "Yes."), (2, 0, "user", "Hi?"), (3, 0, "tool", "")]
    stored = repair.ordered(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    solved = repair.solve(repair.materialize(repair.pieces(stored), "test-pieces"))
    got = [(r.conv, r.role, r.text) for r in repair.messages(stored, solved).orderBy("conv", "place").collect()]
    assert got == [("=1", "system", "Be kind."), ("=1", "user", ""), ("=1", "assistant", "Yes."), ("=2", "user", "Hi?"), ("=2", "assistant", "")]


def test_one_long_conversation_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(repair, "BLOCK_BITS", 5)
    rng = random.Random(4)
    rows = [(7, i, rng.choice(["user", "assistant", "assistant", "tool"]), rng.choice(["Fine.", f"{i}", f"{i}!"])) for i in range(3000)]
    rows += [(8, 1, "user", "x" * 3_000_000)]
    got = {r.conv_id: r for r in repair.repair(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    for c in (7, 8):
        assert tuple(got[c][f] for f in FIELDS) == repaired_by_brute_force([r for r in rows if r[0] == c])


def test_repair_of_an_empty_table(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert repair.audit_damage(none).count() == 0 and repair.repair(none).count() == 0


def test_prices_are_distances():
    """Converged prices of every layer against plain relaxation."""
    rng = random.Random(9)
    for _ in range(300):
        codes = "".join(f"{rng.randint(0, 15):x}" for _ in range(rng.randint(1, 12)))
        behind = tuple(rng.choice([None, 0, 1, 5, 20]) for _ in range(4))
        front, _ = repair.prices(codes, behind)
        want = list(behind)
        for c in reversed(codes):
            arcs = [(q, a) for q in range(4) for a in repair._arcs(int(c, 16), q, tuple(want), set(range(4)))]
            p = [None] * 4
            for _ in range(8):
                for q, (_, cost, within, head) in arcs:
                    v = p[head] if within else want[head]
                    if v is not None and (p[q] is None or v + cost < p[q]):
                        p[q] = v + cost
            want = p
        assert list(front) == want


# ---- exact top-k -------------------------------------------------------------------------------
def nearest_by_brute_force(rows, k, every):
    """Counter of (query_id, rank, vec_id, score)."""
    ok = [(i, [math.floor(64 * float(x)) for x in v]) for i, v in rows
          if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = Counter()
    for qid, q in ok:
        if qid is None or qid % every:
            continue
        scored = sorted((-sum(a * b for a, b in zip(q, v)), i is None, i or 0, i) for i, v in ok if i != qid)
        for rank, (s, _, _, i) in enumerate(scored[:k], 1):
            out[qid, rank, i, -s] += 1
    return out


def top_k(spark, rows, k, every):
    df = spark.createDataFrame([(i, v, 3, "z") for i, v in rows], "vec_id long, embedding array<float>, pivot int, shard string")
    vectors = pivot.lattice(df.repartition(3), "vec_id", "embedding")
    return pivot.search(pivot.build(vectors), vectors.where(f"vec_id % {every} = 0"), k)


@pytest.mark.parametrize("run", [512, 5])
def test_top_k(spark, monkeypatch, run):
    monkeypatch.setattr(pivot, "RUN", run)
    monkeypatch.setattr(pivot, "PIVOTS", 7)
    rng = np.random.default_rng(run)
    centres = rng.normal(0, 1, (5, 8))
    rows = [(i, (centres[i % 5] + rng.normal(0, 0.3, 8)).astype(np.float32).tolist()) for i in range(400)]
    same = rows[3][1]
    rows += [(1000 + i, same) for i in range(300)]  # one vector in a third of all rows, ties by id
    rows += [(2000, None), (2010, [None, *same[1:]]), (2020, [math.nan, *same[1:]]), (2030, [math.inf, *same[1:]])]
    rows += [(2040, same[:5]), (2050, []), (None, same), (None, rows[0][1]), (10, rows[10][1])]
    got = top_k(spark, rows, 20, 10)
    assert Counter(tuple(r) for r in got.collect()) == nearest_by_brute_force(rows, 20, 10)


def test_top_k_edges(spark):
    assert top_k(spark, [], 5, 1).count() == 0
    assert top_k(spark, [(0, [1.0, 2.0])], 5, 1).count() == 0
    few = [(0, [1.0, 2.0]), (1, [0.5, 0.25]), (2, [-1.0, 0.0])]
    assert Counter(tuple(r) for r in top_k(spark, few, 5, 1).collect()) == nearest_by_brute_force(few, 5, 1)
    large = [(i, [1e5 * (i + 1), -3e5 * i]) for i in range(6)]  # scores beyond 2**53
    assert Counter(tuple(r) for r in top_k(spark, large, 3, 2).collect()) == nearest_by_brute_force(large, 3, 2)


def test_annuli_are_left_unread():
    """With clustered vectors most annuli cannot hold anything better, and their ceilings say so."""
    rng = np.random.default_rng(1)
    v = np.concatenate([rng.integers(-20, 20, (200, 6)) + c for c in (0, 900, -900)])
    longest = float((v**2).sum(axis=1).max())
    added = np.sqrt(longest - (v.astype(float) ** 2).sum(axis=1))
    pivots = pivot._choose(v.astype(float), longest)[:3]
    d = pivot._distances(v, added, pivots)
    near = d.argmin(axis=1)
    bounds = [(p, d[near == p, p].min(), d[near == p, p].max()) for p in range(3)]
    q = v[200:201]
    up = pivot._ceiling(q, pivot._distances(q, np.zeros(1), pivots), *(np.array(x) for x in zip(*bounds)), longest)[0]
    scores = q @ v.T
    for (p, _, _), ceiling in zip(bounds, up):
        assert scores[0, near == p].max() <= ceiling
    assert (up < np.sort(scores[0])[-20]).sum() >= 1
