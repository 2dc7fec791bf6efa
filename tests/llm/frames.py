"""Small tables for the operator tests."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# names that operators might use inside
CLASHING = "part key hash n cls size unit spans bucket shard taken target block comp look id h start end score component row_id text_hash".split()


def prose(n: int, seed: int) -> str:
    rng = random.Random(seed)
    words = ["".join(rng.choices("aeioulnrst", k=rng.randint(2, 9))) for _ in range(n)]
    return " ".join(w + ("." if i % 11 == 10 else "") for i, w in enumerate(words))


def near(text: str, every: int, seed: int) -> str:
    """``text`` with one word in ``every`` replaced."""
    words = text.split(" ")
    rng = random.Random(seed)
    for i in range(rng.randint(0, every - 1), len(words), every):
        words[i] = f"x{rng.randint(0, 10**9)}"
    return " ".join(words)


def texts() -> list[tuple]:
    """(doc_id, text, source): copies, near copies, shared passages, edge cases, nulls, repeated rows."""
    a, b, c = prose(120, 1), prose(300, 2), prose(90, 3)
    passage = prose(30, 4)
    rows = [
        (1, a, "s1"), (2, b, "s2"), (3, a, "s1"), (4, near(b, 60, 5), "s2"), (5, c + " " + passage, None),
        (6, passage + " " + prose(80, 6), "s3"), (7, "", "s1"), (8, None, "s1"), (9, " \t\n ", "s2"),
        (10, "one two three", "s2"), (11, "One TWO three", "s2"), (12, "naïve café — 日本語 🙂 " + prose(70, 7), "é"),
        (13, "Und " * 400, "s1"), (14, "Und " * 300 + passage, "s1"), (15, prose(6000, 8), "s1"),
        (16, a + "\n" + c, "s3"), (2, b, "s2"), (17, prose(6000, 8)[:20000] + "!", None), (None, prose(60, 9), None),
        (None, prose(60, 9), "s1"), (18, "#### $$$$ %%%% " * 40, "s2"), (19, "a\x0bb\x0cc d  e", "s2"), (20, a.upper(), "s1"),
    ]
    rows += [(100 + i, near(b, 25 + i, i), "s1") for i in range(12)]
    rows += [(200 + i, a, "s1") for i in range(15)]
    return rows


def documents(spark, rows=None, clashing: bool = False):
    rows = texts() if rows is None else rows
    df = spark.createDataFrame([(i, t, None, s, None if t is None else len(t)) for i, t, s in rows], SCHEMA)
    if clashing:
        df = df.selectExpr("*", *(f"concat('z', doc_id) as {c}" for c in CLASHING))
    return df.repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def word_list(text: str | None) -> list[str]:
    import re

    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lower(text: str | None) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def shingle_set(text: str | None) -> frozenset:
    w = word_list(lower(text))
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def groups_by_brute_force(rows: list[tuple]) -> dict:
    """Position of a row -> smallest doc_id of its component, over all pairs."""
    sets = [shingle_set(t) for _, t, _ in rows]
    up = list(range(len(rows)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, x in enumerate(sets):
        for j, y in enumerate(sets[:i]):
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                up[top(i)] = top(j)
    low: dict = {}
    for i, (d, _, _) in enumerate(rows):
        if d is not None:
            low[top(i)] = min(low.get(top(i), d), d)
    return {i: low.get(top(i)) if sets[i] else rows[i][0] for i in range(len(rows))}
