"""Repair of conversation structure by an auction algorithm for shortest paths.

A repaired conversation has role initials ``(s?(ua)+)?``. Its rows and the state of that pattern span a lattice with
integer costs: an arc keeps, re-roles or deletes a row, or inserts an empty turn. A node's price never exceeds
the cost of an arc plus the price of its head. A path starts at a node and is extended along the arc of
least cost plus price while the price of its end equals that value; else the price is raised to it and the path contracts.
Where the path meets a converged node, all its prices are distances to the end. Nodes are brought in from the
last row backwards. Arcs without slack are then exposed by the prices, and the least letter of them is traced.

Rows are dealt by a global order into blocks, so a conversation of any length is worked on in pieces: a piece gives
the costs between its 4 entry and 4 exit states, these are combined per conversation, and each piece is then traced
with the prices behind it. Only the hash of a repaired conversation needs its rows one after another.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmart.session import materialize

BLOCK_BITS = 10  # 1024 rows of the global order in one piece, at most
SPACE = r"[\x20\x09-\x0D]"
# states: 0 nothing yet, 1 after the system turn, 2 after a user turn, 3 after an assistant turn
_AFTER = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}
_NEXT = (2, 2, 3, 2)  # state after an inserted or re-roled turn
_END = (0, 4, 2, 0)  # price of each state after the last row: turns inserted there
_ENDING = ("", "II", "I", "")
_INITIALS = "sua"  # and any other
_FINE, _TRUNCATED, _BLANK, _DUPLICATE = range(4)  # faults; a row's code is 4 * initial + fault


def damage(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text with faults put in by a checksum of conversation and turn; nulls read as one space."""
    as_text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(as_text("conv_id"), F.lit(":"), as_text("turn"))) % 20
    rows = conversations.select("conv_id", "turn", as_text("role").alias("role"), as_text("text").alias("text"), kind.alias("__kind"))
    text = F.when(F.col("__kind") == 1, "").when(F.col("__kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    rows = rows.where("__kind != 0").withColumn("__copy", F.explode(F.expr("sequence(1, if(__kind = 3, 2, 1))")))
    return rows.select("conv_id", "turn", F.when(F.col("__kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"))


# ---- the lattice of one piece ------------------------------------------------------------------
def _arcs(code: int, state: int, ahead: tuple, here: set) -> list[tuple[str, int, bool, int]]:
    """(letter, cost, within the layer, head) in order of the letters, to nodes that reach the end."""
    initial, fault = _INITIALS[code // 4 : code // 4 + 1], code % 4
    out = [("D", 3, False, state)] if ahead[state] is not None else []
    if _NEXT[state] in here:
        out.append(("I", 2, True, _NEXT[state]))
    if fault < _BLANK:
        kept = _AFTER.get((initial, state))
        if kept is not None and ahead[kept] is not None:
            out.append(("K", fault, False, kept))
        if ahead[_NEXT[state]] is not None:
            out.append(("R", 2 + fault, False, _NEXT[state]))
    return out


@lru_cache(maxsize=1 << 16)
def _layer(code: int, ahead: tuple) -> tuple[tuple, tuple]:
    """(prices of the 4 nodes before a row, tight arcs of each) given the converged prices behind it; None: no way."""
    here = {q for q in range(4) if _arcs(code, q, ahead, set())}
    while grown := {q for q in range(4) if q not in here and _NEXT[q] in here}:
        here |= grown
    arcs = {q: _arcs(code, q, ahead, here) for q in here}
    price = dict.fromkeys(here, min((p for p in ahead if p is not None), default=0))
    value = lambda arc: arc[1] + (price[arc[3]] if arc[2] else ahead[arc[3]])
    done: set[int] = set()
    for origin in sorted(here):
        path = [origin]
        while path[-1] not in done:
            q = path[-1]
            arc = min(arcs[q], key=value)  # the first of equal ones: the least letter
            if price[q] < value(arc):
                price[q] = value(arc)
                if len(path) > 1:
                    path.pop()
            elif arc[2]:
                path.append(arc[3])
            else:
                break
        done |= set(path)
    tight = tuple(next((a for a in arcs[q] if value(a) == price[q]), None) if q in here else None for q in range(4))
    return tuple(price.get(q) for q in range(4)), tight


def prices(codes: str, behind: tuple) -> tuple[tuple, list[tuple]]:
    """(prices before the first row, tight arcs of each layer) of a piece. Prices of a layer depend on
    differences only, so they are looked up relative to the least one."""
    layers = []
    for c in reversed(codes):
        base = min((p for p in behind if p is not None), default=0)
        front, tight = _layer(int(c, 16), tuple(None if p is None else p - base for p in behind))
        behind = tuple(None if p is None else p + base for p in front)
        layers.append(tight)
    return behind, layers[::-1]


def trace(layers: list[tuple], state: int) -> tuple[int, str]:
    """(exit state, letters) along the tight arcs of least letters."""
    letters = []
    for tight in layers:
        while True:
            letter, _, within, head = tight[state]
            letters.append(letter)
            state = head
            if not within:
                break
    return state, "".join(letters)


def _summary(codes: str) -> list[int | None]:
    """Costs from each entry to each exit state, row by row; None: no way."""
    out: list[int | None] = []
    columns = [prices(codes, tuple(0 if e == q else None for q in range(4)))[0] for e in range(4)]
    for q in range(4):
        out += [columns[e][q] for e in range(4)]
    return out


def _illegal(codes: str) -> int:
    initials = [_INITIALS[int(c, 16) // 4 : int(c, 16) // 4 + 1] for c in codes]
    return sum(x + y not in ("su", "ua", "au") for x, y in zip(initials, initials[1:]))


def _before(costs: list, behind: list) -> list:
    """Prices before a piece from its costs and the prices behind it."""
    return [min((costs[4 * q + e] + behind[e] for e in range(4) if costs[4 * q + e] is not None and behind[e] is not None), default=None) for q in range(4)]


# ---- Spark -------------------------------------------------------------------------------------
def ordered(rows: DataFrame) -> DataFrame:
    """A stored table: conv (the id as a text that is never null), conv_id, turn, role, text, pos.

    ``pos`` rises by (conversation, turn, role, text), nulls first. Ranges of that order are dealt out, so a long
    conversation lies in several of them; rows that are equal can be split too.
    """
    conv = F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit(""))
    known = rows.select(
        conv.alias("conv"), "conv_id", F.col("turn").cast("long").alias("turn"),
        *(F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")), F.monotonically_increasing_id().alias("tie"),
    )
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    head = F.substr(F.col("text"), F.lit(1), F.lit(64))  # rows are sampled by these keys; whole texts would be long
    by = ["conv", "turn", "role", "head", "tie"]
    dealt = known.withColumn("head", F.struct(head, F.xxhash64("text"))).repartitionByRange(parts, *by).sortWithinPartitions(*by)
    return materialize(dealt.drop("head", "tie").withColumn("pos", F.monotonically_increasing_id()), "repair-rows")


def pieces(rows: DataFrame) -> DataFrame:
    """(conv, block, codes): what the solver needs of the rows in each block, a hexadecimal digit a row."""
    first = rows.groupBy("conv", F.sha2(F.concat("role", F.lit("\0"), "text"), 256).alias("what")).agg(F.min("pos").alias("first"))
    initial = F.instr(F.lit(_INITIALS), F.substr(F.col("role"), F.lit(1), F.lit(1)))
    last = F.regexp_extract("text", rf"([^\x20\x09-\x0D]){SPACE}*\z", 1)
    slim = rows.select(
        "conv", "pos", F.when((F.col("role") == "") | (initial == 0), 3).otherwise(initial - 1).alias("initial"),
        F.when(last == "", _BLANK).when(last.isin(".", "!", "?"), _FINE).otherwise(_TRUNCATED).alias("fault"),
    )
    # positions are unique, so this join has no hot key however often a row repeats
    marked = slim.join(first.select(F.col("first").alias("pos"), F.lit(True).alias("new")), "pos", "left")
    fault = F.when(F.col("new").isNull() & (F.col("fault") != _BLANK), _DUPLICATE).otherwise(F.col("fault"))
    coded = marked.select("conv", "pos", F.shiftright("pos", BLOCK_BITS).alias("block"), F.lower(F.hex(4 * F.col("initial") + fault)).alias("code"))
    codes = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "code"))), lambda x: x.code), "")
    return coded.groupBy("conv", "block").agg(codes.alias("codes"))


def solve(found: DataFrame) -> DataFrame:
    """(conv, blank, duplicate, truncated, illegal, cost, audit) from stored :func:`pieces`.

    A task holds a few numbers for each piece of a conversation, and its letters.
    """

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column(2).to_pylist()
            faults = [[sum(int(c, 16) % 4 == f for c in r) for f in range(4)] for r in rows]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([_summary(r) for r in rows], pa.list_(pa.int64())),
                 pa.array([[f[_BLANK], f[_DUPLICATE], f[_TRUNCATED], _illegal(r)] for f, r in zip(faults, rows)], pa.list_(pa.int64())),
                 pa.array([r[0] + r[-1] for r in rows])], names=["conv", "block", "costs", "counts", "ends"])

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for conv, some in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                joints = sum(_illegal(x["ends"][1] + y["ends"][0]) for x, y in zip(some, some[1:]))
                counts = [sum(x["counts"][i] for x in some) for i in range(4)]
                behind: list = list(_END)
                rows = []
                for x in reversed(some):
                    rows.append((conv, x["block"], behind))
                    behind = _before(x["costs"], behind)
                facts = [*counts[:3], counts[3] + joints, behind[0]]
                out += [(*r, facts) for r in rows]
            cols = list(zip(*out)) or [(), (), (), ()]
            types = pa.string(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=["conv", "block", "behind", "facts"])

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ways = []
            for codes, behind in zip(batch.column("codes").to_pylist(), batch.column("behind").to_pylist()):
                front, layers = prices(codes, tuple(behind))
                ways.append([None if front[q] is None else dict(zip(("exit", "letters"), trace(layers, q))) for q in range(4)])
            kind = pa.list_(pa.struct([("exit", pa.int32()), ("letters", pa.string())]))
            cols = [batch.column("conv"), batch.column("block"), batch.column("facts"), pa.array(ways, kind)]
            yield pa.RecordBatch.from_arrays(cols, names=["conv", "block", "facts", "ways"])

    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            audits = []
            for some in batch.column(2).to_pylist():
                state, letters = 0, []
                for x in some:
                    way = x["ways"][state]
                    letters.append(way["letters"])
                    state = way["exit"]
                audits.append("".join(letters) + _ENDING[state])
            facts = [pa.array([f[i] for f in batch.column(1).to_pylist()], pa.int64()) for i in range(5)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *facts, pa.array(audits, pa.string())], names=names)

    names = ["conv", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
    measured = found.mapInArrow(measure, "conv string, block long, costs array<long>, counts array<long>, ends string")
    whole = measured.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("block", "costs", "counts", "ends"))).alias("pieces"))
    behind = whole.mapInArrow(combine, "conv string, block long, behind array<long>, facts array<long>")
    traced = found.join(behind, ["conv", "block"]).select("conv", "block", "codes", "behind", "facts").mapInArrow(
        walk, "conv string, block long, facts array<long>, ways array<struct<exit: int, letters: string>>"
    )
    ways = traced.groupBy("conv").agg(F.first("facts").alias("facts"), F.array_sort(F.collect_list(F.struct("block", "ways"))).alias("pieces"))
    return ways.mapInArrow(follow, "conv string, blank long, duplicate long, truncated long, illegal long, cost long, audit string")


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(conv, role, text) of repaired turns, in order, and (conv, None, None) after each conversation.

    Input rows: conv, pos, role, text, audit; the audit comes first, then the rows by pos. One row is held at a time."""
    conv, audit, at, state = None, "", 0, 0

    def turn() -> tuple[str, int]:
        return ("assistant" if state == 2 else "user"), _NEXT[state]

    for batch in batches:
        for c, _, role, text, letters in zip(*(x.to_pylist() for x in batch.columns)):
            if letters is not None:
                if conv is not None:
                    while at < len(audit):
                        role_, state = turn()
                        at += 1
                        yield conv, role_, ""
                    yield conv, None, None
                conv, audit, at, state = c, letters, 0, 0
                continue
            while audit[at] == "I":
                role_, state = turn()
                at += 1
                yield conv, role_, ""
            letter, at = audit[at], at + 1
            if letter == "K":
                state = _AFTER[role[:1], state]
                yield conv, role, text
            elif letter == "R":
                role_, state = turn()
                yield conv, role_, text
    if conv is not None:
        while at < len(audit):
            role_, state = turn()
            at += 1
            yield conv, role_, ""
        yield conv, None, None


def _with_audits(rows: DataFrame, solved: DataFrame) -> DataFrame:
    """Each conversation's audit and then its rows, in one partition and in order."""
    none = F.lit(None).cast("string")
    audits = solved.select("conv", F.lit(-1).cast("long").alias("pos"), none.alias("role"), none.alias("text"), "audit")
    every = rows.select("conv", "pos", "role", "text", none.alias("audit")).unionByName(audits)
    return every.repartition("conv").sortWithinPartitions("conv", "pos")


def messages(rows: DataFrame, solved: DataFrame) -> DataFrame:
    """The repaired turns: conv, place, role, text. ``rows`` from :func:`ordered`, ``solved`` from :func:`solve`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, place = [], 0
        for conv, role, text in _apply(batches):
            if role is None:
                place = 0
                continue
            held.append((conv, place, role, text))
            place += 1
            if len(held) == 256:
                yield _message_rows(held)
                held = []
        if held:
            yield _message_rows(held)

    return _with_audits(rows, solved).mapInArrow(run, "conv string, place long, role string, text string")


def _message_rows(held: list[tuple]) -> pa.RecordBatch:
    types = pa.string(), pa.int64(), pa.string(), pa.string()
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names=["conv", "place", "role", "text"])


def _hashes(rows: DataFrame, solved: DataFrame) -> DataFrame:
    """(conv, repaired_sha256) of the repaired turns as ``role:text`` lines. A hash takes its bytes in order, so each
    conversation streams through one task, a row at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, sha, lead = [], hashlib.sha256(), ""
        for conv, role, text in _apply(batches):
            if role is not None:
                sha.update(f"{lead}{role}:{text}".encode("utf-8", "surrogatepass"))
                lead = "\n"
                continue
            held.append((conv, sha.hexdigest()))
            sha, lead = hashlib.sha256(), ""
            if len(held) == 4096:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*held)], names=["conv", "repaired_sha256"])
                held = []
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*held)], names=["conv", "repaired_sha256"])

    return _with_audits(rows, solved).mapInArrow(run, "conv string, repaired_sha256 string")


def repair(rows: DataFrame) -> DataFrame:
    """Per conversation of ``rows`` (conv_id, turn, role, text): conv_id, gaps, blank, duplicate, truncated, illegal, cost,
    audit, repaired_sha256.

    Turns go by (turn, role, text), nulls first; null roles and texts are one space; rows with one turn, and rows
    repeated, are rows each (the later one a duplicate); a null id is one conversation; roles are told by their first
    letter; other columns are ignored; an empty table gives an empty result.
    """
    stored = ordered(rows)
    solved = materialize(solve(materialize(pieces(stored), "repair-pieces")), "repair-solved")
    turns = stored.groupBy("conv", "conv_id", "turn").agg(F.count("*").alias("n"))
    gaps = turns.groupBy("conv", "conv_id").agg(F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).alias("gaps"))
    return gaps.join(solved, "conv").join(_hashes(stored, solved), "conv").drop("conv")


def audit_damage(conversations: DataFrame) -> DataFrame:
    """:func:`repair` of the damaged conversations, with a row for each original conv_id. One without rows after the
    damage has zeros, an empty audit and the hash of an empty text."""
    ids = conversations.select(F.col("conv_id").alias("__id")).distinct()
    found = repair(damage(conversations))
    joined = ids.join(found, F.col("__id").eqNullSafe(F.col("conv_id")), "left")
    zeros = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return joined.select(
        F.col("__id").alias("conv_id"), *zeros, F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )
