"""DuckDB SQL for the queries that SQL can express."""

from eventmart.llm.pii import IBAN_LENGTHS

_ESC = r"regexp_replace({}, '([<\[\\])', '\1\\', 'g')"

CHAT = rf"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn NULLS FIRST, role, text), '')) AS loss_sha256,
  CAST(sum(length({_ESC.format('role')}) + length({_ESC.format('text')}) + length('<|turn|><|text|><|end|>') + 1) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id
"""

_PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
    "card": r"[0-9](?:[\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": "[A-Z]{2}[0-9]{2}",  # the start of one
    "ssn": r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
}
_DIGITS = "regexp_replace(hit, '[^0-9]', '', 'g')"
_ALONE = "NOT regexp_matches(before, '[A-Za-z0-9-]$') AND NOT regexp_matches(after, '^[A-Za-z0-9-]')"
_IBAN = "replace(hit, ' ', '')"
_VALID = {
    "email": "true",
    "ip": "list_bool_and(list_transform(string_split(hit, '.'), lambda p: CAST(p AS HUGEINT) <= 255))",
    "card": f"length({_DIGITS}) BETWEEN 12 AND 19 AND list_sum(list_transform(string_split(reverse({_DIGITS}), ''), "
    "lambda c, i: CASE WHEN i % 2 = 1 THEN CAST(c AS INT) WHEN CAST(c AS INT) > 4 THEN 2 * CAST(c AS INT) - 9 "
    "ELSE 2 * CAST(c AS INT) END)) % 10 = 0",
    "phone": f"length({_DIGITS}) BETWEEN 9 AND 15",
    "iban": f"length({_IBAN}) BETWEEN 15 AND 34 AND {_ALONE} AND list_reduce(list_transform(string_split("
    f"substr({_IBAN}, 5) || substr({_IBAN}, 1, 4), ''), lambda c: CASE WHEN c BETWEEN '0' AND '9' THEN CAST(c AS BIGINT) "
    "ELSE ascii(c) - 55 END), lambda a, c: (CASE WHEN c < 10 THEN a * 10 ELSE a * 100 END + c) % 97) = 1",
    "ssn": f"{_ALONE} AND NOT regexp_matches(substr(hit, 1, 3), '000|666|9..') AND substr(hit, 5, 2) <> '00' "
    "AND substr(hit, 8) <> '0000' AND regexp_matches(lower(before), 'ssn|social|security|tax')",
}


# An IBAN from its start: as long as its country has it; with other codes as long as it goes on.
_IBAN_HIT = "CASE {} ELSE regexp_extract(ahead, '^[A-Z]{{2}}[0-9]{{2}}(?: ?[A-Z0-9]){{11,30}}') END".format(
    " ".join(
        f"WHEN ahead[1:2] IN ({', '.join(repr(c) for c in codes.split())}) THEN regexp_extract(ahead, '^[A-Z]{{2}}[0-9]{{2}}(?: ?[A-Z0-9]){{{n - 4}}}')"
        for n, codes in IBAN_LENGTHS.items()
    )
)


def _starts(name: str) -> str:
    """(doc_id, row_id, text, hit, start) of all matches."""
    pattern = _PATTERNS[name]
    return f"""
      SELECT doc_id, row_id, text, hits[i] AS hit,
        CAST(list_sum(list_transform(pieces[1:i], lambda p: length(p))) + coalesce(list_sum(list_transform(hits[1:i - 1], lambda p: length(p))), 0) AS BIGINT) AS start
      FROM (
        SELECT doc_id, row_id, text, hits, pieces, unnest(range(1, len(hits) + 1)) AS i
        FROM (SELECT doc_id, row_id, text, regexp_extract_all(text, '{pattern}') AS hits, regexp_split_to_array(text, '{pattern}') AS pieces FROM docs)
      )"""


def _kind(i: int, name: str) -> str:
    found = _starts(name)
    if name == "iban":
        found = f"SELECT * REPLACE ({_IBAN_HIT} AS hit) FROM (SELECT *, substr(text, start + 1, 64) AS ahead FROM ({found}))"
    valid = f"""
  SELECT * FROM (
    SELECT doc_id, row_id, {i} AS rank, '{name}' AS kind, start, start + length(hit) AS stop, hit,
      substr(text, greatest(start - 40, 0) + 1, least(start, 40)) AS before, substr(text, start + length(hit) + 1, 1) AS after
    FROM ({found}
    )
  ) WHERE {_VALID[name]}"""
    if name != "iban":
        return valid
    # starts are found within hits too: of those that overlap the first one stays
    return f"""
  SELECT doc_id, row_id, {i} AS rank, '{name}' AS kind, s.start, s.stop, '' AS hit, '' AS before, '' AS after FROM (
    SELECT any_value(doc_id) AS doc_id, row_id, unnest(list_reduce(list(x ORDER BY start),
      lambda a, b: CASE WHEN b[1].start < a[-1].stop THEN a ELSE list_concat(a, b) END)) AS s
    FROM (SELECT *, [{{'start': start, 'stop': stop}}] AS x FROM ({valid}))
    GROUP BY row_id
  )"""


PII = f"""
WITH docs AS (SELECT doc_id, row_number() OVER () AS row_id, coalesce(text, '') AS text FROM documents),
found AS ({' UNION ALL '.join(_kind(i, k) for i, k in enumerate(_PATTERNS))})
SELECT d.doc_id,
  count(*) FILTER (kind = 'email') AS n_email, count(*) FILTER (kind = 'ip') AS n_ip,
  count(*) FILTER (kind = 'card') AS n_card, count(*) FILTER (kind = 'phone') AS n_phone,
  sha256(coalesce(string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) FILTER (rank < 4), '')) AS base_sha256,
  coalesce(string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) FILTER (kind IS NOT NULL), '') AS spans
FROM docs d LEFT JOIN found f ON f.row_id = d.row_id
GROUP BY d.row_id, d.doc_id
"""

JACCARD = r"""
WITH RECURSIVE words AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
),
grams AS MATERIALIZED (
  SELECT doc_id, hash(g) AS g FROM (
    SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g
    FROM words
  )
),
sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
links AS MATERIALIZED (
  SELECT x.a, x.b FROM (
    SELECT p.doc_id AS a, q.doc_id AS b, count(*) AS shared FROM grams p JOIN grams q ON p.g = q.g AND p.doc_id <> q.doc_id GROUP BY 1, 2
  ) x JOIN sizes s ON s.doc_id = x.a JOIN sizes t ON t.doc_id = x.b
  WHERE 100 * shared >= 75 * (s.n + t.n - shared)
),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM sizes
  UNION
  SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other
),
low AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT w.doc_id, coalesce(s.n, 0) AS n_shingles, coalesce(l.component_id, w.doc_id) AS component_id
FROM words w LEFT JOIN sizes s USING (doc_id) LEFT JOIN low l USING (doc_id)
"""

REPEATS = """
WITH docs AS MATERIALIZED (SELECT doc_id, encode(coalesce(text, '')) AS b FROM documents),
strings AS MATERIALIZED (
  SELECT doc_id, i, hash(substr(h, 2 * i + 1, 100)) AS s
  FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - 49)) AS i FROM (SELECT doc_id, hex(b) AS h FROM docs))
),
owners AS (SELECT s, min(doc_id) AS owner FROM strings GROUP BY s),
hits AS MATERIALIZED (SELECT t.doc_id, t.i FROM strings t JOIN owners o USING (s) WHERE o.owner < t.doc_id),
marked AS (SELECT doc_id, i, CASE WHEN i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) <= 50 THEN 0 ELSE 1 END AS new FROM hits),
grouped AS (SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS g FROM marked),
spans AS (SELECT doc_id, g, min(i) AS a, max(i) + 50 AS z FROM grouped GROUP BY doc_id, g),
kept AS (
  SELECT s.doc_id, sum(z - a) AS n_removed, count(*) AS n_spans,
    string_agg(substr(hex(d.b), 2 * p + 1, 2 * (a - p)), '' ORDER BY a) || substr(any_value(hex(d.b)), 2 * max(z) + 1) AS h
  FROM (SELECT *, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY a), 0) AS p FROM spans) s JOIN docs d USING (doc_id)
  GROUP BY s.doc_id
)
SELECT d.doc_id, octet_length(d.b) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(coalesce(unhex(k.h), d.b)) AS kept_sha256
FROM docs d LEFT JOIN kept k USING (doc_id)
"""

LEXICAL = r"""
WITH terms AS MATERIALIZED (
  SELECT doc, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t
  FROM (SELECT row_number() OVER () AS doc, doc_id, text FROM documents)
),
wanted AS MATERIALIZED (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t
  FROM benchmark
),
lengths AS MATERIALIZED (SELECT doc, any_value(doc_id) AS doc_id, count(*) AS n FROM terms GROUP BY doc),
corpus AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS words FROM lengths),
hits AS MATERIALIZED (SELECT doc, t, count(*) AS tf FROM terms WHERE t IN (SELECT t FROM wanted) GROUP BY doc, t),
weights AS (
  SELECT t, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) AS w
  FROM (SELECT t, count(*) AS df FROM hits GROUP BY t), corpus
),
scored AS (
  SELECT item_id, h.doc, any_value(l.doc_id) AS doc_id,
    CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * docs) // words)))) AS BIGINT) AS score
  FROM wanted JOIN hits h USING (t) JOIN weights USING (t) JOIN lengths l ON l.doc = h.doc, corpus
  GROUP BY item_id, h.doc
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0
) WHERE rank <= 50
"""

NEAREST = """
WITH v AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 20 = 0
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored
) WHERE rank <= 20
"""

# CRC-32 (reflected polynomial EDB88320) of a string of digits, colons, signs and spaces, bit by bit
_CRC = (
    "xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], list_transform(string_split({0}, ''), lambda c: CAST(ascii(c) AS BIGINT))), "
    "lambda crc, b: list_reduce(list_concat([xor(crc, b)], [CAST(0 AS BIGINT) FOR i IN range(8)]), "
    "lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295)"
)


def _least(*ways: str) -> str:
    """The cheapest of some structs (cost, audit, repaired), equal costs by audit; nulls are no way."""
    return f"list_min(list_filter([{', '.join(ways)}], lambda s: s IS NOT NULL))"


def _step(way: str, cost: str, letter: str, line: str) -> str:
    return (
        f"CASE WHEN {way} IS NOT NULL THEN {{'cost': {way}.cost + {cost}, 'audit': {way}.audit || '{letter}', "
        f"'repaired': {way}.repaired || {line}}} END"
    )


_LINE = {"I2": "'user:' || chr(10)", "I3": "'assistant:' || chr(10)", "R2": "'user:' || text || chr(10)", "R3": "'assistant:' || text || chr(10)"}


def _inserted(to: int, froms: dict[str, str]) -> str:
    return ", ".join(_step(w, "2", "I", _LINE[f"I{to}"]) for w in froms.values())


def _taken(state: int) -> str:
    """State ``state`` after a row, from the states w0 to w3 before it."""
    ways = [_step(f"w{state}", "3", "D", "''")]
    keep = "CASE WHEN NOT gone AND initial = '{}' THEN {} END"
    again = "CASE WHEN NOT gone THEN {} END"
    sources = {1: ("s", (0,)), 2: ("u", (0, 1, 3)), 3: ("a", (2,))}
    if state in sources:
        initial, froms = sources[state]
        for q in froms:
            ways.append(keep.format(initial, _step(f"w{q}", "cut", "K", "role || ':' || text || chr(10)")))
            if state > 1:
                ways.append(again.format(_step(f"w{q}", "(2 + cut)", "R", _LINE[f"R{state}"])))
    return _least(*ways)


def _with_inserts(rows: str, prefix: str = "q", to: str = "w") -> str:
    """States ``to``0..3 from ``prefix``0..3 of ``rows`` with up to three inserted turns before the next row."""
    return f"""SELECT * EXCLUDE (a2, a3, b2), {prefix}0 AS {to}0, {prefix}1 AS {to}1, {_least('a2', 'b2')} AS {to}2, a3 AS {to}3 FROM (
      SELECT *, {_least('a2', _step('a3', '2', 'I', _LINE['I2']))} AS b2 FROM (
        SELECT *, {_least(f'{prefix}3', _step('a2', '2', 'I', _LINE['I3']))} AS a3 FROM (
          SELECT *, {_least(f'{prefix}2', *(_step(f'{prefix}{q}', '2', 'I', _LINE['I2']) for q in (0, 1, 3)))} AS a2 FROM ({rows}))))"""


_START = "CAST({'cost': 0, 'audit': '', 'repaired': ''} AS STRUCT(cost BIGINT, audit VARCHAR, repaired VARCHAR))"
_NOWAY = "CAST(NULL AS STRUCT(cost BIGINT, audit VARCHAR, repaired VARCHAR))"

REPAIR = rf"""
WITH RECURSIVE source AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {_CRC.format("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS kind
  FROM conversations
),
damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy
  FROM source WHERE kind <> 0
),
placed AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i FROM damaged),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS seen,
    regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS last
  FROM placed
),
faulty AS MATERIALIZED (
  SELECT conv_id, turn, role, text, i, role[1] AS initial, last = '' AS blank, last <> '' AND seen AS duplicate,
    last <> '' AND NOT seen AND last NOT IN ('.', '!', '?') AS truncated,
    last = '' OR seen AS gone, CASE WHEN last <> '' AND NOT seen AND last NOT IN ('.', '!', '?') THEN 1 ELSE 0 END AS cut,
    lag(role[1]) OVER (PARTITION BY conv_id ORDER BY i) AS previous
  FROM numbered
),
facts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
    count(*) FILTER (duplicate) AS duplicate, count(*) FILTER (truncated) AS truncated,
    count(*) FILTER (previous IS NOT NULL AND previous || initial NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n
  FROM faulty GROUP BY conv_id
),
walk AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS i, {_START} AS q0, {_NOWAY} AS q1, {_NOWAY} AS q2, {_NOWAY} AS q3 FROM facts
  UNION ALL
  SELECT conv_id, i, {_taken(0)} AS q0, {_taken(1)} AS q1, {_taken(2)} AS q2, {_taken(3)} AS q3 FROM (
    {_with_inserts('SELECT w.q0, w.q1, w.q2, w.q3, f.* FROM walk w JOIN faulty f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.i = w.i + 1')}
  )
),
best AS (
  SELECT conv_id, {_least('w0', 'w3')} AS s FROM (
    {_with_inserts('SELECT w.* FROM walk w JOIN facts f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.n = w.i')}
  )
)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(s.cost, 0) AS cost, coalesce(s.audit, '') AS audit,
  sha256(CASE WHEN s.repaired <> '' THEN s.repaired[:-2] ELSE '' END) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN facts f ON f.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN best b ON b.conv_id IS NOT DISTINCT FROM c.conv_id
"""
