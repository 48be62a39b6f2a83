"""SQL counterparts of those text queries that SQL can express: shingle links, spans and phrases. They take none of the operators' ways but their fixed values and rules."""

from __future__ import annotations

from satellion.llm.licenses import PHRASES, rules

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


OP2 = f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM d),
e AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM s),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, a.n AS m, b.n AS n, count(*) AS common FROM e a JOIN e b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM shared WHERE 100 * common >= 75 * (m + n - common)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT a, b FROM edges UNION SELECT r.a, e.b FROM reach r JOIN edges e ON r.b = e.a),
low AS (SELECT a, min(b) AS b FROM reach GROUP BY a),
degree AS (SELECT a, count(*) AS n FROM edges GROUP BY a)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, least(s.doc_id, coalesce(low.b, s.doc_id)) AS component_id, CAST(coalesce(degree.n, 0) AS BIGINT) AS n_links
FROM s LEFT JOIN low ON s.doc_id = low.a LEFT JOIN degree ON s.doc_id = degree.a
"""


def _spans(kind: str, ord_: int, pattern: str, keep: str = "true", group: int = 0, text: str = "t") -> str:
    """Rows (doc_id, kind, ord, s, e, v) of a pattern's matches: running sums over what stands between them and over themselves. A group ends where its match ends."""
    p = _quoted(pattern)
    return f"""SELECT doc_id, '{kind}' AS kind, {ord_} AS ord, e - length(v) AS s, e, v FROM (
  SELECT doc_id, v, sum(length(g) + length(m)) OVER (PARTITION BY doc_id ORDER BY k) AS e FROM (
    SELECT doc_id, unnest(regexp_extract_all({text}, {p}, {group})) AS v, unnest(regexp_extract_all({text}, {p})) AS m, unnest(string_split_regex({text}, {p})) AS g, unnest(range(1 + len(regexp_extract_all({text}, {p})))) AS k FROM d WHERE regexp_matches({text}, {p})
  ) WHERE m IS NOT NULL
) WHERE {keep}"""


def _listed(kinds: tuple[str, ...], order: str) -> str:
    """Counts, digest and list from the relation x(doc_id, kind, ord, s, e) of spans."""
    counts = ", ".join(f"CAST(count(*) FILTER (kind = '{k}') AS BIGINT) AS n_{k}" for k in kinds)
    item = "kind || ':' || CAST(s AS BIGINT) || ':' || CAST(e AS BIGINT)"
    base = "kind IN (" + ", ".join(map(_quoted, kinds)) + ")"
    return f"""SELECT d.doc_id, {counts}, sha256(coalesce(string_agg({item}, ',' ORDER BY {order}) FILTER ({base}), '')) AS base_sha256, coalesce(string_agg({item}, ',' ORDER BY {order}), '') AS spans
FROM d LEFT JOIN x ON d.doc_id = x.doc_id GROUP BY d.doc_id"""


_DIGITS = "regexp_replace(v, '[^0-9]', '', 'g')"
_LUHN = f"list_sum(list_transform(range(1, 1 + length({_DIGITS})), lambda i: CASE WHEN i % 2 = 1 THEN CAST(substr(reverse({_DIGITS}), i, 1) AS INT) ELSE CAST(substr(reverse({_DIGITS}), i, 1) AS INT) * 2 % 10 + CAST(substr(reverse({_DIGITS}), i, 1) AS INT) * 2 // 10 END)) % 10 = 0"
#: An account number's letters as numbers from 10 on, its first four symbols last, taken modulo 97 symbol by symbol.
_MOVED = "substr(replace(v, ' ', ''), 5) || substr(replace(v, ' ', ''), 1, 4)"
_MOD97 = f"list_reduce(list_transform(string_split({_MOVED}, ''), lambda c: CAST(CASE WHEN c BETWEEN '0' AND '9' THEN ascii(c) - 48 ELSE ascii(c) - 55 END AS BIGINT)), lambda a, b: (a * CASE WHEN b < 10 THEN 10 ELSE 100 END + b) % 97, CAST(0 AS BIGINT)) = 1"
#: The account pattern needs a symbol other than letters and digits on both sides. These are doubled (text u), so two neighbours can each have one; _single gives places back.
_ACCOUNT = r"(?:^|[^A-Za-z0-9])([A-Z]{2}[0-9]{2}(?:(?:\x20\x20)?[A-Z0-9]){11,30})(?:$|[^A-Za-z0-9])"

OP4 = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_replace(coalesce(text, ''), '([^A-Za-z0-9])', '\\1\\1', 'g') AS u FROM documents),
words AS ({_spans("word", 0, "(?i)ssn|social|security|national|passport|identity")}),
ids AS ({_spans("id", 5, "[0-9-]+", "regexp_full_match(v, '[0-9]{3}-[0-9]{2}-[0-9]{4}')")}),
halves AS (SELECT doc_id, k, length(regexp_replace(g, '([^A-Za-z0-9])[^A-Za-z0-9]', '\\1', 'g')) AS before, m, v FROM (
  SELECT doc_id, unnest(regexp_extract_all(u, '{_ACCOUNT}', 1)) AS v, unnest(regexp_extract_all(u, '{_ACCOUNT}')) AS m, unnest(range(1, 1 + len(regexp_extract_all(u, '{_ACCOUNT}')))) AS k, u FROM d WHERE regexp_matches(u, '{_ACCOUNT}')
), LATERAL (SELECT array_to_string(list_transform(range(1, k + 1), lambda i: string_split_regex(u, '{_ACCOUNT}')[i] || CASE WHEN i < k THEN regexp_extract_all(u, '{_ACCOUNT}')[i] ELSE CASE WHEN regexp_matches(m, '^[^A-Za-z0-9]') THEN substr(m, 1, 1) ELSE '' END END), '') AS g)),
accounts AS (SELECT doc_id, 'iban' AS kind, 4 AS ord, before AS s, before + length(w) AS e, w AS v FROM (SELECT doc_id, before, replace(v, '  ', ' ') AS w FROM halves) WHERE {_MOD97.replace("(v,", "(w,")}),
x AS (
{_spans("email", 0, r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")}
UNION ALL {_spans("ip", 1, r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "coalesce(list_max(list_transform(string_split(v, '.'), lambda p: coalesce(try_cast(p AS HUGEINT), 999))) <= 255, false)")}
UNION ALL {_spans("card", 2, r"[0-9]([\x20-]?[0-9])+", f"length({_DIGITS}) BETWEEN 16 AND 19 AND {_LUHN}")}
UNION ALL {_spans("phone", 3, r"\+[0-9][\x20().0-9-]+[0-9]", f"length({_DIGITS}) BETWEEN 8 AND 15")}
UNION ALL SELECT * FROM accounts
UNION ALL SELECT * FROM ids WHERE EXISTS (SELECT 1 FROM words WHERE words.doc_id = ids.doc_id AND words.s >= ids.s - 40 AND words.e <= ids.e + 40))
{_listed(("email", "ip", "card", "phone"), "ord, s, e")}
"""

_ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+"""
OP9 = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
y AS (
{_spans("assign", 0, _ASSIGN, "length(regexp_extract(v, '(?s)^[A-Za-z_]+[\"'']?\\x20*[:=]\\x20*[\"'']?(.*)$', 1)) >= 8")}
UNION ALL {_spans("access", 1, "AKIA[A-Z0-9]+", "length(v) >= 16")}
UNION ALL {_spans("hex", 2, "[0-9a-f]+", "length(v) >= 32")}
UNION ALL {_spans("weak_id", 3, r"(?:^|[^A-Za-z0-9_])((?:ASIA|AROA|AIza|ghp_|xox[bap]-|sk_live_|SK)[A-Za-z0-9_-]{12,})", group=1)}
UNION ALL {_spans("weak_secret", 4, "[A-Za-z0-9/+]+=?", "length(v) = 40 AND v NOT LIKE '%=' AND regexp_matches(v, '[0-9]') AND regexp_matches(v, '[A-Z]') AND regexp_matches(v, '[a-z]')")}
UNION ALL {_spans("weak_endpoint", 5, r'''(?:https?|wss?|amqps?|postgres(?:ql)?|mysql|redis|mongodb)://[^\x00-\x20"'<>]+''')}),
x AS (SELECT * FROM y WHERE ord < 3 OR (
  EXISTS (SELECT 1 FROM y o WHERE o.doc_id = y.doc_id AND ((o.s >= y.e AND o.s - y.e <= 300) OR (y.s >= o.e AND y.s - o.e <= 300))
    AND CASE WHEN y.kind = 'weak_secret' THEN o.kind IN ('access', 'weak_id', 'weak_endpoint') ELSE o.kind IN ('assign', 'weak_secret', 'hex') END)
  AND NOT EXISTS (SELECT 1 FROM y b WHERE b.doc_id = y.doc_id AND b.ord < 3 AND b.s <= y.s AND b.e >= y.e)))
{_listed(("assign", "access", "hex"), "s, ord, e")}
"""


def _rule(i: int, priority: int, label: str, key: str, pattern: str) -> str:
    """Detections of one rule. Blanks between words are doubled, so neighbours have one each."""
    wide = " " + pattern.replace(" ", "(?:  )") + " "
    return f"SELECT doc_id, {i} AS i, {priority} AS p, {_quoted(label)} AS label, s, e FROM ({_spans('rule', 0, wide)}) WHERE true".replace("FROM d WHERE", f"FROM d WHERE contains(t, {_quoted(' ' + key.replace(' ', '  '))}) AND")


def op10() -> str:
    phrases = " UNION ALL ".join(
        f"SELECT doc_id, {_quoted(k)} AS label, i - 1 AS place FROM (SELECT doc_id, w, unnest(range(1, len(w) - {len(p.split()) - 2})) AS i FROM a) WHERE w[i:i + {len(p.split()) - 1}] = {p.split()!r}" for k, p in PHRASES.items()
    )
    return f"""
WITH a AS MATERIALIZED (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
d AS MATERIALIZED (SELECT doc_id, '  ' || array_to_string(w, '  ') || '  ' AS t FROM a),
base AS MATERIALIZED ({phrases}),
found AS MATERIALIZED ({" UNION ALL ".join(_rule(i, p, label, key, rx) for i, (p, label, key, rx) in enumerate(rules()))}),
kept AS (SELECT * FROM found f WHERE NOT EXISTS (SELECT 1 FROM found o WHERE o.doc_id = f.doc_id AND o.i <> f.i AND o.s <= f.s AND o.e >= f.e AND o.p <= f.p AND (o.s < f.s OR o.e > f.e OR o.i < f.i))),
b AS (SELECT doc_id, count(*) AS n, min(place) AS low, max(place) AS high, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM base GROUP BY doc_id),
l AS (SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM (SELECT doc_id, label FROM base UNION SELECT doc_id, label FROM kept) GROUP BY doc_id),
k AS (SELECT doc_id, max(CAST(1 AS DOUBLE) - greatest(p - 3, 0) * CAST(0.2 AS DOUBLE)) AS score FROM kept GROUP BY doc_id)
SELECT a.doc_id, CAST(len(a.w) AS BIGINT) AS n_words, CAST(coalesce(b.n, 0) AS BIGINT) AS n_base, CAST(b.low AS BIGINT) AS first_word, CAST(b.high AS BIGINT) AS last_word,
  coalesce(b.labels, '') AS base_labels, coalesce(l.labels, '') AS labels, CASE WHEN b.n > 0 THEN CAST(1 AS DOUBLE) ELSE coalesce(k.score, CAST(0 AS DOUBLE)) END AS score
FROM a LEFT JOIN b ON a.doc_id = b.doc_id LEFT JOIN l ON a.doc_id = l.doc_id LEFT JOIN k ON a.doc_id = k.doc_id
"""


ORACLES = {"op2_jaccard_join": OP2, "op4_pii": OP4, "op9_secrets": OP9, "op10_licenses": op10()}
