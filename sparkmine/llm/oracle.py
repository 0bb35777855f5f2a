"""SQL with the rows of the registered queries, for DuckDB, where SQL can express them."""

from __future__ import annotations

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def lowered(text: str) -> str:
    return f"translate(coalesce({text}, ''), '{UPPER}', '{UPPER.lower()}')"


OP1 = f"""
WITH RECURSIVE d AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({lowered("text")}, '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents
), s AS MATERIALIZED (
  SELECT r, doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(len(w) - 2), lambda i: array_to_string(w[i + 1 : i + 3], ' '))) END AS x
  FROM d
), e AS MATERIALIZED (
  SELECT r, len(x) AS n, unnest(x) AS g FROM s
), pairs AS MATERIALIZED (
  SELECT a.r AS u, b.r AS v FROM e a JOIN e b ON a.g = b.g AND a.r < b.r
    AND 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n)
  GROUP BY a.r, b.r, a.n, b.n HAVING 190 * count(*) >= 90 * (a.n + b.n)
), both_ways AS MATERIALIZED (
  SELECT u, v FROM pairs UNION ALL SELECT v, u FROM pairs
), reached AS (
  SELECT r AS a, r AS b FROM s
  UNION SELECT a, v FROM reached JOIN both_ways ON b = u
)
SELECT s.doc_id, CAST(len(s.x) AS BIGINT) AS n_shingles, c.component_id, coalesce(l.n_links, 0) AS n_links
FROM s
JOIN (SELECT a, min(t.doc_id) AS component_id FROM reached JOIN s t ON b = t.r GROUP BY a) c ON c.a = s.r
LEFT JOIN (SELECT u, count(*) AS n_links FROM both_ways GROUP BY u) l ON l.u = s.r
"""

WORDS2 = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"

OP2 = f"""
WITH d AS (
  SELECT doc_id, regexp_extract_all({lowered("text")}, {WORDS2}) AS w FROM documents
), i AS (
  SELECT item_id, regexp_extract_all({lowered("text")}, {WORDS2}) AS w FROM benchmark WHERE item_id IS NOT NULL
), spans AS (
  SELECT item_id, w, least(13, len(w)) AS m, unnest(range(len(w) - least(13, len(w)) + 1)) AS p FROM i WHERE len(w) > 0
), item_windows AS (
  SELECT DISTINCT item_id, m, array_to_string(w[p + 1 : p + m], ' ') AS win FROM spans
), lengths AS (
  SELECT DISTINCT m FROM item_windows
), doc_windows AS (
  SELECT doc_id, w, m, unnest(range(len(w) - m + 1)) AS p FROM d, lengths WHERE len(w) >= m
), met AS (
  SELECT doc_id, p, x.m, item_id
  FROM (SELECT doc_id, p, m, array_to_string(w[p + 1 : p + m], ' ') AS win FROM doc_windows) x
  JOIN item_windows y ON x.m = y.m AND x.win = y.win
), hit AS (
  SELECT doc_id, count(DISTINCT place) AS n_hit
  FROM (SELECT doc_id, unnest(range(p, p + m)) AS place FROM met) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS named
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM met) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(named, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""

OP4 = """
WITH v AS (
  SELECT row_number() OVER () AS nth, vec_id,
    list_transform(embedding, lambda c: CAST(floor(64 * CAST(c AS DOUBLE)) AS DOUBLE)) AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
), scored AS (
  SELECT q.nth, q.vec_id AS query_id, v.vec_id, CAST(list_inner_product(q.x, v.x) AS BIGINT) AS score
  FROM v q JOIN v ON q.vec_id % 20 = 0 AND v.nth <> q.nth AND len(v.x) = len(q.x)
), ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY nth ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
    vec_id, score FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""

OP5 = r"""
WITH given AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, text,
    length(regexp_replace(coalesce(role, ''), '[\\<>]', '..', 'g'))
      + length(regexp_replace(text, '[\\<>]', '..', 'g')) + length('<>') + length('</turn>') + 2 AS chars
  FROM given
)
SELECT CAST(conv_id AS BIGINT) AS conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '')) AS loss_sha256,
  CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id
"""

OP7 = f"""
WITH u AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), p AS (
  SELECT page_id, {lowered("regexp_extract(rest, '^[^/?#]*')")} AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM u
), rules AS (
  SELECT * FROM (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
    ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')) AS r (h, s, v)
), best AS (
  SELECT page_id, arg_max(h || s, length(h || s)) AS rule, arg_max(v, length(h || s)) AS v
  FROM p JOIN rules ON (host = h OR suffix(host, '.' || h)) AND prefix(path, s) GROUP BY page_id
)
SELECT page_id, coalesce(host, '') AS host, coalesce(path, '') AS path, rule, coalesce(v, 'allow') AS verdict
FROM p LEFT JOIN best USING (page_id)
"""

OP11 = f"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all({lowered("text")}, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w
  FROM documents
), said AS MATERIALIZED (
  SELECT r, lang, source, term, count(*) AS n FROM (SELECT r, lang, source, unnest(w) AS term FROM d) GROUP BY ALL
), kept AS MATERIALIZED (
  SELECT lang, term, sum(n) AS n FROM said GROUP BY lang, term HAVING count(*) >= 3
), langs AS MATERIALIZED (
  SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang
), counts AS MATERIALIZED (
  SELECT s.lang, source, term, sum(s.n) AS n FROM said s JOIN kept k USING (lang, term) GROUP BY ALL
), groups AS MATERIALIZED (
  SELECT lang, source, coalesce(sum(n), 0) AS total
  FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN counts USING (lang, source) GROUP BY lang, source
), p AS MATERIALIZED (
  SELECT g.lang, source, term, coalesce(c.n, 0) AS n,
    CAST(1 + (1000000000 * (coalesce(c.n, 0) + 1)::HUGEINT) // (g.total + l.v) AS HUGEINT) AS p,
    CAST(1 + (1000000000 * (k.n + 1)::HUGEINT) // (l.total + l.v) AS HUGEINT) AS q
  FROM groups g JOIN langs l USING (lang) JOIN kept k USING (lang) LEFT JOIN counts c USING (lang, source, term)
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(f, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (
    SELECT x.lang, x.source, y.source AS item, sum((x.p - y.p) * (x.p - y.p) // y.p) AS f
    FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL
  ) m ON m.lang = a.lang AND m.source = a.source AND m.item = b.source
), rows AS (
  SELECT lang, source, 'pair' AS part, item, value FROM pairs
  UNION ALL SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM p WHERE n > 0 AND p > q
), ranked AS (
  SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
    CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
  FROM rows
)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 200
"""

CRC = """list_reduce(list_prepend(4294967295, list_transform(range(1, octet_length(encode(key)) + 1),
    lambda i: ('0x' || substr(hex(encode(key)), 2 * i - 1, 2))::BIGINT)),
    lambda c, b: xor(tab[(xor(c, b) & 255) + 1], c >> 8))"""
BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def edited(state: str, cost: str, letter: str, line: str = "") -> str:
    """A state after one more edit, which adds ``line`` to the result unless it is empty."""
    lines = f"list_append({state}.t, {line})" if line else f"{state}.t"
    key = f"printf('%08d', CAST({state}.k[1:8] AS INTEGER) + {cost}) || {state}.k[9:] || '{letter}'"
    return f"CASE WHEN {state} IS NOT NULL THEN {{'k': {key}, 't': {lines}}} END"


def cheapest(*states: str) -> str:
    return f"list_sort(list_filter([{', '.join(states)}], lambda x: x IS NOT NULL))[1]"


def inserted(rows: str) -> str:
    """States c0 to c3 after any inserts, of s0 to s3; the further columns of ``rows`` stay."""
    user = [edited(f"s{i}", "3", "I", "'user:'") for i in (0, 1, 3)]
    return f"""(SELECT *, {cheapest("s3", edited("c2", "3", "I", "'assistant:'"))} AS c3 FROM
      (SELECT *, s0 AS c0, s1 AS c1, {cheapest("s2", *user)} AS c2 FROM {rows}))"""


def taken(role: str, initial: str, states: list[int]) -> list[str]:
    """Keeping a row of this initial, and giving it ``role``, from any of ``states``."""
    line, extra = "r.role || ':' || r.text", "CASE WHEN r.fault = 3 THEN 3 ELSE 0 END"
    keep = [f"CASE WHEN r.ok AND r.initial = '{initial}' THEN {edited(f'c{i}', extra, 'K', line)} END" for i in states]
    line = f"'{role}:' || r.text"
    return keep + [f"CASE WHEN r.ok THEN {edited(f'c{i}', f'3 + {extra}', 'R', line)} END" for i in states if role]


OP12 = f"""
WITH RECURSIVE crc_table AS (
  SELECT list(list_reduce([i, 1, 2, 3, 4, 5, 6, 7, 8],
    lambda c, s: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) ORDER BY i) AS tab
  FROM range(256) AS r(i)
), tagged AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key
  FROM conversations
), kinds AS (
  SELECT conv_id, turn, role, text, xor({CRC}, 4294967295) % 20 AS kind FROM tagged, crc_table
), damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE WHEN kind = 0 THEN [] WHEN kind = 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM kinds
), placed AS (
  SELECT conv_id, turn, role, text, row_number() OVER (PARTITION BY conv_id
    ORDER BY turn NULLS FIRST, role, md5(length(role) || ':' || role || text), copy) AS i
  FROM damaged
), rows AS MATERIALIZED (
  SELECT *, substr(role, 1, 1) AS initial, fault NOT IN (1, 2) AS ok FROM (
    SELECT *, CASE WHEN rtrim(text, {BLANKS}) = '' THEN 1
      WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 2
      WHEN right(rtrim(text, {BLANKS}), 1) NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault
    FROM placed)
), counts AS (
  SELECT conv_id, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps, count(*) AS n,
    count(*) FILTER (fault = 1) AS blank, count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated
  FROM rows GROUP BY conv_id
), breaks AS (
  SELECT conv_id, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM (SELECT conv_id, lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial AS pair FROM rows) GROUP BY conv_id
), walk AS (
  SELECT conv_id, 0::BIGINT AS i, {{'k': '00000000', 't': CAST([] AS VARCHAR[])}} AS s0,
    CAST(NULL AS STRUCT(k VARCHAR, t VARCHAR[])) AS s1, CAST(NULL AS STRUCT(k VARCHAR, t VARCHAR[])) AS s2,
    CAST(NULL AS STRUCT(k VARCHAR, t VARCHAR[])) AS s3
  FROM (SELECT DISTINCT conv_id FROM conversations)
  UNION ALL
  SELECT w.conv_id, r.i, {edited("c0", "4", "D")},
    {cheapest(edited("c1", "4", "D"), *taken("", "s", [0]))},
    {cheapest(edited("c2", "4", "D"), *taken("user", "u", [0, 1, 3]))},
    {cheapest(edited("c3", "4", "D"), *taken("assistant", "a", [2]))}
  FROM {inserted("walk")} w JOIN rows r ON w.conv_id IS NOT DISTINCT FROM r.conv_id AND r.i = w.i + 1
), ended AS (
  SELECT conv_id, {cheapest("c0", "c3")} AS best
  FROM {inserted("(SELECT * FROM walk QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) = 1)")}
)
SELECT CAST(e.conv_id AS BIGINT) AS conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank,
  coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  CAST(best.k[1:8] AS BIGINT) AS cost, best.k[9:] AS audit, sha256(array_to_string(best.t, chr(10))) AS repaired_sha256
FROM ended e LEFT JOIN counts c ON e.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN breaks b ON e.conv_id IS NOT DISTINCT FROM b.conv_id
"""

ORACLE = {
    "op1_ngram_jaccard_join": OP1,
    "op2_benchmark_decontamination": OP2,
    "op4_exact_top_k": OP4,
    "op5_chat_formatting": OP5,
    "op7_url_rules": OP7,
    "op11_source_divergence": OP11,
    "op12_conversation_repair": OP12,
}
