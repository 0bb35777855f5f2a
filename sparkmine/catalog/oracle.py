"""The SQL form of the registered queries, written independently of the Spark code."""

from __future__ import annotations

import random

from sparkmine.catalog import queries as q

# The hash family of signatures, what stands for an empty set, and how 100 hashes are cut at 0.8.
PRIME, SEED, EMPTY = 4294967311, 42, 9223372036854775807
BANDS, ROWS = 10, 10


def coefficients(count: int) -> list[tuple[int, int]]:
    """Pairs drawn in turn from one seeded generator: a from 1, b from 0, both below the prime."""
    draws = random.Random(SEED)
    return [(draws.randint(1, PRIME - 1), draws.randint(0, PRIME - 1)) for _ in range(count)]


# Unicode white space and the four separators, as a character class.
SPACES = (
    r"\t\n\x{0b}\f\r\x{1c}-\x{1f} \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)

NORM = rf"""
norm AS MATERIALIZED (
  SELECT doc_id,
         trim(regexp_replace(regexp_replace(lower(text), '[^\p{{L}}\p{{N}}_{SPACES}]', '', 'g'),
                             '[{SPACES}]+', ' ', 'g')) AS t
  FROM documents WHERE text IS NOT NULL)"""

GROUPS = f"""
keyed AS (SELECT doc_id, CASE WHEN length(t) < {q.SHINGLE} THEN '' ELSE t END AS key FROM norm),
grp AS MATERIALIZED (SELECT key, min(doc_id) AS gid, count(*) AS copies FROM keyed GROUP BY key)"""

CRC_TABLE = """
crc_table AS (
  SELECT list(list_reduce([i, 1, 2, 3, 4, 5, 6, 7, 8],
                lambda c, s: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)
              ORDER BY i) AS tab
  FROM range(256) AS r(i))"""


def crc(text: str) -> str:
    """CRC-32 of the UTF-8 bytes of ``text``, with ``tab`` in scope."""
    byte = f"('0x' || substr(hex(encode({text})), 2 * i - 1, 2))::BIGINT"
    octets = f"list_transform(range(1, octet_length(encode({text})) + 1), lambda i: {byte})"
    step = "xor(tab[(xor(c, b) & 255) + 1], c >> 8)"
    return f"xor(list_reduce(list_prepend(4294967295, {octets}), lambda c, b: {step}), 4294967295)"


GRAMS = f"""
segments AS (
  SELECT doc_id, substr(t, s * 256 + 1, 256 + {q.SHINGLE - 1}) AS t
  FROM (SELECT doc_id, t, unnest(range(0, (length(t) - {q.SHINGLE}) // 256 + 1)) AS s
        FROM norm WHERE length(t) >= {q.SHINGLE})),
grams AS MATERIALIZED (
  SELECT DISTINCT doc_id, substr(t, i, {q.SHINGLE}) AS g
  FROM (SELECT doc_id, t, unnest(range(1, length(t) - {q.SHINGLE} + 2)) AS i FROM segments)),
{CRC_TABLE.strip()},
hashed AS MATERIALIZED (
  SELECT g, {crc('g')} AS h FROM (SELECT DISTINCT g FROM grams), crc_table),
sh AS MATERIALIZED (SELECT DISTINCT doc_id, h FROM grams JOIN hashed USING (g))"""

SIZES = "sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id)"

TRUE_PAIRS = f"""
rep AS MATERIALIZED (SELECT gid, copies, h FROM sh JOIN grp ON doc_id = gid),
overlap AS (
  SELECT x.gid AS id1, y.gid AS id2, x.copies AS copies1, y.copies AS copies2, count(*) AS shared
  FROM rep x JOIN rep y ON x.h = y.h AND x.gid < y.gid GROUP BY ALL),
compared AS (
  SELECT o.*, s1.n AS size1, s2.n AS size2, shared / (s1.n + s2.n - shared) AS jaccard
  FROM overlap o JOIN sizes s1 ON id1 = s1.doc_id JOIN sizes s2 ON id2 = s2.doc_id),
true_pairs AS MATERIALIZED (SELECT * FROM compared WHERE jaccard >= {q.THRESHOLD})"""

MINIMA = ", ".join(
    f"min(({a}::HUGEINT * h + {b}) % {PRIME})::BIGINT" for a, b in coefficients(q.HASHES)
)
SIGNATURES = f"""
filled AS (SELECT doc_id, [{MINIMA}] AS sig FROM sh GROUP BY doc_id),
signed AS MATERIALIZED (
  SELECT n.doc_id, coalesce(sig, list_transform(range({q.HASHES}), lambda i: {EMPTY})) AS sig
  FROM norm n LEFT JOIN filled f USING (doc_id))"""

BAND_ROWS = f"""
bands AS MATERIALIZED (
  SELECT gid, copies, band, list_slice(sig, band * {ROWS} + 1, (band + 1) * {ROWS}) AS key
  FROM signed JOIN grp ON doc_id = gid, range({BANDS}) AS r(band))"""

CANDIDATES = """
cand AS MATERIALIZED (
  SELECT DISTINCT x.gid AS id1, y.gid AS id2
  FROM bands x JOIN bands y ON x.band = y.band AND x.key = y.key AND x.gid < y.gid)"""

VERIFIED = f"""
members AS (SELECT id1 AS gid FROM cand UNION SELECT id2 FROM cand),
mine AS (SELECT doc_id, h FROM sh SEMI JOIN members ON doc_id = gid),
met AS (
  SELECT id1, id2, count(*) AS shared
  FROM cand JOIN mine x ON x.doc_id = id1 JOIN mine y ON y.doc_id = id2 AND y.h = x.h
  GROUP BY id1, id2),
sized AS (SELECT gid, copies, coalesce(n, 0) AS n FROM grp LEFT JOIN sizes ON doc_id = gid),
verified AS MATERIALIZED (
  SELECT id1, id2, g1.copies AS copies1, g2.copies AS copies2,
         CASE WHEN g1.n + g2.n = 0 THEN 1.0
              ELSE coalesce(shared, 0) / (g1.n + g2.n - coalesce(shared, 0)) END AS jaccard
  FROM cand JOIN sized g1 ON g1.gid = id1 JOIN sized g2 ON g2.gid = id2
       LEFT JOIN met USING (id1, id2))"""


def crc_bands() -> str:
    shown = f"list_transform(key, lambda v: CASE WHEN v = {EMPTY} THEN 'inf' ELSE v::VARCHAR END)"
    end = ",)" if ROWS == 1 else ")"
    text = f"'(' || array_to_string({shown}, ', ') || '{end}'"
    return f"""
written AS (SELECT gid, copies, band, {text} AS s FROM bands),
crcs AS (SELECT s, {crc('s')} AS key FROM (SELECT DISTINCT s FROM written), crc_table)"""


def sql(select: str, *parts: str) -> str:
    return "WITH " + ",".join(part.strip() for part in parts) + "\n" + select.strip()


SETS = (NORM, GRAMS, SIZES)
LSH = (NORM, GROUPS, GRAMS, SIZES, SIGNATURES, BAND_ROWS, CANDIDATES)


def quality(where: str = "TRUE") -> str:
    """Totals of document pairs; ``where`` restricts the groups."""
    return f"""
counts AS (
  SELECT (SELECT coalesce(sum(copies * (copies - 1) // 2), 0) FROM grp WHERE {where})
         + (SELECT coalesce(sum(copies1 * copies2), 0) FROM verified
            WHERE jaccard >= {q.THRESHOLD}) AS tp,
         (SELECT coalesce(sum(copies1 * copies2), 0) FROM verified
          WHERE jaccard < {q.THRESHOLD}) AS fp,
         (SELECT coalesce(sum(copies1 * copies2), 0)
          FROM true_pairs ANTI JOIN cand USING (id1, id2)) AS fn)"""


ORACLE: dict[str, str] = {
    "text_normalize": sql("SELECT doc_id, t AS normalized FROM norm", NORM),
    "shingle_counts": sql(
        """SELECT doc_id, length(t) AS n_chars, coalesce(n, 0) AS n_shingles
           FROM norm LEFT JOIN sizes USING (doc_id)""",
        *SETS,
    ),
    "shingle_hashes": sql(
        """SELECT doc_id, min(h) AS min_hash, max(h) AS max_hash, sum(h)::BIGINT AS sum_hash
           FROM sh GROUP BY doc_id""",
        *SETS,
    ),
    "shingle_frequency": sql(
        """SELECT docs, count(*) AS shingles
           FROM (SELECT h, count(*) AS docs FROM sh GROUP BY h) GROUP BY docs""",
        *SETS,
    ),
    "text_groups": sql(
        "SELECT doc_id, gid AS group_id, copies FROM keyed JOIN grp USING (key)", NORM, GROUPS
    ),
    "jaccard_pairs": sql(
        """SELECT id1, id2, copies1, copies2, size1, size2, shared, round(jaccard, 6) AS jaccard
           FROM true_pairs""",
        NORM, GROUPS, GRAMS, SIZES, TRUE_PAIRS,
    ),
    "minhash_signatures": sql(
        "SELECT doc_id, array_to_string(sig, ',') AS signature FROM signed", *SETS, SIGNATURES
    ),
    "minhash_estimate": sql(
        f"""SELECT id1, id2,
              round(list_sum(list_transform(list_zip(x.sig, y.sig),
                    lambda p: CASE WHEN p[1] = p[2] THEN 1 ELSE 0 END)) / {q.HASHES}, 6) AS estimate
           FROM cand JOIN signed x ON x.doc_id = id1 JOIN signed y ON y.doc_id = id2""",
        *LSH,
    ),
    "lsh_buckets": sql(
        """SELECT band, bucket_id, gid AS group_id, groups, docs::BIGINT AS docs
           FROM bands JOIN (SELECT band, key, min(gid) AS bucket_id, count(*) AS groups,
                                   sum(copies) AS docs
                            FROM bands GROUP BY band, key HAVING sum(copies) > 1) b
           USING (band, key)""",
        *LSH,
    ),
    "lsh_candidates": sql("SELECT id1, id2 FROM cand", *LSH),
    "lsh_candidates_crc": sql(
        """SELECT DISTINCT x.gid AS id1, y.gid AS id2
           FROM (written JOIN crcs USING (s)) x JOIN (written JOIN crcs USING (s)) y
             ON x.band = y.band AND x.key = y.key AND x.gid < y.gid""",
        *LSH[:-1], crc_bands(),
    ),
    "lsh_verified": sql(
        f"""SELECT id1, id2, copies1, copies2, round(jaccard, 6) AS jaccard,
                   jaccard >= {q.THRESHOLD} AS is_similar
            FROM verified""",
        *LSH, VERIFIED,
    ),
    "lsh_band_plan": sql(
        f"""SELECT band, {BANDS}::BIGINT AS bands, {ROWS}::BIGINT AS rows_per_band,
                   count(*) AS groups, count(DISTINCT key) AS buckets
            FROM bands GROUP BY band""",
        *LSH,
    ),
    "lsh_missed": sql(
        """SELECT id1, id2, round(jaccard, 6) AS jaccard
           FROM true_pairs ANTI JOIN cand USING (id1, id2)""",
        *LSH, TRUE_PAIRS,
    ),
    "lsh_quality": sql(
        """SELECT tp::BIGINT AS true_positives, fp::BIGINT AS false_positives,
                  fn::BIGINT AS false_negatives, round(tp / nullif(tp + fn, 0), 6) AS recall,
                  round(tp / nullif(tp + fp, 0), 6) AS precision
           FROM counts""",
        *LSH, VERIFIED, TRUE_PAIRS, quality(),
    ),
    "near_duplicates": sql(
        f"""SELECT id1, id2, copies1, copies2, round(jaccard, 6) AS jaccard
            FROM verified WHERE jaccard >= {q.THRESHOLD}""",
        *LSH, VERIFIED,
    ),
    "near_duplicates_drop_empties": sql(
        """SELECT tp::BIGINT AS true_positives, fp::BIGINT AS false_positives,
                  fn::BIGINT AS false_negatives FROM counts""",
        *LSH, VERIFIED, TRUE_PAIRS, quality("key <> ''"),
    ),
}

# Text files

ACCEPTED = rf"""
line AS (
  SELECT doc_id, lang || chr(9) || regexp_replace(text, '[\r\n]+', ' ', 'g') AS line
  FROM documents WHERE lang IS NOT NULL AND text IS NOT NULL),
stripped AS (
  SELECT doc_id, regexp_replace(line, '^[{SPACES}]+|[{SPACES}]+$', '', 'g') AS line FROM line),
halves AS (
  SELECT doc_id, substr(line, 1, strpos(line, chr(9)) - 1) AS label,
         substr(line, strpos(line, chr(9)) + 1) AS text
  FROM stripped WHERE strpos(line, chr(9)) > 0),
accepted AS (
  SELECT row_number() OVER (ORDER BY doc_id) AS n, label, text
  FROM halves WHERE regexp_matches(text, '[^{SPACES}]'))"""

ORACLE["labelled_texts"] = sql(
    "SELECT n, 'sms_' || n AS doc_id, label, text FROM accepted", ACCEPTED
)
ORACLE["labelled_texts_first"] = sql(
    f"SELECT n, 'sms_' || n AS doc_id, label FROM accepted WHERE n <= {q.FIRST_DOCS}", ACCEPTED
)


# Frequent itemsets


def items(column: str, support: float = q.SUPPORT) -> str:
    return f"""
items AS MATERIALIZED (
  SELECT DISTINCT l_orderkey AS tid, {column} AS item
  FROM lineitem JOIN part ON l_partkey = p_partkey
  WHERE l_orderkey IS NOT NULL AND {column} IS NOT NULL),
bound AS (SELECT count(DISTINCT tid) AS n, count(DISTINCT tid) * {support}::DOUBLE AS least FROM items)"""


def level(k: int) -> str:
    """Itemsets of size k as columns i1 … ik with cnt, by a self-join of the items."""
    names = [f"x{j}.item AS i{j}" for j in range(1, k + 1)]
    joins = "".join(
        f" JOIN items x{j} ON x{j}.tid = x1.tid AND x{j}.item > x{j - 1}.item" for j in range(2, k + 1)
    )
    keys = ", ".join(f"x{j}.item" for j in range(1, k + 1))
    return f"""
l{k} AS MATERIALIZED (
  SELECT {', '.join(names)}, count(*) AS cnt FROM items x1{joins}
  GROUP BY {keys} HAVING count(*) >= (SELECT least FROM bound))"""


def text_of(k: int) -> str:
    return " || '|' || ".join(f"i{j}" for j in range(1, k + 1))


LONGEST = 6
TYPE_LEVELS = [level(k) for k in range(1, LONGEST + 1)]
ALL_SETS = "sets AS MATERIALIZED (" + " UNION ALL ".join(
    f"SELECT {k} AS k, [{', '.join(f'i{j}' for j in range(1, k + 1))}] AS itemset, cnt FROM l{k}"
    for k in range(1, LONGEST + 1)
) + ")"

ORACLE["basket_file"] = sql(
    """SELECT row_number() OVER (ORDER BY tid) AS tid,
              array_to_string(list_sort(list(replace(item, ' ', '_'))), '|') AS items
       FROM items GROUP BY items.tid""",
    items("p_brand"),
)
ORACLE["basket_items"] = sql(
    f"""SELECT tid, part, array_to_string(list_sort(list(item)), '|') AS items
        FROM (SELECT tid, item, (row_number() OVER (PARTITION BY tid ORDER BY item) - 1) // {q.BASKET_PART} AS part FROM items)
        GROUP BY tid, part""",
    items("p_type"),
)
ORACLE["basket_items_support"] = sql(
    "SELECT i1 AS itemset, cnt FROM l1", items("p_brand || ' ' || p_type", q.PRUNING_SUPPORT), level(1)
)
ORACLE["itemsets_level2"] = sql(
    f"SELECT {text_of(2)} AS itemset, cnt FROM l2", items("p_brand", q.PRUNING_SUPPORT), level(2)
)
ORACLE["candidates_pruned"] = sql(
    """SELECT x.i1 || '|' || x.i2 || '|' || y.i2 AS itemset
       FROM l2 x JOIN l2 y ON x.i1 = y.i1 AND x.i2 < y.i2 JOIN l2 z ON z.i1 = x.i2 AND z.i2 = y.i2""",
    items("p_brand", q.PRUNING_SUPPORT), level(2),
)
ORACLE["itemsets_level3"] = sql(
    f"SELECT {text_of(3)} AS itemset, cnt FROM l3", items("p_type"), level(3)
)
ORACLE["frequent_itemsets"] = sql(
    """SELECT k::BIGINT AS k, array_to_string(itemset, '|') AS itemset, cnt,
              round(cnt / n, 6) AS support
       FROM sets, bound""",
    items("p_type"), *TYPE_LEVELS, ALL_SETS,
)
ORACLE["itemset_totals"] = sql(
    "SELECT k::BIGINT AS k, count(*) AS itemsets FROM sets GROUP BY ROLLUP (k)",
    items("p_type"), *TYPE_LEVELS, ALL_SETS,
)
ORACLE["association_rules"] = sql(
    f"""SELECT array_to_string(x.itemset, '|') AS antecedent,
              array_to_string(y.itemset, '|') AS consequent, s.cnt AS support_cnt,
              round(s.cnt / n, 6) AS support, round(s.cnt / x.cnt, 6) AS confidence,
              round((s.cnt / x.cnt) / (y.cnt / n), 6) AS lift
       FROM sets s
       JOIN sets x ON x.k < s.k AND list_has_all(s.itemset, x.itemset)
       JOIN sets y ON y.k = s.k - x.k
                  AND y.itemset = list_filter(s.itemset, lambda i: NOT list_contains(x.itemset, i)),
       bound
       WHERE s.cnt / x.cnt >= {q.CONFIDENCE}""",
    items("p_type"), *TYPE_LEVELS, ALL_SETS,
)

# Edge streams

STEPS = """
steps AS MATERIALIZED (
  SELECT * FROM (SELECT user_id AS u, lead(user_id) OVER w AS v, row_number() OVER w AS n
                 FROM events WINDOW w AS (ORDER BY ts, event_id))
  WHERE v IS NOT NULL)"""
CLEAN = """
clean AS (SELECT least(u, v) AS a, greatest(u, v) AS b, min(n) AS n FROM steps WHERE u <> v
          GROUP BY 1, 2)"""
EDGES = "edges AS MATERIALIZED (SELECT row_number() OVER (ORDER BY n) AS t, a, b FROM clean)"
STREAM = (STEPS, CLEAN, EDGES)


def draw(mark: str) -> str:
    digest = f"substr(md5(seed || '{mark}:' || t), 1, 13)"
    return f"(('0x' || {digest})::BIGINT / 4503599627370496.0::DOUBLE)"


def lives(runs) -> str:
    rows = ", ".join(f"({i}, {run.size}, {run.seed})" for i, run in enumerate(runs, 1))
    return lives_of(f"(VALUES {rows}) AS c(run, size, seed)")


def lives_of(config: str) -> str:
    return f"""
entered AS (
  SELECT run, size, t, a, b,
         CASE WHEN t <= size THEN t - 1 ELSE floor({draw('s')} * size)::BIGINT END AS slot
  FROM edges, {config}
  WHERE t <= size OR {draw('a')} < size / t),
lives AS MATERIALIZED (
  SELECT run, size, slot, t AS t_in, a, b,
         lead(t) OVER w AS t_out, lag(a) OVER w AS old_a, lag(b) OVER w AS old_b
  FROM entered WINDOW w AS (PARTITION BY run, slot ORDER BY t))"""


GAINS = """
hops AS MATERIALIZED (
  SELECT run, size, t_in, t_out, a AS x, b AS y FROM lives
  UNION ALL SELECT run, size, t_in, t_out, b, a FROM lives),
gains AS MATERIALIZED (
  SELECT h1.run, h1.size, t,
         CASE WHEN t <= h1.size THEN 1.0::DOUBLE
              ELSE (t - 1.0::DOUBLE) * (t - 2) / (h1.size::DOUBLE * (h1.size - 1)) END AS gain
  FROM edges
  JOIN hops h1 ON h1.x = a AND h1.t_in < t AND (h1.t_out IS NULL OR h1.t_out >= t)
  JOIN hops h2 ON h2.run = h1.run AND h2.x = b AND h2.y = h1.y
              AND h2.t_in < t AND (h2.t_out IS NULL OR h2.t_out >= t)),
estimates AS (
  SELECT r.size::BIGINT AS size, coalesce(sum(gain), 0) AS estimate
  FROM (SELECT DISTINCT run, size FROM lives) r LEFT JOIN gains g ON g.run = r.run GROUP BY r.run, r.size)"""
EXACT = """
exact AS (
  SELECT count(*) AS triangles
  FROM edges e JOIN edges f ON f.a = e.b JOIN edges g ON g.a = e.a AND g.b = f.b)"""
SAMPLE = (*STREAM, lives([q.SAMPLE]))
SWEEP = (*STREAM, lives(q.SWEEP), GAINS)
ROUNDED = "SELECT size, round(estimate, 3) AS estimate FROM estimates"

ORACLE |= {
    "edge_file": sql("SELECT u, v, count(*) AS arrivals FROM steps GROUP BY u, v", STEPS),
    "row_counts": sql(
        """SELECT 'documents' AS what, count(*) AS n FROM documents
           UNION ALL SELECT 'baskets', count(DISTINCT tid) FROM items
           UNION ALL SELECT 'edges', count(*) FROM clean""",
        items("p_type"), STEPS, CLEAN,
    ),
    "edges_clean": sql("SELECT a, b, n FROM clean", STEPS, CLEAN),
    "edge_positions": sql("SELECT t, a, b FROM edges", *STREAM),
    "edge_preview": sql("SELECT t, a, b FROM edges WHERE t <= 5", *STREAM),
    "edges_shuffled": sql(
        f"""SELECT row_number() OVER (ORDER BY md5('{q.SHUFFLE_SEED}:' || t), t) AS t, t AS was, a, b
            FROM edges""",
        *STREAM,
    ),
    "reservoir_log": sql("SELECT t_in AS t, slot, a, b, old_a, old_b FROM lives", *SAMPLE),
    "reservoir_final": sql("SELECT slot, t_in, a, b FROM lives WHERE t_out IS NULL", *SAMPLE),
    "reservoir_at": sql(
        f"""SELECT slot, t_in, a, b FROM lives
            WHERE t_in <= {q.SAMPLE_TIME} AND (t_out IS NULL OR t_out > {q.SAMPLE_TIME})""",
        *SAMPLE,
    ),
    "node_degree": sql(
        """SELECT node, count(*) AS degree
           FROM (SELECT a AS node FROM edges UNION ALL SELECT b FROM edges) GROUP BY node""",
        *STREAM,
    ),
    "node_neighbors": sql(
        """SELECT node, neighbor
           FROM (SELECT a AS node, b AS neighbor FROM lives WHERE t_out IS NULL
                 UNION ALL SELECT b, a FROM lives WHERE t_out IS NULL)""",
        *SAMPLE,
    ),
    "common_neighbors": sql(
        """SELECT e.a, e.b, count(h2.y) AS common
           FROM edges e LEFT JOIN hops h1 ON h1.x = e.a AND h1.t_out IS NULL
           LEFT JOIN hops h2 ON h2.x = e.b AND h2.y = h1.y AND h2.t_out IS NULL
           GROUP BY e.a, e.b""",
        *SAMPLE, GAINS,
    ),
    "triangles_exact": sql("SELECT triangles FROM exact", *STREAM, EXACT),
    "triest_estimate": sql(ROUNDED, *SAMPLE, GAINS),
    "triest_by_ratio": sql(
        ROUNDED,
        *STREAM,
        lives_of(
            f"""(SELECT 1 AS run, floor({q.RATIO} * count(*))::BIGINT AS size, 42 AS seed
                 FROM edges) AS c"""
        ),
        GAINS,
    ),
    "triest_history": sql(
        f"""SELECT e.t, floor(coalesce(sum(gain), 0))::BIGINT AS estimate
            FROM edges e LEFT JOIN gains g ON g.t <= e.t WHERE e.t % {q.EVERY} = 0 GROUP BY e.t""",
        *SAMPLE, GAINS,
    ),
    "triest_sweep": sql(ROUNDED, *SWEEP),
    "triest_error": sql(
        """SELECT size, triangles, round(abs(estimate - triangles), 3) AS abs_error,
                  round(abs(estimate - triangles) / nullif(triangles, 0), 6) AS rel_error,
                  CASE WHEN abs(estimate - triangles) / nullif(triangles, 0) < 0.10 THEN 'excellent'
                       WHEN abs(estimate - triangles) / nullif(triangles, 0) < 0.20 THEN 'good'
                       WHEN triangles > 0 THEN 'high variance' END AS band
           FROM estimates, exact""",
        *SWEEP, EXACT,
    ),
    "triest_stream": sql(
        "SELECT (SELECT count(*) FROM edges) AS edges, round(estimate, 3) AS estimate FROM estimates",
        *SAMPLE, GAINS,
    ),
}

ORACLE |= {
    "near_duplicates_crowded": ORACLE["near_duplicates"],
    "lsh_quality_crowded": ORACLE["lsh_quality"],
    "triest_stream_simple": ORACLE["triest_stream"],
}
