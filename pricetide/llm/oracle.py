"""SQL of the operators that it can express, for the checking engine."""

from __future__ import annotations

from pricetide.llm import lookup_shards

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORDS = (
    f"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), "
    r"'[0-9a-z\x{80}-\x{10FFFF}]+')"
)

WARC = """
WITH hashed AS (
  SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS h FROM pages),
bits AS (
  SELECT *, max(page_id) OVER (PARTITION BY body) AS top, array_to_string(list_transform(
    range(1, 41), lambda i: lpad(bin(CAST('0x' || substr(h, i, 1) AS INTEGER)), 4, '0')), '') AS b
  FROM hashed)
SELECT page_id, CAST(octet_length(encode(body)) AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda k: substr(
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(16 * CAST(substr(b, 5 * k + 1, 1) AS INTEGER)
      + 8 * CAST(substr(b, 5 * k + 2, 1) AS INTEGER) + 4 * CAST(substr(b, 5 * k + 3, 1) AS INTEGER)
      + 2 * CAST(substr(b, 5 * k + 4, 1) AS INTEGER) + CAST(substr(b, 5 * k + 5, 1) AS INTEGER)
      AS INTEGER), 1)), '') AS payload_digest,
  CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> top THEN top END AS refers_to, CAST(NULL AS VARCHAR) AS problem
FROM bits
"""

VECTORS = """
WITH RECURSIVE good AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND list_count(embedding) = len(embedding)
    AND len(list_filter(embedding, lambda x: NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
unit AS (SELECT vec_id, len(v) AS n, list_transform(v, lambda x: x / sqrt(list_dot_product(v, v))) AS u FROM good),
links AS MATERIALIZED (
  SELECT a.vec_id AS a, b.vec_id AS b FROM unit a JOIN unit b ON a.n = b.n AND a.vec_id <> b.vec_id
  WHERE list_dot_product(a.u, b.u) >= 0.9),
reach AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings
  UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
top AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
degree AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id, vec_id = component_id AS kept
FROM top LEFT JOIN degree USING (vec_id)
"""

DECONTAMINATION = f"""
WITH docs AS (SELECT doc_id, {_WORDS} AS w FROM documents),
items AS (SELECT item_id, row_number() OVER () AS k, {_WORDS} AS w FROM benchmark),
sized AS (SELECT *, least(len(w), 13) AS m FROM items WHERE len(w) > 0),
wanted AS (SELECT DISTINCT k, item_id, m, list_slice(w, i + 1, i + m) AS run
  FROM (SELECT *, unnest(range(len(w) - m + 1)) AS i FROM sized)),
lengths AS (SELECT DISTINCT m FROM sized),
runs AS (SELECT doc_id, m, i, list_slice(w, i + 1, i + m) AS run
  FROM (SELECT doc_id, w, m, unnest(range(len(w) - m + 1)) AS i FROM docs, lengths WHERE len(w) >= m)),
hits AS MATERIALIZED (SELECT doc_id, i, m, k, item_id FROM runs JOIN wanted USING (m, run)),
hit_words AS (SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + m)) AS p FROM hits) GROUP BY doc_id),
hit_items AS (SELECT doc_id, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names
  FROM (SELECT DISTINCT doc_id, k, CAST(item_id AS VARCHAR) AS name FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""


PHRASES = rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
lists AS (SELECT lang, regexp_extract_all(piece, '[^ \t]+') AS w FROM pieces),
totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM lists GROUP BY lang),
grams AS MATERIALIZED (
  SELECT lang, k, array_to_string(list_slice(w, i, i + k - 1), ' ') AS phrase, count(*) AS f
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i
        FROM lists, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE len(w) >= k)
  GROUP BY 1, 2, 3),
picked AS MATERIALIZED (
  SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM grams WHERE k > 1 AND f >= 30),
cuts AS (
  SELECT lang, phrase, a, c, array_to_string(list_slice(w, 1, c), ' ') AS head,
    array_to_string(list_slice(w, c + 1, k), ' ') AS tail
  FROM (SELECT *, unnest(range(1, k)) AS c FROM picked)),
scored AS (
  SELECT c.lang, c.phrase, c.a, c.c, x.f AS l, y.f AS r,
    CAST((CAST(2000000 AS HUGEINT) * c.a) // (x.f + y.f) AS BIGINT) AS score
  FROM cuts c JOIN grams x ON x.lang = c.lang AND x.phrase = c.head
    JOIN grams y ON y.lang = c.lang AND y.phrase = c.tail),
least AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) AS o FROM scored)
  WHERE o = 1),
longer AS (
  SELECT lang, part, max(a) AS b FROM (
    SELECT lang, a, array_to_string(list_slice(w, 1, k - 1), ' ') AS part FROM picked
    UNION ALL SELECT lang, a, array_to_string(list_slice(w, 2, k), ' ') FROM picked) GROUP BY lang, part),
ranked AS (
  SELECT s.lang, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, s.a DESC, s.phrase) AS rank,
    s.phrase, s.a, l, r, score
  FROM least s LEFT JOIN longer g ON g.lang = s.lang AND g.part = s.phrase
  WHERE g.b IS NULL OR CAST(100 AS HUGEINT) * g.b < CAST(80 AS HUGEINT) * s.a)
SELECT r.lang, rank, phrase, a, l, r.r, t.n, score FROM ranked r JOIN totals t ON t.lang = r.lang
WHERE rank <= 2000
"""

SEARCH = f"""
WITH docs AS (SELECT * FROM (SELECT doc_id, {_WORDS} AS w FROM documents) WHERE len(w) > 0),
total AS (SELECT CAST(count(*) AS BIGINT) AS c, CAST(sum(len(w)) AS BIGINT) AS l FROM docs),
tf AS MATERIALIZED (
  SELECT doc_id, n, t, count(*) AS tf FROM (SELECT doc_id, len(w) AS n, unnest(w) AS t FROM docs) GROUP BY 1, 2, 3),
asked AS (
  SELECT item_id, t, count(*) AS q FROM (SELECT item_id, unnest({_WORDS}) AS t FROM benchmark) GROUP BY 1, 2),
df AS (SELECT t, count(*) AS df FROM tf GROUP BY t),
weighed AS (
  SELECT item_id, t, q * CAST(floor(1000 * ln(CAST(2 * c + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM asked JOIN df USING (t), total),
scored AS (
  SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf
    + 12 * (75 + (25 * CAST(n AS BIGINT) * c) // l)))) AS BIGINT) AS score
  FROM weighed JOIN tf USING (t), total GROUP BY 1, 2),
ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank, doc_id, score
  FROM scored WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 20
"""


def oracle_sql(shards: int, slots: int) -> dict[str, str]:
    return {
        "op3_sharding": lookup_shards.oracle_sql(shards, slots),
        "op4_warc": WARC,
        "op6_embedding_near_dedup": VECTORS,
        "op7_decontamination": DECONTAMINATION,
        "op11_collocations": PHRASES,
        "op13_ranked_search": SEARCH,
    }
