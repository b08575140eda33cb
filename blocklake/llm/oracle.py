"""DuckDB statements of the registered queries that SQL can express, each written the plain way."""

from __future__ import annotations

from blocklake.llm.licenses import EXCLUDED, PHRASES, REQUIRED, TEMPLATES

_LOW = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = (r"list_filter(string_split_regex(translate(coalesce({0}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
          r"'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')")

OP1 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, h, min(page_id) OVER (PARTITION BY h) AS first, sha1(h) AS x FROM p)
SELECT page_id, octet_length(encode(h)) AS payload_bytes,
  array_to_string(list_transform(range(0, 8), lambda i: array_to_string(list_transform(range(0, 4),
    lambda j: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      1 + (((('0x' || substr(x, 1 + 5 * i, 5))::BIGINT) >> (15 - 5 * j)) & 31)::INT, 1)), '')), '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM d
"""

OP3 = """
WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a, v b
      WHERE a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.9),
r(a, b) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
c AS (SELECT a AS vec_id, min(b) AS component_id FROM r GROUP BY 1),
n AS (SELECT a AS vec_id, count(*) AS n FROM l GROUP BY 1)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN c USING (vec_id) LEFT JOIN n USING (vec_id)
"""

OP8 = f"""
WITH d AS (SELECT doc_id, {_WORDS.format("text")} AS w FROM documents),
i AS (SELECT item_id::VARCHAR AS item, {_WORDS.format("text")} AS w FROM benchmark),
iw AS (SELECT DISTINCT item, array_to_string(w[s:s + 12], ' ') AS win, least(len(w), 13) AS n
       FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS s FROM i WHERE len(w) > 0)),
lens AS (SELECT DISTINCT n FROM iw),
dw AS (SELECT doc_id, n, s, array_to_string(w[s:s + n - 1], ' ') AS win
       FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, lens WHERE len(w) >= n)),
m AS (SELECT doc_id, s, dw.n, item FROM dw JOIN iw USING (win, n)),
h AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM m) GROUP BY 1),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
      FROM (SELECT DISTINCT doc_id, item FROM m) GROUP BY 1)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)
"""


OP9 = r"""
WITH RECURSIVE d AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, w[i] || chr(10) || w[i + 1] AS g
      FROM (SELECT doc_id, w, unnest(range(1, len(w))) AS i FROM d WHERE len(w) > 1)
      UNION ALL SELECT doc_id, w[1] FROM d WHERE len(w) = 1),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE 100 * common >= 80 * (x.n + y.n - common)),
r(a, b) AS (SELECT doc_id, doc_id FROM d UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
c AS (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY 1)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM d LEFT JOIN n USING (doc_id) JOIN c USING (doc_id)
"""


def _values(pairs: dict[str, str]) -> str:
    return ", ".join(f"('{a}', '{b}')" for a, b in pairs.items())


def _notices() -> str:
    return ", ".join(f"('{t}', '{name}', '{REQUIRED.get(name, '')}', '{EXCLUDED.get(name, '')}')" for t, name in TEMPLATES.items())


OP10 = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, {_WORDS.format("text")} AS w FROM documents),
ph AS (SELECT *, string_split(phrase, ' ') AS pw FROM (VALUES {_values(PHRASES)}) v(phrase, label)),
pl AS (SELECT doc_id, s - 1 AS spot, label
       FROM (SELECT doc_id, w, pw, label, unnest(range(1, len(w) - len(pw) + 2)) AS s FROM d, ph WHERE len(w) >= len(pw))
       WHERE w[s:s + len(pw) - 1] = pw),
b AS (SELECT doc_id, count(*) AS n_base, min(spot) AS first_word, max(spot) AS last_word,
             string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM pl GROUP BY 1),
tm AS (SELECT label, list_distinct(ws) AS tw, len(ws) AS n, CASE WHEN req = '' THEN []::VARCHAR[] ELSE string_split(req, ' ') END AS req,
              CASE WHEN exc = '' THEN []::VARCHAR[] ELSE string_split(exc, ' ') END AS exc
       FROM (SELECT label, {_WORDS.format("text")} AS ws, req, exc FROM (VALUES {_notices()}) v(text, label, req, exc))),
win AS (SELECT doc_id, label, tw, req, exc, w[s:s + n - 1] AS ww
        FROM (SELECT doc_id, w, tm.*, unnest(range(1, greatest(len(w) - n + 1, 1) + 1)) AS s FROM d, tm
              WHERE list_has_all(w, req) AND len(list_intersect(list_distinct(w), tw)) >= ceil(0.8 * len(tw) - 1e-9))),
hit AS (SELECT doc_id, label, len(list_intersect(list_distinct(ww), tw)) AS shared, len(tw) AS n FROM win
        WHERE len(list_intersect(list_distinct(ww), tw)) >= ceil(0.8 * len(tw) - 1e-9)
              AND list_has_all(ww, req) AND NOT list_has_any(ww, exc)),
best AS (SELECT doc_id, max(shared::DOUBLE / n) AS best FROM hit GROUP BY 1),
al AS (SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
       FROM (SELECT doc_id, label FROM hit UNION ALL SELECT doc_id, label FROM pl) GROUP BY 1)
SELECT doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(best, 0.0)::DOUBLE END AS score
FROM d LEFT JOIN b USING (doc_id) LEFT JOIN best USING (doc_id) LEFT JOIN al USING (doc_id)
"""

OP11 = f"""
WITH d AS (SELECT doc_id, {_WORDS.format("text")} AS w FROM documents),
i AS (SELECT item_id, {_WORDS.format("text")} AS w FROM benchmark),
s AS (SELECT count(*)::BIGINT AS n_docs, sum(len(w))::BIGINT AS n_terms FROM d WHERE len(w) > 0),
q AS (SELECT item_id, term, count(*)::BIGINT AS repeats FROM (SELECT item_id, unnest(w) AS term FROM i) GROUP BY 1, 2),
t AS (SELECT doc_id, n, term, count(*)::BIGINT AS tf FROM (SELECT doc_id, len(w)::BIGINT AS n, unnest(w) AS term FROM d)
      WHERE term IN (SELECT term FROM q) GROUP BY 1, 2, 3),
wt AS (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS wt FROM t, s GROUP BY term, n_docs),
p AS (SELECT doc_id, term, (1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * n_docs) // n_terms)) AS c FROM t, s),
x AS (SELECT item_id, doc_id, sum(repeats * wt * c)::BIGINT AS score FROM q JOIN p USING (term) JOIN wt USING (term) GROUP BY 1, 2),
r AS (SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank
      FROM x WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 10
"""

OP12 = r"""
WITH d AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
g AS (SELECT doc_id, s, array_to_string(w[s:s + 34], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS s FROM d WHERE len(w) >= 35)),
r AS (SELECT g FROM g GROUP BY 1 HAVING count(*) > 1),
c AS (SELECT DISTINCT doc_id, unnest(range(s, s + 35)) AS spot FROM g WHERE g IN (SELECT g FROM r)),
p AS (SELECT doc_id, generate_subscripts(w, 1) AS spot, unnest(w) AS word FROM d),
k AS (SELECT doc_id, string_agg(word, ' ' ORDER BY spot) AS kept FROM p ANTI JOIN c USING (doc_id, spot) GROUP BY 1),
n AS (SELECT doc_id, count(*) AS n FROM c GROUP BY 1)
SELECT doc_id, len(w) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id) LEFT JOIN n USING (doc_id)
"""


def _clusters(rounds: int = 10, k: int = 8) -> str:
    """Every round is a statement of its own: the assignment to the last centroids, then their new means."""
    ctes = [f"""v AS MATERIALIZED (SELECT row_number() OVER () AS i, vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS x
  FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id::VARCHAR), x) - 1 AS c, x AS m FROM v
  QUALIFY row_number() OVER (ORDER BY sha256('3:' || vec_id::VARCHAR), x) <= {k})"""]
    for r in range(rounds + 1):
        ctes.append(f"""a{r} AS MATERIALIZED (SELECT i, vec_id, x, min(o) AS o FROM (SELECT i, vec_id, x, {{'d': list_sum(list_transform(list_zip(x, m),
    lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT, 'c': c}} AS o FROM v, c{r}) GROUP BY ALL)""")
        if r < rounds:
            ctes.append(f"""c{r + 1} AS MATERIALIZED (SELECT c, coalesce(n.m, c{r}.m) AS m FROM c{r} LEFT JOIN (
  SELECT c, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY dim) AS m FROM (
    SELECT o.c AS c, dim, sum(e)::BIGINT AS s, count(*) AS n FROM (SELECT o, generate_subscripts(x, 1) AS dim, unnest(x) AS e FROM a{r}) GROUP BY 1, 2)
  GROUP BY 1) n USING (c))""")
    return f"""WITH {", ".join(ctes)}
SELECT vec_id, o.c::INTEGER AS cluster, o.d AS distance, (sum(o.d) OVER (PARTITION BY o.c))::BIGINT AS cluster_inertia,
  (sum(o.d) OVER ())::BIGINT AS inertia, sha256(array_to_string(m, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} ON o.c = c{rounds}.c"""


ORACLE = {
    "op1_warc_round_trip": OP1,
    "op3_cosine_links": OP3,
    "op8_decontaminate": OP8,
    "op9_near_duplicates": OP9,
    "op10_license_scan": OP10,
    "op11_ranked_search": OP11,
    "op12_substring_dedup": OP12,
    "op13_centroid_clusters": _clusters(),
}
