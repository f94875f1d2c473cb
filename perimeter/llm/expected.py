"""The registered queries as DuckDB SQL, where SQL expresses them."""

OP7 = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '-') || ':' || coalesce(md5(text), '-')), 1, 15))::BIGINT AS h
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS place,
             sum(source_size) OVER () * 1.5::DOUBLE AS budget FROM s),
v AS (SELECT *, [5, 2, 1][((place - 1) % 3 + 1)::INT] AS weight, 2 * source_size AS most FROM w),
l AS (SELECT *, most::DOUBLE / weight AS full_at,
        (budget - coalesce(sum(most) OVER (ORDER BY most::DOUBLE / weight, place
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
        / sum(weight) OVER (ORDER BY most::DOUBLE / weight, place
             ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::DOUBLE AS level FROM v),
t AS (SELECT source, source_size, least(most::DOUBLE, coalesce(
        (SELECT arg_min(level, place) FROM (SELECT level, row_number() OVER (ORDER BY full_at, place) AS place
          FROM l WHERE full_at > level)) * weight, most::DOUBLE)) AS target FROM l),
p AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS passes FROM t),
r AS (SELECT *, target - (passes * source_size)::DOUBLE AS rest FROM p),
u AS (SELECT source, h, sum(size)::BIGINT AS words FROM d GROUP BY source, h),
c AS (SELECT source, h, words, (sum(words) OVER (PARTITION BY source ORDER BY h))::BIGINT AS upto FROM u),
x AS (SELECT d.doc_id, d.size, r.source_size, r.target,
        least(2, r.passes + CASE WHEN r.rest > 0 AND (c.upto <= r.rest OR (c.upto - c.words < r.rest
          AND c.upto - r.rest <= r.rest - (c.upto - c.words))) THEN 1 ELSE 0 END) AS copies, r.rest, c.upto
      FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source
             JOIN c ON d.source IS NOT DISTINCT FROM c.source AND d.h = c.h)
SELECT doc_id, size, source_size, target, (size * copies)::BIGINT AS taken FROM x
"""

OP10 = r"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
iw AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, k, list_slice(w, s, s + k - 1) AS g
  FROM (SELECT item_id, w, least(10, len(w)) AS k, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS s
        FROM iw WHERE len(w) > 0)),
dg AS (
  SELECT doc_id, k, p, list_slice(w, p, p + k - 1) AS g
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS p
        FROM dw, (SELECT DISTINCT k FROM win) WHERE len(w) >= k)),
hit AS (SELECT doc_id, p, k, item_id FROM dg JOIN win USING (k, g)),
n AS (SELECT doc_id, count(DISTINCT q) AS n_hit
      FROM (SELECT doc_id, unnest(range(p, p + k)) AS q FROM hit) GROUP BY doc_id),
i AS (SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS ids
      FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS x FROM hit) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN n USING (doc_id) LEFT JOIN i USING (doc_id)
"""

OP3 = r"""
WITH v AS (
  SELECT vec_id, row_number() OVER () AS r, [floor(256 * x::DOUBLE)::BIGINT for x in embedding] AS q FROM embeddings
  WHERE embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT a.r, a.vec_id AS query_id, b.vec_id, list_dot_product(a.q::DOUBLE[], b.q::DOUBLE[])::BIGINT AS score
  FROM v a JOIN v b ON a.r <> b.r AND len(a.q) = len(b.q) WHERE a.vec_id % 50 = 0)
SELECT query_id, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score
FROM s QUALIFY rank <= 5
"""

OP4 = r"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT doc_id, s, md5_number(substr(h, 2 * s + 1, 200)) AS k
      FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2 - 99)) AS s FROM d WHERE len(h) >= 200)),
f AS (SELECT doc_id, s FROM (SELECT doc_id, s, row_number() OVER (PARTITION BY k ORDER BY doc_id, s) AS n FROM w) WHERE n > 1),
m AS (SELECT doc_id, s, sum(new) OVER (PARTITION BY doc_id ORDER BY s) AS island
      FROM (SELECT doc_id, s, CASE WHEN s - lag(s) OVER (PARTITION BY doc_id ORDER BY s) <= 100 THEN 0 ELSE 1 END AS new FROM f)),
i AS (SELECT doc_id, min(s) AS a, max(s) + 100 AS b FROM m GROUP BY doc_id, island),
e AS (SELECT doc_id, a, b FROM i UNION ALL SELECT doc_id, len(h) // 2, len(h) // 2 FROM d),
p AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a, b), 0) AS z FROM e),
k AS (SELECT doc_id, string_agg(substr(h, 2 * z + 1, 2 * (a - z)), '' ORDER BY a, b) AS kept FROM p JOIN d USING (doc_id) GROUP BY doc_id),
c AS (SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans FROM i GROUP BY doc_id)
SELECT doc_id, (len(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed,
       coalesce(n_spans, 0)::BIGINT AS n_spans, sha256(unhex(kept)) AS kept_sha256
FROM d JOIN k USING (doc_id) LEFT JOIN c USING (doc_id)
"""

OP5 = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (
  SELECT DISTINCT doc_id, list_slice(w, p, p + 4) AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS p FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM g a JOIN g b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM o JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE 100 * i >= 80 * (x.n + y.n - i)),
r AS (SELECT doc_id, doc_id AS c FROM w UNION SELECT e.b, r.c FROM r JOIN e ON e.a = r.doc_id)
SELECT r.doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, min(c) AS component_id
FROM r LEFT JOIN n ON r.doc_id = n.doc_id GROUP BY r.doc_id
"""

OP11 = r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS r,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents WHERE text IS NOT NULL),
n AS (SELECT doc_id, r, len(w)::BIGINT AS n FROM d WHERE len(w) > 0),
s AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS terms FROM n),
i AS (
  SELECT item_id, term, count(*)::BIGINT AS times FROM (
    SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark WHERE text IS NOT NULL) GROUP BY ALL),
t AS (
  SELECT r, term, count(*)::BIGINT AS tf FROM (SELECT r, unnest(w) AS term FROM d)
  WHERE term IN (SELECT term FROM i) GROUP BY ALL),
f AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS weight
      FROM t, s GROUP BY term, docs),
m AS (SELECT doc_id, r, 25 + (75 * n * docs) // terms AS m FROM n, s),
p AS (
  SELECT item_id, doc_id, r, sum(times * weight * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
  FROM i JOIN f USING (term) JOIN t USING (term) JOIN m USING (r) GROUP BY ALL)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score
FROM p WHERE score > 0 QUALIFY rank <= 10
"""

EXPECTED = {"op3_topk": OP3, "op4_suffix": OP4, "op5_jaccard": OP5, "op7_mix": OP7, "op10_decontaminate": OP10, "op11_search": OP11}
