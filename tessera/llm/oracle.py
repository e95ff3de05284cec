"""DuckDB SQL for the rows of the queries that SQL can express, written from their contracts alone."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORDS = (r"regexp_extract_all(translate(coalesce(text, ''), '%s', '%s'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')" % (_UPPER, _LOWER))

DECONTAMINATE = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
i AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark WHERE item_id IS NOT NULL),
win AS (SELECT DISTINCT item, n, array_to_string(w[p:p + n - 1], ' ') AS g
        FROM (SELECT item, w, n, unnest(range(1, len(w) - n + 2)) AS p
              FROM (SELECT item, w, least(13, len(w)) AS n FROM i WHERE len(w) > 0))),
places AS (SELECT doc_id, n, p, array_to_string(w[p:p + n - 1], ' ') AS g
           FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p
                 FROM d CROSS JOIN (SELECT DISTINCT n FROM win))),
occ AS (SELECT doc_id, n, p, item FROM places JOIN win USING (n, g)),
hit AS (SELECT doc_id, count(DISTINCT q) AS n_hit
        FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM (SELECT DISTINCT doc_id, n, p FROM occ)) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
        FROM (SELECT DISTINCT doc_id, item FROM occ) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN its USING (doc_id)
"""

EMBEDDINGS = """
WITH RECURSIVE v AS (
    SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS MATERIALIZED (SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
     WHERE list_cosine_similarity(a.e, b.e) >= 0.9),
reach AS (SELECT vec_id AS x, vec_id AS y FROM embeddings UNION SELECT r.x, l.y FROM reach r JOIN l ON r.y = l.x),
c AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x),
n AS (SELECT x, count(*) AS n_links FROM l GROUP BY x)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN c ON c.x = vec_id LEFT JOIN n ON n.x = vec_id
"""

REPEATS = """
WITH b AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
s AS (SELECT doc_id, p, md5(substr(h, 2 * p + 1, 200)) AS k
      FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2 - 99)) AS p FROM b)),
again AS (SELECT doc_id, p FROM (SELECT doc_id, p, row_number() OVER (PARTITION BY k ORDER BY doc_id, p) AS r FROM s) WHERE r > 1),
runs AS (SELECT doc_id, min(p) AS a, max(p) + 100 AS z
         FROM (SELECT doc_id, p, sum(new) OVER (PARTITION BY doc_id ORDER BY p) AS g
               FROM (SELECT doc_id, p, CASE WHEN p <= lag(p) OVER (PARTITION BY doc_id ORDER BY p) + 100 THEN 0 ELSE 1 END AS new
                     FROM again)) GROUP BY doc_id, g),
cut AS (SELECT doc_id, a, z, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY a), 0) AS e FROM runs),
gone AS (SELECT doc_id, sum(z - a) AS n_removed, count(*) AS n_spans, max(z) AS last,
                string_agg(substr(h, 2 * e + 1, 2 * (a - e)), '' ORDER BY a) AS head
         FROM cut JOIN b USING (doc_id) GROUP BY doc_id)
SELECT doc_id, len(h) // 2 AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(head, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM b LEFT JOIN gone USING (doc_id)
"""

FILTER_AUDIT = r"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
l AS (SELECT doc_id, max(CAST(quality = 1 AS INT)) AS good, max(CAST(toxic = 1 AS INT)) AS toxic FROM labels GROUP BY doc_id),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words, min(doc_id) OVER (PARTITION BY t) AS least FROM d),
f AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
             map(['A', 'B', 'C', 'D', 'E'],
                 [len(words) < 200, 100 * len(list_distinct(words)) < 50 * len(words),
                  100 * len(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * len(t), regexp_matches(t, '[#$%&*|]'),
                  coalesce(doc_id > least, false)]) AS fails
      FROM w LEFT JOIN l USING (doc_id)),
m AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY part, fails),
o AS (SELECT '' AS filter_order UNION ALL
      SELECT filter_order || x FROM o, (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x) WHERE NOT contains(filter_order, x)),
s AS (SELECT filter_order, step, substr(filter_order, step, 1) AS x, substr(filter_order, 1, step - 1) AS earlier
      FROM o, range(1, 6) AS r(step) WHERE length(filter_order) = 5),
c AS (SELECT part, filter_order, step, x, n, good, toxic, fails[x] AS failed,
             len(list_filter(string_split(earlier, ''), lambda y: y <> '' AND fails[y])) > 0 AS gone,
             len(list_filter(['A', 'B', 'C', 'D', 'E'], lambda y: fails[y])) AS n_fails
      FROM m, s),
r AS (SELECT part, filter_order, step, x, sum(n) FILTER (NOT failed AND NOT gone) AS kept, sum(n) FILTER (failed AND NOT gone) AS removed,
             sum(n) FILTER (failed AND gone) AS redundant, sum(n) FILTER (failed AND n_fails = 1) AS unique_fails,
             sum(good) FILTER (failed AND NOT gone) AS good_lost, sum(toxic) FILTER (failed AND NOT gone) AS toxic_lost
      FROM c GROUP BY part, filter_order, step, x)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(coalesce(kept, 0) AS BIGINT) AS kept,
       CAST(coalesce(removed, 0) AS BIGINT) AS removed, CAST(coalesce(redundant, 0) AS BIGINT) AS redundant,
       CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails, CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost,
       CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost,
       CAST(sum(coalesce(removed, 0)) OVER (PARTITION BY part, x) AS BIGINT) AS shapley
FROM r
"""

_TERMS = r"regexp_extract_all(%s, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

LEXICAL = f"""
WITH d AS (SELECT doc_id, translate(word, '{_UPPER}', '{_LOWER}') AS term
           FROM (SELECT doc_id, unnest({_TERMS % "text"}) AS word FROM documents)),
i AS (SELECT item_id, translate(word, '{_UPPER}', '{_LOWER}') AS term
      FROM (SELECT item_id, unnest({_TERMS % "text"}) AS word FROM benchmark)),
a AS (SELECT count(DISTINCT doc_id) AS n_docs, count(*) AS n_terms FROM d),
m AS (SELECT doc_id, 25 + (75 * count(*) * any_value(n_docs)) // any_value(n_terms) AS m FROM d, a GROUP BY doc_id),
q AS (SELECT item_id, term, count(*) AS times FROM i GROUP BY item_id, term),
p AS (SELECT doc_id, term, count(*) AS tf FROM d WHERE term IN (SELECT term FROM q) GROUP BY doc_id, term),
w AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(n_docs) + 2) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w FROM p, a GROUP BY term),
s AS (SELECT item_id, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
      FROM q JOIN p USING (term) JOIN w USING (term) JOIN m USING (doc_id) GROUP BY item_id, doc_id),
r AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
      FROM s WHERE score > 0)
SELECT * FROM r WHERE rank <= 10
"""

WARC = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, ''))) AS n FROM pages),
r AS (SELECT *, min(page_id) OVER (PARTITION BY html) AS least FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, sha256(html) AS payload_digest,
       CASE WHEN n >= 100 AND page_id <> least THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 100 AND page_id <> least THEN least END AS refers_to
FROM r
"""
