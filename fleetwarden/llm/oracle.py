"""DuckDB statements for the queries that SQL can express."""

ORACLE: dict[str, str] = {}

# The trimmed characters and the case rule are those of the contract.
ORACLE["op3_line_dedup"] = """
WITH split AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents
), line AS (
  SELECT doc_id, unnest(range(1, len(ls) + 1)) AS pos, unnest(ls) AS l FROM split
), keyed AS (
  SELECT doc_id, pos, l,
         translate(trim(l, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM line
), dup AS (
  SELECT k, max(doc_id) AS keeper FROM keyed WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3
), marked AS (
  SELECT a.doc_id, a.pos, a.l, d.k IS NOT NULL AND a.doc_id <> d.keeper AS gone FROM keyed a LEFT JOIN dup d ON a.k = d.k
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(l, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

ORACLE["op8_top_products"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0
), ranked AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
  FROM scored
)
SELECT * FROM ranked WHERE rank <= 20
"""

ORACLE["op1_url_lists"] = r"""
WITH page AS (
  SELECT page_id, url,
         rtrim(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]*)', 1)), '.') AS host,
         regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?[^/?#]*/([^/?#]+)', 1) AS part,
         DATE '2024-01-01' + (page_id * 7919 % 366)::INTEGER AS day
  FROM pages
), capture AS (
  SELECT *, CASE WHEN host = '' OR part = '' THEN '' ELSE host || '/' || part END AS section FROM page
), name AS (
  SELECT *, ('0x' || substr(md5(pattern), 1, 6))::INTEGER AS x FROM (
    SELECT DISTINCT 'host' AS kind, host AS pattern FROM capture
    UNION SELECT 'domain', regexp_extract(host, '^[^.]*\.(.*\..*)$', 1) FROM capture
    UNION SELECT 'section', section FROM capture
  ) WHERE pattern <> ''
), host_entry AS (
  SELECT 'hosts' || (x % 3) AS list, pattern, x, CASE WHEN x % 4 = 0 THEN 'allow' ELSE 'block' END AS verdict,
         DATE '2023-07-01' + x % 400 AS first, DATE '2023-07-01' + x % 400 + 30 + x % 90 AS second
  FROM name WHERE kind = 'host'
), entry AS (
  SELECT list, 'host' AS kind, pattern, verdict, 'add' AS action, first AS d FROM host_entry
  UNION ALL SELECT list, 'host', pattern, verdict, 'remove', second FROM host_entry
  UNION ALL SELECT list, 'host', pattern, 'block', 'add', second + 45 FROM host_entry WHERE x % 2 = 0
  UNION ALL SELECT 'domains', 'domain', pattern, 'block', 'add', DATE '2024-01-01' + x % 300 FROM name WHERE kind = 'domain'
  UNION ALL SELECT 'domains', 'domain', pattern, 'block', 'remove', DATE '2024-01-01' + x % 300 + x % 60 FROM name WHERE kind = 'domain'
  UNION ALL SELECT 'sections', 'section', pattern, CASE WHEN x % 2 = 0 THEN 'allow' ELSE 'block' END, 'add', DATE '2024-02-01' + x % 200
    FROM name WHERE kind = 'section' AND x % 5 = 0
), daily AS (
  SELECT list, kind, pattern, d, max(action) AS action, arg_max(verdict, (action, verdict)) AS verdict
  FROM entry GROUP BY ALL
), span AS (
  SELECT *, lead(d) OVER (PARTITION BY list, kind, pattern ORDER BY d) AS until FROM daily
), met AS (
  SELECT c.page_id, c.url, s.*,
         CASE s.kind WHEN 'section' THEN 2000 WHEN 'host' THEN 1000 ELSE len(string_split(s.pattern, '.')) END AS weight
  FROM capture c JOIN span s
    ON s.action = 'add' AND c.day >= s.d AND (s.until IS NULL OR c.day < s.until)
   AND ((s.kind = 'host' AND c.host = s.pattern) OR (s.kind = 'section' AND c.section = s.pattern)
        OR (s.kind = 'domain' AND (c.host = s.pattern OR c.host LIKE '%.' || s.pattern)))
), ranked AS (
  SELECT *, count(*) OVER (PARTITION BY page_id, url) AS n,
         row_number() OVER (PARTITION BY page_id, url ORDER BY weight DESC, verdict <> 'block', list) AS r
  FROM met
)
SELECT c.page_id, c.url, c.host, coalesce(m.verdict, 'none') AS decision, coalesce(m.n, 0) AS n_active,
       m.list, m.kind, m.pattern, m.d AS valid_from, m.until AS valid_to
FROM capture c LEFT JOIN ranked m ON m.page_id = c.page_id AND m.url = c.url AND m.r = 1
"""

ORACLE["op10_revisits"] = r"""
WITH page AS (
  SELECT page_id, url, md5(coalesce(html, '')) AS h, strlen(coalesce(html, '')) AS size,
         ('0x' || substr(md5(coalesce(url, '')), 1, 6))::INTEGER AS x,
         page_id * 131 % 5000 AS base,
         regexp_replace(regexp_replace(coalesce(url, ''), '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS bare
  FROM pages
), part AS (
  SELECT *,
         regexp_replace(regexp_replace(regexp_replace(lower(regexp_extract(bare, '^([^/?]*)', 1)), '^.*@', ''), ':(80|443)$', ''), '^www\.', '')
         || regexp_replace(regexp_extract(bare, '^[^/?]*([^?]*)', 1), '/+$', '') AS path,
         array_to_string(list_filter(string_split(regexp_extract(bare, '\?(.*)$', 1), '&'),
           lambda t: t <> '' AND NOT regexp_matches(t, '^(utm_[^=]*|fbclid|gclid)(=|$)')), '&') AS q
  FROM page
), keyed AS (
  SELECT *, path || CASE WHEN q <> '' THEN '?' || q ELSE '' END AS url_key, 'ETag: "' || substr(h, 1, 16) || '"' AS t0,
         'ETag: W/"' || substr(h, 17, 16) || '"' AS t1, 'Last-Modified: day ' || (page_id % 366) AS d0,
         'Last-Modified: day ' || ((page_id + 1) % 366) AS d1
  FROM part
), stored AS (
  SELECT url_key, page_id || '-0' AS record_id, base AS t, h AS digest, t0 AS tag, d0 AS date, size FROM keyed
  UNION ALL SELECT url_key, page_id || '-1', base + 100, md5(h || '1'), t1, d1, size FROM keyed WHERE x % 7 <> 0
), latest AS (
  SELECT url_key, t, max(record_id) AS record_id, arg_max(digest, record_id) AS digest, arg_max(tag, record_id) AS tag,
         arg_max(date, record_id) AS date, arg_max(size, record_id) AS size
  FROM stored GROUP BY url_key, t
), told AS (
  SELECT url_key, page_id, x, base,
         CASE WHEN x % 5 = 0 THEN NULL WHEN x % 5 = 1 THEN 'ETag: "other"' WHEN x % 5 = 2 THEN d0
              WHEN x % 150 <= 100 THEN t0 ELSE t1 END AS v
  FROM keyed
), revisit AS (
  SELECT url_key, page_id || '-2' AS record_id, base + x % 150 AS t, v FROM told
  UNION ALL SELECT url_key, page_id || '-3', base - x % 50, v FROM told
), found AS (
  SELECT r.*, s.record_id AS refers_to, s.digest, s.tag, s.date, s.size,
         coalesce(CASE WHEN v LIKE 'ETag: W/%' THEN replace(v, 'W/', '') = replace(s.tag, 'W/', '')
                       WHEN v LIKE 'ETag:%' THEN v = s.tag WHEN v IS NOT NULL THEN v = s.date ELSE FALSE END, FALSE) AS agree
  FROM revisit r ASOF LEFT JOIN latest s ON r.url_key = s.url_key AND r.t > s.t
)
SELECT record_id, url_key, CASE WHEN agree THEN 'resolved' WHEN refers_to IS NOT NULL THEN 'mismatch' ELSE 'orphan' END AS outcome,
       refers_to, CASE WHEN agree THEN digest END AS payload_digest,
       CASE WHEN agree THEN concat_ws(chr(13) || chr(10), 'Content-Type: text/html', 'Content-Length: ' || size,
              CASE WHEN v LIKE 'ETag%' THEN date ELSE tag END, 'Date: now', 'Cache-Control: max-age=3600', v)
            ELSE concat_ws(chr(13) || chr(10), 'Date: now', 'Cache-Control: max-age=3600', 'Content-Length: 0', 'Connection: close', v) END AS headers
FROM found
"""

ORACLE["op11_divergence"] = r"""
WITH doc AS (
  SELECT row_number() OVER () AS d, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source
  FROM documents
), word AS (
  SELECT d, lang, source, unnest(regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM doc
), kept AS (
  SELECT lang, term FROM word GROUP BY ALL HAVING count(DISTINCT d) >= 10
), grp AS (
  SELECT DISTINCT lang, source FROM doc
), found AS (
  SELECT w.lang, w.source, w.term, count(*) AS n FROM word w JOIN kept k ON w.lang = k.lang AND w.term = k.term GROUP BY ALL
), cell AS (
  SELECT g.lang, g.source, k.term, coalesce(f.n, 0)::HUGEINT AS n
  FROM grp g JOIN kept k ON g.lang = k.lang LEFT JOIN found f ON f.lang = g.lang AND f.source = g.source AND f.term = k.term
), share AS (
  SELECT *, 1 + 1000000000 * (n + 2) // (sum(n) OVER (PARTITION BY lang, source) + 2 * count(*) OVER (PARTITION BY lang, source)) AS p
  FROM cell
), whole AS (
  SELECT lang, term, 1 + 1000000000 * (n + 2) // (sum(n) OVER (PARTITION BY lang) + 2 * count(*) OVER (PARTITION BY lang)) AS q
  FROM (SELECT lang, term, sum(n) AS n FROM cell GROUP BY ALL)
), pair AS (
  SELECT a.lang, a.source, b.source AS item FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
), summed AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM share a JOIN share b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), part AS (
  SELECT p.lang, p.source, 'pair' AS part, p.item, coalesce(s.value, 0)::BIGINT AS value
  FROM pair p LEFT JOIN summed s ON p.lang = s.lang AND p.source = s.source AND p.item = s.item
  UNION ALL
  SELECT s.lang, s.source, 'term', s.term, ((p - q) * (p - q) // (p + q))::BIGINT
  FROM share s JOIN whole w ON s.lang = w.lang AND s.term = w.term WHERE n > 0 AND p > q
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM part
)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 10
"""

ORACLE["op12_hard_negatives"] = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same, list_inner_product(a.e, r.e)::BIGINT AS score
  FROM v a JOIN v r ON a.vec_id <> r.vec_id WHERE a.vec_id % 100 = 0
), positive AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM positive JOIN scored USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""
