-- name: fx_places
SELECT c_custkey AS discovery_rank, 'p' || c_custkey AS place_id, c_name AS name,
       n_name || ', ' || r_name AS formatted_address,
       CAST(n_nationkey AS DOUBLE) AS latitude, CAST(n_regionkey AS DOUBLE) AS longitude,
       lower(c_mktsegment) AS primary_type, lower(c_mktsegment) || ',' || lower(n_name) AS types,
       c_acctbal AS rating, CAST(n_nationkey AS BIGINT) AS user_rating_count, c_mktsegment AS price_level,
       CASE WHEN url IS NOT NULL AND c_acctbal < 0 THEN '' ELSE url END AS website_uri,
       CASE WHEN c_mktsegment <> 'MACHINERY' THEN '+' || c_custkey END AS phone,
       CASE WHEN c_mktsegment <> 'FURNITURE' THEN 'Mon: ' || n_name || ' | Tue: closed' END AS opening_hours,
       'OPERATIONAL' AS business_status
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey
     LEFT JOIN pages ON c_custkey = page_id

-- name: fx_listings
WITH l AS (SELECT discovery_rank AS a, 0 AS f, * FROM fx_places
           UNION ALL SELECT discovery_rank + 35, 10, * FROM fx_places)
SELECT a // 50 AS query_ord, (a % 50) // 10 AS page_no, a % 10 + f AS pos,
       rating < -950 AS failed, NOT ((a % 50) // 10 = 4 OR ((a % 50) // 10 = 1 AND (a // 50) % 11 = 3)) AS has_next,
       CASE WHEN rating BETWEEN -950 AND -900 THEN NULL WHEN rating BETWEEN -900 AND -850 THEN '' ELSE place_id END AS id,
       * FROM l

-- name: fx_replayed
WITH e AS (SELECT query_ord, min(CASE WHEN failed THEN page_no END) AS bad, min(CASE WHEN NOT has_next THEN page_no END) AS last
           FROM fx_listings WHERE page_no < 3 GROUP BY query_ord)
SELECT l.query_ord, l.page_no, l.pos, l.id AS place_id FROM fx_listings l JOIN e ON l.query_ord = e.query_ord
WHERE l.page_no < 3 AND (bad IS NULL OR l.page_no < bad) AND (last IS NULL OR l.page_no <= last)

-- name: fx_found
SELECT place_id, query_ord, page_no, pos FROM (
  SELECT *, row_number() OVER (PARTITION BY place_id ORDER BY query_ord, page_no, pos) AS seen
  FROM fx_replayed WHERE place_id <> '') WHERE seen = 1

-- name: fx_seen
SELECT page_id, url, regexp_replace(html,
  '(?is)<!--.*?-->|<script\b[^>]*>.*?</script\s*>|<style\b[^>]*>.*?</style\s*>|<noscript\b[^>]*>.*?</noscript\s*>|<svg\b[^>]*>.*?</svg\s*>',
  chr(1), 'g') AS seen
FROM pages

-- name: fx_text
SELECT page_id, url, array_to_string(list_filter(list_transform(
    -- These names count without their semicolon too: some titles are cut right before it.
    string_split(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(seen, '(?s)<[^>]*>', chr(1), 'g'),
      '&quot;?', '"', 'g'), '&copy;?', '©', 'g'), '&middot;?', '·', 'g'), '&amp;?', '&', 'g'), chr(1)),
    lambda n: regexp_replace(n, '^\s+|\s+$', '', 'g')), lambda n: n <> ''), ' ') AS visible_text
FROM fx_seen

-- name: fx_links
WITH a AS (SELECT url, regexp_extract_all(seen, '(?is)<a\s[^>]*href="([^"]*)"[^>]*>([^<]*)</a>', 1) AS h,
                  regexp_extract_all(seen, '(?is)<a\s[^>]*href="([^"]*)"[^>]*>([^<]*)</a>', 2) AS t FROM fx_seen),
z AS (SELECT url, list_filter(list_transform(generate_series(1, len(h)), lambda i: {'href': h[i], 'text': trim(
             replace(replace(replace(replace(t[i], '&quot;', '"'), '&copy;', '©'), '&middot;', '·'), '&amp;', '&'))}),
             lambda l: l.href <> '' AND l.text <> '') AS links FROM a)
SELECT site_url, CAST(pos AS INTEGER) AS pos, l.href AS href, l.text AS text
FROM (SELECT url AS site_url, unnest(links) AS l, generate_subscripts(links, 1) - 1 AS pos FROM z)

-- name: fx_doc_links
SELECT doc_id, p.page_id, h AS href, label, coalesce(regexp_extract(p.url, '^(https?://[^/?#]+)', 1), 'http://nosite.example.com') || h AS url
FROM (SELECT doc_id, doc_id // 4 AS k, '/doc/' || doc_id || CASE WHEN doc_id % 7 = 0 THEN '.pdf' ELSE '.html' END AS h,
             CASE WHEN doc_id % 3 = 1 THEN 'paper ' ELSE 'the text ' END || doc_id AS label FROM documents)
     LEFT JOIN pages p ON p.page_id = k

-- name: fx_page_docs
SELECT page_id, count(*) AS n, string_agg(label, ' ' ORDER BY doc_id) AS labels,
       string_agg('<a href="' || href || '">' || label || '</a>', '' ORDER BY doc_id) AS html FROM fx_doc_links GROUP BY page_id

-- name: fx_home_links
SELECT p.url AS site_url, row_number() OVER (PARTITION BY p.page_id ORDER BY doc_id) - 1 AS pos, href, label AS text
FROM fx_doc_links d JOIN pages p ON d.page_id = p.page_id
UNION ALL
SELECT site_url, pos + coalesce(n, 0), href, text
FROM fx_links JOIN pages p ON p.url = site_url LEFT JOIN fx_page_docs d ON d.page_id = p.page_id

-- name: fx_scored
SELECT *, CASE WHEN pdf AND strong THEN 0 WHEN strong THEN 1 ELSE 2 END AS score FROM (
  SELECT site_url, pos, url, split_part(lower(url), '?', 1) LIKE '%.pdf' AS pdf, contains(blob, 'the') AS strong,
         regexp_matches(blob, 'the|tion|en') OR regexp_matches(blob, '(^|[^\p{L}\p{N}_])and($|[^\p{L}\p{N}_])') AS hinted
  FROM (SELECT *, regexp_extract(site_url, '^(https?://[^/?#]+)', 1) || href AS url, lower(href || ' ' || text) AS blob
        FROM fx_home_links))
WHERE hinted OR pdf

-- name: fx_candidates
SELECT site_url, CAST(rank AS INTEGER) AS rank, url, CAST(score AS INTEGER) AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY site_url ORDER BY score, pos) AS rank FROM (
    SELECT *, row_number() OVER (PARTITION BY site_url, url ORDER BY pos) AS seen FROM fx_scored) WHERE seen = 1)
WHERE rank <= 3

-- name: fx_log
SELECT p.url, CASE WHEN regexp_matches(p.url, 'cheap-pills|free-bets|casino-win') THEN 403
                   WHEN p.url LIKE '%.html' THEN NULL ELSE 200 END AS http_status,
       CASE WHEN regexp_matches(p.url, 'cheap-pills|free-bets|casino-win') THEN 'HTTP Error 403: Forbidden'
            WHEN p.url LIKE '%.html' THEN 'URLError: timed out' END AS error,
       'text/html' AS content_type, concat_ws(' ', labels, nullif(visible_text, '')) AS text,
       coalesce(d.html, '') || p.html AS content
FROM pages p JOIN fx_text t ON p.page_id = t.page_id LEFT JOIN fx_page_docs d ON d.page_id = p.page_id
UNION ALL
SELECT url, CASE WHEN lang = 'de' THEN NULL ELSE 200 END, CASE WHEN lang = 'de' THEN 'URLError: timed out' END,
       CASE WHEN source IN ('src0', 'src1', 'src2', 'src3') THEN 'application/pdf'
            WHEN source IN ('src4', 'src5') THEN 'image/png' WHEN source = 'src6' THEN '' ELSE 'text/html' END,
       regexp_replace(coalesce(text, ''), '^\s+|\s+$', '', 'g'), '<html><body><p>' || coalesce(text, '') || '</p></body></html>'
FROM fx_doc_links d JOIN documents ON d.doc_id = documents.doc_id

-- name: fx_rules
WITH s AS (SELECT DISTINCT regexp_extract(url, '^(https?://[^/?#]+)', 1) AS root FROM pages),
w(hosts, group_ord, agent, rule_ord, path_prefix, allow) AS (VALUES
  ('%', 0, 'otherbot', 1, '/', false),
  ('m.%', 1, '*', 1, '/en/2', true), ('m.%', 1, '*', 2, '/en/', false),
  ('th%', 1, '*', 1, '/fr', false), ('th%', 1, '*', 2, '/fr/', true), ('th%', 1, '*', 3, '/The', false),
  ('th%', 1, '*', 4, '/doc/1', false),
  ('blog.%', 1, '*', 1, '/', false), ('blog.%', 2, 'Placefolio', 1, '/de/', false), ('blog.%', 2, 'Placefolio', 2, '/es/', true))
SELECT root, group_ord, agent, rule_ord, path_prefix, allow FROM s JOIN w ON regexp_extract(root, '://(.*)$', 1) LIKE hosts

-- name: fx_allowed
WITH u AS (SELECT url, regexp_extract(url, '^(https?://[^/?#]+)', 1) AS root,
                  regexp_replace(url, '^https?://[^/?#]*', '') AS target
           FROM (SELECT url FROM pages UNION SELECT url FROM fx_candidates)),
g AS (SELECT root, agent, group_ord FROM (
        SELECT *, row_number() OVER (PARTITION BY root ORDER BY agent = '*', group_ord) AS n FROM fx_rules
        WHERE agent = '*' OR contains('placefolio', lower(agent))) WHERE n = 1),
m AS (SELECT u.url, r.allow, row_number() OVER (PARTITION BY u.url ORDER BY r.rule_ord) AS n
      FROM u JOIN g ON u.root = g.root JOIN fx_rules r ON r.root = g.root AND r.group_ord = g.group_ord
      WHERE starts_with(target, path_prefix))
SELECT u.url, u.root || '/robots.txt' AS robots_url, coalesce(m.allow, true) AS robots_allowed
FROM u LEFT JOIN m ON u.url = m.url AND m.n = 1

-- name: fx_best
SELECT site_url, rank, url, kind, http_status, content_type, text, CASE WHEN kind = 'html' THEN n_chars END AS n_chars FROM (
  SELECT *, row_number() OVER (PARTITION BY site_url ORDER BY rank) AS n FROM (
    SELECT c.site_url, c.rank, c.url, l.http_status, l.content_type, substr(l.text, 1, 20000) AS text, length(l.text) AS n_chars,
           CASE WHEN l.content_type LIKE '%pdf%' OR split_part(lower(c.url), '?', 1) LIKE '%.pdf' THEN 'pdf'
                WHEN (l.content_type LIKE '%html%' OR l.content_type = '') AND length(l.text) > 1000 THEN 'html' END AS kind
    FROM fx_candidates c JOIN fx_log l ON c.url = l.url JOIN fx_allowed a ON a.url = c.url
         JOIN fx_log home ON home.url = c.site_url
    WHERE a.robots_allowed AND l.http_status < 400 AND l.error IS NULL AND home.http_status < 400 AND home.error IS NULL
          AND c.site_url IN (SELECT website_uri FROM fx_places)) WHERE kind IS NOT NULL)
WHERE n = 1

-- name: fx_docs
SELECT place_id, coalesce(source_url, website_uri) AS source_url, doc_type, CAST(http_status AS INTEGER) AS http_status,
       content_type, stored_path, raw_text, robots_allowed, note FROM (
  SELECT p.place_id, p.website_uri, CASE WHEN a.robots_allowed AND h.error IS NULL THEN b.url END AS source_url,
    CASE WHEN NOT a.robots_allowed THEN 'robots_blocked' WHEN h.error IS NOT NULL THEN 'fetch_failed'
         WHEN b.kind IS NOT NULL THEN b.kind WHEN length(h.text) > 1000 THEN 'html' ELSE 'none' END AS doc_type,
    CASE WHEN a.robots_allowed THEN CASE WHEN h.error IS NULL AND b.kind IS NOT NULL THEN b.http_status ELSE h.http_status END END AS http_status,
    CASE WHEN a.robots_allowed AND h.error IS NULL THEN coalesce(b.content_type, h.content_type) END AS content_type,
    CASE WHEN NOT a.robots_allowed OR h.error IS NOT NULL THEN NULL
         WHEN b.kind IS NOT NULL THEN 'raw/' || p.place_id || '/menu_' || substr(url_encode(b.url), 1, 120) || '.' || b.kind
         WHEN length(h.text) > 1000 THEN 'raw/' || p.place_id || '/homepage.html' END AS stored_path,
    CASE WHEN NOT a.robots_allowed OR h.error IS NOT NULL THEN NULL WHEN b.kind = 'html' THEN b.text
         WHEN b.kind IS NULL AND length(h.text) > 1000 THEN substr(h.text, 1, 20000) END AS raw_text,
    a.robots_allowed,
    CASE WHEN NOT a.robots_allowed THEN 'homepage disallowed' WHEN h.error IS NOT NULL THEN h.error
         WHEN b.kind IS NOT NULL THEN NULL WHEN length(h.text) > 1000 THEN 'homepage fallback'
         ELSE 'no menu link / thin homepage (likely JS widget)' END AS note
  FROM fx_places p JOIN fx_allowed a ON a.url = p.website_uri JOIN fx_log h ON h.url = p.website_uri
       LEFT JOIN fx_best b ON b.site_url = p.website_uri
  WHERE p.website_uri <> '')

-- name: fx_raw_items
WITH l AS (SELECT 'p' || l_partkey AS place_id, 'http://line/' || l_linestatus AS source_url, p_type, l_returnflag AS description,
                  l_quantity, l_tax, round(l_discount * 100) AS pct,
                  CASE WHEN p_size <= 25 THEN NULL WHEN p_size <= 28 THEN '  ' ELSE p_name END AS item_name
           FROM lineitem JOIN part ON l_partkey = p_partkey)
SELECT place_id, source_url, p_type AS section, item_name, description,
       CASE WHEN pct = 7 OR l_tax = 0 THEN NULL ELSE l_quantity END AS price FROM l WHERE pct <= 7
UNION ALL SELECT place_id, source_url, NULL, item_name, description, l_quantity FROM l WHERE pct < 7

-- name: fx_items
SELECT place_id, section, item_name, description, price, min(source_url) AS source_url, 'AUD' AS currency
FROM fx_raw_items WHERE item_name IS NOT NULL AND length(trim(item_name)) > 0
GROUP BY place_id, section, item_name, description, price

-- name: fx_catalogue
WITH votes(place_id, rank, status) AS (
  SELECT place_id, 1, 'no_website' FROM fx_places WHERE website_uri IS NULL
  UNION ALL SELECT place_id, 2, 'menu_extracted' FROM fx_items
  UNION ALL SELECT place_id, 3, 'not_attempted' FROM fx_places WHERE place_id NOT IN (SELECT place_id FROM fx_docs)
  UNION ALL SELECT place_id, 4, 'source_found_no_items' FROM fx_docs WHERE doc_type IN ('html', 'pdf')
  UNION ALL SELECT place_id, 5, doc_type FROM fx_docs WHERE doc_type = 'robots_blocked'
  UNION ALL SELECT place_id, 6, doc_type FROM fx_docs WHERE doc_type = 'fetch_failed'
  UNION ALL SELECT place_id, 7, 'no_menu_found' FROM fx_docs)
SELECT p.*, v.menu_status, v.menu_item_count FROM fx_places p JOIN (
  SELECT place_id, arg_min(status, rank) AS menu_status, count(*) FILTER (WHERE rank = 2) AS menu_item_count
  FROM votes GROUP BY place_id) v ON p.place_id = v.place_id

-- name: fx_shaped
WITH u AS (SELECT url, regexp_extract(url, '^(https?://[^/?#]+)', 1) AS root, regexp_extract(url, '^([^?#]*)', 1) AS bare,
                  regexp_extract(url, '^([^#]*)', 1) AS nofrag, regexp_extract(url, '^https?://[^/?#]+([^?#]*)', 1) AS path FROM pages),
f AS (SELECT *, regexp_extract(path, '^(.*/)', 1) AS folder FROM u)
SELECT url AS site_url, 0 AS pos, url AS href, url AS url FROM f
UNION ALL SELECT url, 1, regexp_replace(url, '^https?://', 'ftp://'), regexp_replace(url, '^https?://', 'ftp://') FROM f
UNION ALL SELECT url, 2, upper(url), regexp_replace(regexp_replace(upper(url), '^HTTP://', 'http://'), '^HTTPS://', 'https://') FROM f
UNION ALL SELECT url, 3, regexp_replace(url, '(example.[a-z]+)', '\1:8080'), regexp_replace(url, '(example.[a-z]+)', '\1:8080') FROM f
UNION ALL SELECT url, 4, 'mailto:hello@example.com', 'mailto:hello@example.com' FROM f
UNION ALL SELECT url, 5, '//other.example.com/a', regexp_extract(url, '^(https?:)', 1) || '//other.example.com/a' FROM f
UNION ALL SELECT url, 6, '?page=9', bare || '?page=9' FROM f
UNION ALL SELECT url, 7, '#part', nofrag || '#part' FROM f
UNION ALL SELECT url, 8, 'list/today.html', root || folder || 'list/today.html' FROM f
UNION ALL SELECT url, 9, '../up', root || regexp_replace(folder, '[^/]+/$', '') || 'up' FROM f
UNION ALL SELECT url, 10, '/a/./b/../c.pdf', root || '/a/c.pdf' FROM f
