-- name: paged_source_replay
SELECT query_ord, page_no, pos, place_id FROM fx_replayed

-- name: first_seen_dedupe
SELECT place_id, query_ord, page_no, pos FROM fx_found

-- name: discovery_target
SELECT place_id, query_ord, page_no, pos FROM fx_found ORDER BY query_ord, page_no, pos, place_id LIMIT 200

-- name: flatten_place_json
SELECT * FROM fx_places

-- name: page_sample_report
WITH g AS (SELECT * FROM fx_listings WHERE NOT failed),
t AS (SELECT query_ord, page_no, count(*) AS returned, bool_or(has_next) AS has_next_page_token FROM g GROUP BY query_ord, page_no)
SELECT g.query_ord, g.page_no, pos, returned, has_next_page_token, name, website_uri AS website, primary_type, rating, price_level
FROM g JOIN t ON g.query_ord = t.query_ord AND g.page_no = t.page_no WHERE pos < 5

-- name: param_list_split
WITH s AS (SELECT doc_id, CASE WHEN trim(lang) = '' OR lang IS NULL THEN 'AUD' ELSE trim(lang) END AS currency,
                  list_filter(list_transform(string_split(text, ','), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')),
                              lambda x: x <> '') AS parts FROM documents)
SELECT doc_id, currency, CAST(generate_subscripts(parts, 1) - 1 AS INTEGER) AS query_ord, unnest(parts) AS search_query FROM s

-- name: first_non_empty
SELECT place_id, coalesce(nullif(website_uri, ''), nullif(phone, ''), nullif(opening_hours, ''), nullif(name, '')) AS first_value
FROM fx_places

-- name: html_visible_text
SELECT page_id, visible_text FROM fx_text

-- name: html_links
SELECT site_url, pos, href, text FROM fx_links

-- name: resolve_links
SELECT site_url, pos, href, regexp_extract(site_url, '^(https?://[^/?#]+)', 1) || href AS url FROM fx_links
UNION ALL SELECT site_url, pos, href, url FROM fx_shaped

-- name: same_site_links
SELECT site_url, pos, url FROM (
  SELECT site_url, pos, regexp_extract(site_url, '^(https?://[^/?#]+)', 1) || href AS url FROM fx_links
  UNION ALL SELECT site_url, pos, url FROM fx_shaped)
WHERE regexp_extract(url, '^([a-z]+)://', 1) IN ('http', 'https')
  AND regexp_extract(url, '://([^/?#]*)', 1) = regexp_extract(site_url, '://([^/?#]*)', 1)

-- name: hint_match
SELECT doc_id,
  regexp_matches(lower(text), 'menu|menus|dinner|lunch|drinks|food|carte|(^|[^\p{L}\p{N}_])eat($|[^\p{L}\p{N}_])') AS default_hints,
  regexp_matches(lower(text), 'the|tion|en|(^|[^\p{L}\p{N}_])and($|[^\p{L}\p{N}_])') AS test_hints,
  regexp_matches(lower(text), 'zz|(^|[^\p{L}\p{N}_])and($|[^\p{L}\p{N}_])') AS whole_word
FROM documents

-- name: link_candidates_top3
SELECT site_url, rank, url, score FROM fx_candidates

-- name: slugify_url
SELECT page_id, substr(url_encode(url), 1, 120) AS slug FROM pages

-- name: truncate_text
SELECT doc_id, substr(text, 1, 20000) AS text_20000, substr(text, 1, 160) AS note_160 FROM documents

-- name: bytes_to_text
SELECT page_id, html AS from_broken, html AS from_valid FROM pages

-- name: fetch_queue
SELECT discovery_rank, place_id, website_uri FROM fx_places WHERE coalesce(website_uri, '') <> '' ORDER BY discovery_rank LIMIT 200

-- name: robots_rule_join
SELECT url, robots_url, robots_allowed FROM fx_allowed WHERE url IN (SELECT url FROM pages)

-- name: first_success
SELECT site_url, rank, url, kind, content_type, n_chars FROM fx_best

-- name: fetch_log_rows
SELECT content_type, http_status, count(*) AS n_rows, CAST(sum(octet_length(encode(content))) AS BIGINT) AS n_bytes FROM fx_log
GROUP BY content_type, http_status

-- name: robots_answers
WITH u AS (SELECT page_id, url, regexp_extract(url, '^(https?://[^/?#]+)', 1) AS root FROM pages),
a AS (SELECT root, min(CASE page_id % 5 WHEN 0 THEN 401 WHEN 1 THEN 503 WHEN 2 THEN 404 END) AS code FROM u GROUP BY root)
SELECT url, u.root || '/robots.txt' AS robots_url, coalesce(code NOT IN (401, 503), true) AS robots_allowed
FROM (SELECT DISTINCT url, root FROM u) u JOIN a ON u.root = a.root

-- name: fetch_outcome
SELECT * FROM fx_docs

-- name: fetch_yield
SELECT count(*) AS documents, count(CASE WHEN doc_type IN ('html', 'pdf') THEN 1 END) AS with_source FROM fx_docs

-- name: raw_object_path
SELECT 'p' || page_id AS place_id, 'menu_' || substr(url_encode(url), 1, 120) || '.html' AS filename,
       'raw/p' || page_id || '/menu_' || substr(url_encode(url), 1, 120) || '.html' AS stored_path,
       CAST(least(octet_length(encode(html)), 3000000) AS INTEGER) AS n_bytes FROM pages

-- name: join_on_path_key
SELECT CAST(page_id AS VARCHAR) AS place_id, url AS source_url, text AS source_text FROM pages JOIN documents ON doc_id = page_id

-- name: source_text_union
SELECT * FROM (
  SELECT place_id, source_url, raw_text AS source_text FROM fx_docs WHERE doc_type = 'html'
  UNION ALL
  SELECT place_id, source_url, substr(CAST(to_json({'text': content}) AS VARCHAR), 1, 20000)
  FROM fx_docs JOIN fx_log ON source_url = url WHERE doc_type = 'pdf')
WHERE length(source_text) > 1000

-- name: document_text_job
SELECT 'raw/p' || doc_id AS path, substr(CAST(to_json({'text': text}) AS VARCHAR), 1, 20000) AS source_text,
       CAST(NULL AS VARCHAR) AS error FROM documents

-- name: prompt_build
SELECT 'p' || doc_id AS place_id, :prompt || text AS prompt FROM documents

-- name: extraction_job
WITH t AS (
  SELECT 'p' || doc_id AS place_id, source AS source_url, text FROM documents
  UNION ALL
  SELECT 'p' || l_partkey, 'http://line/' || l_orderkey, CASE WHEN l_linenumber % 5 = 4 THEN p_name || ' on request'
    ELSE 'today ' || p_name || ' $' || printf('%.2f', l_extendedprice) || ' or ' || lower(p_type) || '  ' || printf('%.2f', l_extendedprice) END
  FROM lineitem JOIN part ON l_partkey = p_partkey
), a AS (
  SELECT place_id, source_url, CASE WHEN length(:prompt || text) % 11 = 3 THEN 'ValueError: refused' END AS error,
    regexp_extract_all(text, '((?:[A-Za-z]+ ){0,3}[A-Za-z]+)\s+\$?([0-9]+\.[0-9]{2})', 1) AS names,
    regexp_extract_all(text, '((?:[A-Za-z]+ ){0,3}[A-Za-z]+)\s+\$?([0-9]+\.[0-9]{2})', 2) AS prices
  FROM t
)
SELECT place_id, source_url, error, unnest(names) AS item_name, CAST(unnest(prices) AS DOUBLE) AS price
FROM a WHERE error IS NULL AND len(names) > 0
UNION ALL
SELECT place_id, source_url, error, NULL, NULL FROM a WHERE error IS NOT NULL OR coalesce(len(names), 0) = 0

-- name: response_json_build
SELECT place_id, CAST(CASE WHEN website_uri IS NULL
    THEN to_json({'place_id': place_id, 'name': name, 'formatted_address': formatted_address, 'user_rating_count': user_rating_count})
    ELSE to_json({'place_id': place_id, 'name': name, 'formatted_address': formatted_address, 'website_uri': website_uri,
                  'user_rating_count': user_rating_count}) END AS VARCHAR) AS place_json
FROM fx_places

-- name: response_parse_quality
WITH r AS (SELECT round(l_discount * 100) AS pct FROM lineitem JOIN part ON l_partkey = p_partkey),
c AS (SELECT count(*) AS responses, count(CASE WHEN pct = 9 THEN 1 END) AS null_responses,
             count(CASE WHEN pct = 10 THEN 1 END) AS unreadable_responses, count(CASE WHEN pct = 8 THEN 1 END) AS empty_responses FROM r),
i AS (SELECT count(*) AS items, count(*) - count(section) AS items_without_section, count(*) - count(item_name) AS items_without_name,
             count(*) - count(description) AS items_without_description, count(*) - count(price) AS items_without_price FROM fx_raw_items)
SELECT * FROM c, i

-- name: items_clean_dedupe
SELECT place_id, section, item_name, description, price, source_url FROM fx_items

-- name: items_from_responses
SELECT *, '2024-01-01 00:00:00' AS extracted_at FROM fx_items

-- name: empty_items_contract
SELECT place_id, currency, count(*) AS n_items FROM (SELECT * FROM fx_items WHERE false UNION ALL SELECT * FROM fx_items)
GROUP BY place_id, currency

-- name: items_per_place
SELECT place_id, count(*) AS n_items FROM fx_items GROUP BY place_id

-- name: doc_flags
SELECT place_id, bool_or(doc_type IN ('html', 'pdf')) AS has_source, bool_or(doc_type = 'robots_blocked') AS was_blocked,
       bool_or(doc_type = 'fetch_failed') AS has_failed
FROM fx_docs GROUP BY place_id

-- name: place_status
SELECT * FROM fx_catalogue

-- name: not_attempted_anti
SELECT place_id, website_uri FROM fx_places p
WHERE website_uri IS NOT NULL AND NOT EXISTS (SELECT 1 FROM fx_docs d WHERE d.place_id = p.place_id)

-- name: status_breakdown
SELECT menu_status, count(*) AS restaurants, CAST(sum(menu_item_count) AS BIGINT) AS total_items
FROM fx_catalogue GROUP BY menu_status

-- name: run_summary
WITH b AS (SELECT menu_status, count(*) AS n FROM fx_catalogue GROUP BY menu_status)
SELECT (SELECT count(*) FROM fx_catalogue) AS restaurants,
       (SELECT count(*) FROM fx_catalogue WHERE website_uri IS NOT NULL) AS with_website,
       (SELECT count(*) FROM fx_items) AS menu_items,
       (SELECT count(*) FROM fx_catalogue WHERE menu_status = 'menu_extracted') AS restaurants_with_menu,
       (SELECT '{' || string_agg('"' || menu_status || '":' || n, ',' ORDER BY menu_status) || '}' FROM b) AS status_breakdown

-- name: priced_items_join
SELECT name, section, item_name, price, currency FROM fx_places JOIN fx_items USING (place_id) WHERE price IS NOT NULL

-- name: menu_sample_top50
SELECT name, rating, section, item_name, price, currency FROM fx_places JOIN fx_items USING (place_id)
ORDER BY name, place_id, section NULLS FIRST, item_name, description, price NULLS FIRST LIMIT 50

-- name: table_roundtrip
SELECT * FROM fx_places

-- name: upsert_by_key
SELECT c_custkey AS k, c_name AS name, c_acctbal AS balance FROM customer WHERE c_custkey NOT IN (SELECT s_suppkey FROM supplier)
UNION ALL SELECT s_suppkey, s_name, s_acctbal FROM supplier

-- name: search_query_order
SELECT 'query ' || query_ord AS search_query, CAST(199 - query_ord AS BIGINT) AS query_ord, count(*) AS n_rows, max(page_no) AS last_page
FROM fx_listings WHERE query_ord < 200 GROUP BY ALL

-- name: latest_attempts
WITH l AS (SELECT url, length(url) % 5 AS kind, http_status, error, content_type, octet_length(encode(content)) AS n_bytes FROM fx_log),
t AS (
  SELECT url, CASE kind WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 1 WHEN 3 THEN 2 ELSE 3 END AS attempt_no, http_status, error, content_type, n_bytes FROM l
  UNION ALL SELECT url, 1, NULL, 'URLError: timed out', content_type, NULL FROM l WHERE kind IN (1, 4)
  UNION ALL SELECT url, 2, 503, 'HTTP Error 503: Service Unavailable', content_type, NULL FROM l WHERE kind = 2
  UNION ALL SELECT url, 1, 200, NULL, content_type, octet_length(encode('older ' || url)) FROM l WHERE kind = 3
)
SELECT url, attempt_no, http_status, error, content_type, n_bytes FROM t
QUALIFY row_number() OVER (PARTITION BY url ORDER BY error IS NULL AND http_status < 400 DESC, attempt_no DESC) = 1

-- name: response_rejects
WITH l AS (SELECT 'p' || l_partkey AS place_id, 'http://line/' || l_linestatus AS source_url, round(l_discount * 100) AS pct, l_tax, p_size,
                  l_returnflag FROM lineitem JOIN part ON l_partkey = p_partkey),
i AS (SELECT *, 0 AS pos FROM l WHERE pct <= 7 UNION ALL SELECT *, 1 FROM l WHERE pct < 7)
SELECT place_id, source_url, CAST(NULL AS INTEGER) AS pos, CASE pct WHEN 9 THEN 'no answer' ELSE 'no JSON' END AS rule FROM l WHERE pct >= 9
UNION ALL SELECT place_id, source_url, pos, 'section missing' FROM i WHERE pos = 1
UNION ALL SELECT place_id, source_url, pos, 'item_name missing' FROM i WHERE p_size <= 25
UNION ALL SELECT place_id, source_url, pos, 'description missing' FROM i WHERE l_returnflag IS NULL
UNION ALL SELECT place_id, source_url, pos, 'price missing' FROM i WHERE pos = 0 AND pct < 7 AND l_tax = 0
UNION ALL SELECT place_id, source_url, pos, 'price is no number' FROM i WHERE pct = 7

-- name: upsert_run
SELECT place_id, section, item_name, description, price, source_url, currency FROM fx_items
WHERE CAST(substr(place_id, 2) AS BIGINT) NOT IN (SELECT p_partkey FROM part WHERE p_partkey % 3 = 0)
UNION ALL
SELECT place_id, section, item_name, description, price + 1, source_url, currency FROM fx_items
WHERE CAST(substr(place_id, 2) AS BIGINT) % 3 = 0 AND CAST(substr(place_id, 2) AS BIGINT) % 2 = 0

-- name: binary_docs_scan
SELECT regexp_extract(filename, '([^/]+)$', 1) AS filename, size AS length, octet_length(content) AS n_read,
       sha256(content) AS content_sha256
FROM read_blob(:folder)

-- name: status_from_buckets
SELECT * FROM fx_catalogue
