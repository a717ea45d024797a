-- name: op1_exact_dedup
WITH d AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents
)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = min(doc_id) OVER g AS kept, text_sha256
FROM d WINDOW g AS (PARTITION BY text_sha256)

-- name: op2_minhash_near_dedup
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS words
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) >= 5
                                 THEN list_transform(range(1, len(words) - 3), lambda i: hash(list_aggregate(words[i:i + 4], 'string_agg', ' ')))
                                 WHEN len(words) > 0 THEN [hash(list_aggregate(words, 'string_agg', ' '))] ELSE [] END) AS shingle
  FROM w
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), links AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM s a JOIN s b USING (shingle) JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
  WHERE a.doc_id <> b.doc_id AND 100 * least(na.n, nb.n) >= 85 * greatest(na.n, nb.n)
  GROUP BY a.doc_id, b.doc_id, na.n, nb.n HAVING 100 * count(*) >= 85 * (na.n + nb.n - count(*))
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION
  SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b
), c AS (
  SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a
)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents d JOIN c USING (doc_id) LEFT JOIN n USING (doc_id)

-- name: op6_source_mixing
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         ('0x' || substr(md5('mix-1:' || coalesce(doc_id::VARCHAR, '')), 1, 12))::BIGINT AS u
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source
), w AS (
  SELECT *, ([5.0, 2.0, 1.0]::DOUBLE[])[((row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3)::INT + 1] AS weight,
         (source_size * 3)::DOUBLE AS cap FROM s
), l AS (
  SELECT *, cap / weight AS full_at,
         (sum(source_size) OVER () - coalesce(sum(cap) OVER o, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER o, 0)) AS level
  FROM w WINDOW o AS (ORDER BY cap / weight, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), t AS (
  SELECT source, source_size, CASE WHEN full_at <= lv THEN cap ELSE weight * lv END AS target
  FROM l, (SELECT arg_min(level, full_at) AS lv FROM l WHERE level <= full_at)
), r AS (
  SELECT d.*, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size) ELSE 0 END AS whole,
         coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY u, doc_id IS NULL, doc_id, size
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       (size * least(3, least(3, whole) + CASE WHEN target - least(3, whole) * source_size > 0
                                       AND before + size / 2.0 <= target - least(3, whole) * source_size THEN 1 ELSE 0 END))::BIGINT AS taken
FROM r

-- name: op7_substring_dedup
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), p AS (
  SELECT doc_id, unnest(range(1, len(words) - 11)) AS pos, words FROM w WHERE len(words) >= 13
), g AS (
  SELECT doc_id, pos, list_aggregate(words[pos:pos + 12], 'string_agg', ' ') AS gram FROM p
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(pos, pos + 13)) AS pos
  FROM (SELECT *, min(doc_id) OVER (PARTITION BY gram) AS first_id FROM g) WHERE first_id < doc_id
), lists AS (
  SELECT doc_id, list(pos) AS ats FROM gone GROUP BY doc_id
)
SELECT w.doc_id, len(words) AS n_words, coalesce(len(ats), 0) AS n_removed,
       sha256(coalesce(list_aggregate(list_filter(words, lambda x, i: ats IS NULL OR NOT list_contains(ats, i)), 'string_agg', ' '), ''))
         AS kept_sha256
FROM w LEFT JOIN lists USING (doc_id)

-- name: op8_url_filter
WITH p AS (
  SELECT page_id, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                            'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path
  FROM pages
), lab AS (
  SELECT doc_id, max((coalesce(quality = 0, false) OR coalesce(toxic = 1, false))::INT) AS bad
  FROM labels WHERE quality IS NOT NULL OR toxic IS NOT NULL GROUP BY doc_id
), o AS (
  SELECT host, bad FROM p LEFT JOIN lab ON lab.doc_id = try_cast(nullif(regexp_extract(path, '/(\d{1,18})\b', 1), '') AS BIGINT)
), public(two) AS (
  VALUES ('ac.uk'), ('co.uk'), ('gov.uk'), ('org.uk'), ('com.au'), ('net.au'), ('org.au'), ('co.nz'), ('co.jp'), ('ne.jp'), ('co.kr'),
         ('co.in'), ('co.za'), ('com.br'), ('com.cn'), ('com.hk'), ('com.mx'), ('com.sg'), ('com.tr'), ('com.ar')
), names AS (
  -- Without user part, port and final dot; the labels from the last one on, an address as one label.
  SELECT host, name, list_reverse(CASE WHEN regexp_matches(name, '^([0-9]+(\.[0-9]+){3}|\[.*\])$') THEN [name]
                                       ELSE string_split(name, '.') END) AS l
  FROM (SELECT DISTINCT host, regexp_replace(regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', ''), '\.$', '') AS name FROM o)
), parts AS (
  SELECT *, CASE WHEN l[2] || '.' || l[1] IN (SELECT two FROM public) THEN 2 ELSE 1 END AS k FROM names
), levels AS (
  SELECT host, CASE WHEN len(l) > k AND NOT list_contains(l[1:k + 1], '') THEN list_aggregate(list_reverse(l[1:k + 1]), 'string_agg', '.') ELSE name END AS domain,
         CASE WHEN len(l) >= k AND NOT list_contains(l[1:k], '') THEN list_aggregate(list_reverse(l[1:k]), 'string_agg', '.') ELSE name END AS suffix
  FROM parts
), h AS (
  SELECT host, count(bad) AS n, coalesce(sum(bad), 0) AS bad, any_value(domain) AS domain, any_value(suffix) AS suffix
  FROM o JOIN levels USING (host) GROUP BY host
), d AS (
  SELECT domain, suffix, sum(n) AS n, sum(bad) AS bad FROM h GROUP BY domain, suffix
), s0 AS (
  SELECT suffix, sum(n) AS n, sum(bad) AS bad FROM d GROUP BY suffix
), s1 AS (
  SELECT *, (SELECT CASE WHEN sum(n) > 0 THEN (sum(bad) + 1.0) / (sum(n) + 2.0) END FROM s0) AS prior FROM s0
), s2 AS (
  SELECT suffix, (bad + k * prior) / (n + k) AS m FROM s1, (
    SELECT 1 / least(greatest(coalesce(CASE WHEN sum(n) > count(*) THEN
      (sum(n * pow(bad / n - prior, 2) / (prior * (1 - prior))) - count(*)) / (sum(n) - count(*)) ELSE 0 END, 0), 0.02), 0.5) - 1 AS k
    FROM s1 WHERE n > 0)
), d1 AS (
  SELECT d.*, s2.m AS prior FROM d JOIN s2 USING (suffix)
), d2 AS (
  SELECT domain, (bad + k * prior) / (n + k) AS m FROM d1, (
    SELECT 1 / least(greatest(coalesce(CASE WHEN sum(n) > count(*) THEN
      (sum(n * pow(bad / n - prior, 2) / (prior * (1 - prior))) - count(*)) / (sum(n) - count(*)) ELSE 0 END, 0), 0.02), 0.5) - 1 AS k
    FROM d1 WHERE n > 0)
), h1 AS (
  SELECT h.*, d2.m AS prior FROM h JOIN d2 USING (domain)
), h2 AS (
  SELECT host, n, k, (bad + k * prior) / (n + k) AS m FROM h1, (
    SELECT 1 / least(greatest(coalesce(CASE WHEN sum(n) > count(*) THEN
      (sum(n * pow(bad / n - prior, 2) / (prior * (1 - prior))) - count(*)) / (sum(n) - count(*)) ELSE 0 END, 0), 0.02), 0.5) - 1 AS k
    FROM h1 WHERE n > 0)
), b AS (
  SELECT host, m - 1.645 * sqrt(m * (1 - m) / (n + k + 1)) > 0.3 AS blocked FROM h2
), rules(rule, verdict) AS (
  VALUES ('com/', 'allow'), ('example.com/en/', 'block'), ('www.example.com/en/', 'allow'), ('net/es/', 'block'), ('net/fr/', 'block')
), fit AS (
  SELECT p.page_id, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
  FROM p JOIN rules ON (host = split_part(rule, '/', 1) OR ends_with(host, '.' || split_part(rule, '/', 1)))
                   AND starts_with(path, substr(rule, strpos(rule, '/')))
  GROUP BY p.page_id
)
SELECT p.page_id, p.host, p.path, fit.rule, coalesce(fit.verdict, CASE WHEN b.blocked THEN 'block' ELSE 'allow' END) AS verdict
FROM p LEFT JOIN fit USING (page_id) LEFT JOIN b USING (host)

-- name: op10_warc
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), f AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM p
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND first_id < page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND first_id < page_id THEN first_id END AS refers_to
FROM f

-- name: op13_hard_negatives
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda c: CAST(floor(256 * CAST(c AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, r.vec_id AS id, a.label = r.label AS same,
         CAST(list_sum(list_transform(list_zip(a.x, r.x), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v a JOIN v r ON a.vec_id <> r.vec_id
  WHERE a.vec_id % 50 = 0
), p AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) AS INTEGER) AS rank,
       id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
