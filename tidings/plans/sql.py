"""Common table expressions shared by the checking SQL."""

ARTICLES = r"""
articles AS (
  SELECT 'doc_' || doc_id AS doc_id, doc_id AS doc_num,
         substring(split_part(text, chr(10), 1), 1, 100) AS title,
         text AS content, substring(text, 1, 500) AS description,
         'https://news.example.com/' || md5(text) AS link,
         TIMESTAMP '2024-01-01' + to_days((doc_id % 30)::INT) + to_hours((doc_id % 24)::INT) AS published_at,
         source, 'news_article' AS source_type,
         'Topic t' || (regexp_extract(source, '(\d+)', 1)::INT % 4) AS topic_name,
         't' || (regexp_extract(source, '(\d+)', 1)::INT % 4) AS topic_key,
         TIMESTAMP '2024-01-01' + to_days((doc_id % 30)::INT) + to_hours((doc_id % 24)::INT + 6) AS ingestion_timestamp,
         lang,
         CASE WHEN doc_id % 5 <> 0 THEN ((doc_id * 37) % 200 - 100) / 100.0::DOUBLE END AS sentiment,
         (doc_id % 1000)::DOUBLE AS wgt,
         CASE WHEN doc_id % 3 <> 0 THEN 'https://img.example.com/' || doc_id END AS image
  FROM documents)
"""

RAW = r"""
raw AS (
  SELECT doc_num, topic_name, topic_key, ingestion_timestamp AS fetched_at,
         CASE WHEN doc_num % 10 = 0 THEN '' ELSE 'news/' || source || ':' || doc_num END AS uri,
         link AS url, nullif(title, '') AS title, content AS body,
         strftime(published_at, '%Y-%m-%d') AS day,
         CASE WHEN doc_num % 7 = 0 OR doc_num % 11 = 0 THEN NULL ELSE published_at END AS dt,
         sentiment, wgt,
         CASE WHEN doc_num % 4 <> 0 THEN (doc_num % 100)::DOUBLE END AS relevance,
         CASE WHEN doc_num % 6 <> 0 THEN (doc_num % 50) / 50.0::DOUBLE END AS sim,
         image, CASE WHEN doc_num % 17 <> 0 THEN source END AS source_title,
         CASE lang WHEN 'en' THEN 'United States' WHEN 'fr' THEN 'France' WHEN 'es' THEN 'Spain' END AS country,
         lang, source
  FROM articles)
"""

TOKENS = r"""
toks AS (
  SELECT doc_id AS doc_num, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS tokens FROM documents),
seq AS (
  SELECT doc_num, unnest(tokens) AS term, generate_subscripts(tokens, 1) AS pos FROM toks),
postings AS (SELECT doc_num, term, count(*) AS tf FROM seq GROUP BY ALL)
"""

GIVEN = r"""
given AS (SELECT 'n:' || n_nationkey AS entity_id, n_name AS name FROM nation UNION ALL SELECT 's:' || s_suppkey, s_name FROM supplier
  UNION ALL SELECT 'c:' || c_custkey, c_name FROM customer UNION ALL SELECT 'p:' || p_partkey, p_name FROM part
  UNION ALL SELECT 'b:' || item_id, array_to_string(regexp_extract_all(lower(text), '[\p{L}\p{N}]+')[1:3], ' ') FROM benchmark),
keyed AS (SELECT DISTINCT entity_id, name, array_to_string(regexp_extract_all(lower(name), '[\p{L}\p{N}]+'), ' ') AS gram,
  len(regexp_extract_all(lower(name), '[\p{L}\p{N}]+')) AS n FROM given)
"""

GAZETTEER = GIVEN.rstrip() + r""",
phrases AS (SELECT tokens, unnest(generate_series(1, len(tokens) - 1)) AS i FROM (SELECT regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS tokens FROM benchmark)),
called AS (SELECT gram AS alias, left(entity_id, 1) AS origin FROM keyed WHERE gram <> '' UNION ALL SELECT tokens[i] || ' ' || tokens[i + 1], 'b' FROM phrases),
typed AS (SELECT alias, CASE WHEN origin IN ('s', 'c') THEN 'Company' WHEN origin = 'p' THEN 'Technology' WHEN origin = 'n' THEN 'Agency'
  ELSE ['Company', 'Technology', 'Agency', 'Organization'][length(alias) % 4 + 1] END AS type FROM called),
gaz AS MATERIALIZED (SELECT alias, md5(alias || '|' || min(type)) AS entity_id, min(type) AS type FROM typed GROUP BY 1),
runs3 AS (SELECT doc_num, pos, term, lead(term) OVER w AS second, lead(term, 2) OVER w AS third FROM seq WINDOW w AS (PARTITION BY doc_num ORDER BY pos)),
tries AS (SELECT doc_num, pos, 1 AS n, term AS alias FROM runs3 UNION ALL SELECT doc_num, pos, 2, term || ' ' || second FROM runs3
  UNION ALL SELECT doc_num, pos, 3, term || ' ' || second || ' ' || third FROM runs3),
longest_at AS MATERIALIZED (SELECT doc_num, pos, max(n) AS n, arg_max(alias, n) AS alias FROM tries JOIN gaz USING (alias) GROUP BY 1, 2),
after_it AS MATERIALIZED (SELECT l.*, m.pos AS next FROM longest_at l ASOF LEFT JOIN longest_at m ON l.doc_num = m.doc_num AND l.pos + l.n <= m.pos),
taken AS (SELECT * FROM after_it QUALIFY row_number() OVER (PARTITION BY doc_num ORDER BY pos) = 1
  UNION ALL SELECT a.* FROM taken t JOIN after_it a ON a.doc_num = t.doc_num AND a.pos = t.next),
occ AS MATERIALIZED (SELECT doc_num, pos, alias, entity_id, type FROM taken JOIN gaz USING (alias)),
mentions AS (SELECT doc_num, entity_id, alias, type, count(*) AS tf FROM occ GROUP BY ALL)
"""

EDGES = r"""
supplies AS (
  SELECT 's:' || l_suppkey AS src, 'p:' || l_partkey AS dst, 'SUPPLIES' AS type,
         l_shipdate AS ts, l_extendedprice AS value FROM lineitem),
awards AS (
  SELECT 'c:' || o_custkey AS src, 's:' || l_suppkey AS dst, 'AWARDS' AS type,
         o_orderdate AS ts, l_extendedprice AS value
  FROM orders JOIN lineitem ON o_orderkey = l_orderkey),
places AS (
  SELECT 'c:' || c_custkey AS src, 'n:' || c_nationkey AS dst, 'LOCATED_IN' AS type,
         NULL::TIMESTAMP AS ts, NULL::DOUBLE AS value FROM customer
  UNION ALL SELECT 's:' || s_suppkey, 'n:' || s_nationkey, 'LOCATED_IN', NULL, NULL FROM supplier
  UNION ALL SELECT 'n:' || n_nationkey, 'r:' || n_regionkey, 'PARTICIPATES_IN', NULL, NULL FROM nation),
edges AS (SELECT * FROM supplies UNION ALL SELECT * FROM awards UNION ALL SELECT * FROM places)
"""


def with_(*parts: str, body: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(p.strip() for p in parts) + "\n" + body.strip()
