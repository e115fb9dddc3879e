"""DuckDB SQL for the queries that SQL can express."""

ORACLES: dict[str, str] = {}

ORACLES["op3_url_filters"] = r"""
WITH rules(verdict, host, path) AS (
  VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
         ('block', 'net', '/es/'), ('block', 'net', '/fr/')
), parts AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), split AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM parts
), ranked AS (
  SELECT s.*, r.host || r.path AS rule, r.verdict,
         row_number() OVER (PARTITION BY s.page_id ORDER BY length(r.host || r.path) DESC NULLS LAST, length(r.host) DESC) AS place
  FROM split s LEFT JOIN rules r ON (s.host = r.host OR ends_with(s.host, '.' || r.host)) AND starts_with(s.path, r.path)
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM ranked WHERE place = 1
"""

ORACLES["op4_exact_topk"] = r"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""

ORACLES["op7_mixing"] = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5('0:' || coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')) AS digest
  FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS number,
         1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight
  FROM sized GROUP BY source
), ordered AS (
  SELECT *, sum(source_size) OVER ()::DOUBLE AS total,
         (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER (ORDER BY 3 * source_size / weight::DOUBLE, number ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE AS rest,
         (sum(weight) OVER (ORDER BY 3 * source_size / weight::DOUBLE, number ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS open_weight,
         row_number() OVER (ORDER BY 3 * source_size / weight::DOUBLE, number) AS place
  FROM sources
), stop AS (
  SELECT min_by(rest, place) AS rest, min_by(open_weight, place) AS open_weight, min(place) AS place
  FROM ordered WHERE 3 * source_size * open_weight >= rest * weight
), aimed AS (
  SELECT o.*, CASE WHEN o.place < s.place THEN 3 * o.source_size ELSE s.rest * o.weight / s.open_weight END::DOUBLE AS target,
         greatest(1, o.total // 1000000)::BIGINT AS block
  FROM ordered o, stop s
), quotients AS (
  SELECT number, target / (2 * j + 1) AS quotient
  FROM (SELECT number, target, unnest(range(0, (target / block)::BIGINT + 3)) AS j FROM aimed WHERE target > 0)
), seats AS (
  SELECT number, count(*) AS seats
  FROM (SELECT number, row_number() OVER (ORDER BY quotient DESC, number) AS place FROM quotients)
  WHERE place <= (SELECT max(total // block) FROM aimed) GROUP BY number
), dealt AS (
  SELECT d.doc_id, d.size, substr(d.digest, 9, 16) AS spot, a.number, a.source_size, a.target, a.block,
         ('0x' || substr(d.digest, 1, 8))::BIGINT % greatest(1, ceil(a.source_size / greatest(65536, ceil(a.total / 20000))))::BIGINT AS shard
  FROM sized d JOIN aimed a ON d.source IS NOT DISTINCT FROM a.source
), shards AS (
  SELECT number, shard, sum(size)::BIGINT AS shard_size FROM dealt GROUP BY number, shard
), shard_quotients AS (
  SELECT number, shard, shard_size / (2 * j + 1) AS quotient
  FROM (SELECT h.number, h.shard, h.shard_size::DOUBLE AS shard_size,
               unnest(range(0, (h.shard_size * coalesce(t.seats, 0) / greatest(1, sum(h.shard_size) OVER (PARTITION BY h.number)))::BIGINT + 3)) AS j
        FROM shards h LEFT JOIN seats t USING (number))
  WHERE shard_size > 0
), shard_seats AS (
  SELECT number, shard, count(*) AS n
  FROM (SELECT *, row_number() OVER (PARTITION BY number ORDER BY quotient DESC, shard) AS place FROM shard_quotients)
  JOIN seats USING (number) WHERE place <= seats GROUP BY number, shard
), placed AS (
  SELECT d.*, h.shard_size, least(coalesce(n, 0) * d.block, 3 * h.shard_size) AS quota,
         coalesce(sum(d.size) OVER (PARTITION BY number, shard ORDER BY spot, doc_id, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM dealt d JOIN shards h USING (number, shard) LEFT JOIN shard_seats USING (number, shard)
)
SELECT doc_id, size, source_size, target,
       (quota // greatest(shard_size, 1) * size
        + greatest(0, least(size, quota - quota // greatest(shard_size, 1) * shard_size - before)))::BIGINT AS taken
FROM placed
"""

ORACLES["op6_jaccard_join"] = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
                                      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s
  FROM words
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY x.doc_id, y.doc_id
), links AS (
  SELECT a, b FROM shared s JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 5 * s.n >= 4 * (x.n + y.n - s.n)
), reach AS (
  SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), classes AS (
  SELECT a AS doc_id, min(b) AS least FROM reach GROUP BY a
), counts AS (
  SELECT a AS doc_id, count(*) AS n_links FROM links GROUP BY a
)
SELECT d.doc_id, least(d.doc_id, coalesce(c.least, d.doc_id)) AS class_id, coalesce(n.n_links, 0)::BIGINT AS n_links
FROM documents d LEFT JOIN classes c USING (doc_id) LEFT JOIN counts n USING (doc_id)
"""
