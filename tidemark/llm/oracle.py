"""DuckDB SQL for the registered queries that SQL can express."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

ORACLE["op1_warc"] = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
  FROM pages
), f AS (SELECT payload_digest, min(page_id) AS first_id FROM p GROUP BY 1)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id IS DISTINCT FROM first_id AND first_id IS NOT NULL
            THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id IS DISTINCT FROM first_id THEN first_id END AS refers_to,
       true AS intact
FROM p JOIN f USING (payload_digest)
"""

ORACLE["op2_mixing"] = r"""
WITH d AS (
  SELECT doc_id, source,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         md5('42:' || coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || md5(coalesce(text, ''))) AS pos
  FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, 2.0::DOUBLE * sum(size) AS cap,
         CAST(list_value(3, 1, 2)[(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS DOUBLE) AS weight
  FROM d GROUP BY source
), l AS (
  SELECT *, row_number() OVER r AS place,
         sum(source_size) OVER () * 1.5::DOUBLE
           - coalesce(sum(cap) OVER (r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS remaining,
         sum(weight) OVER () - coalesce(sum(weight) OVER (r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS sharing
  FROM s WINDOW r AS (ORDER BY cap / weight, source NULLS LAST)
), v AS (
  SELECT remaining, sharing FROM l WHERE remaining * weight / sharing < cap ORDER BY place LIMIT 1
), t AS (
  SELECT l.source, source_size,
         CASE WHEN v.sharing IS NULL THEN cap ELSE least(cap, v.remaining * weight / v.sharing) END AS target
  FROM l LEFT JOIN v ON true
), n AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole FROM t
), run AS (
  SELECT d.*, n.source_size, n.target, n.whole, n.target - n.whole * n.source_size AS need,
         sum(size) OVER (PARTITION BY d.source ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS reach
  FROM d JOIN n ON d.source IS NOT DISTINCT FROM n.source
)
SELECT doc_id, size, source_size, target,
       CAST((whole + CASE WHEN need > 0 AND reach - size / 2 <= need THEN 1 ELSE 0 END) * size AS BIGINT) AS taken, source
FROM run
"""

ORACLE["op6_embeddings"] = """
WITH RECURSIVE good AS MATERIALIZED (
  SELECT vec_id, label, len(embedding) AS dim, CAST(embedding AS DOUBLE[]) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), pairs AS MATERIALIZED (
  SELECT a.vec_id AS a, b.vec_id AS b
  FROM good a JOIN good b ON a.label = b.label AND a.dim = b.dim AND a.vec_id <> b.vec_id
  WHERE list_dot_product(a.v, b.v) / (sqrt(list_dot_product(a.v, a.v)) * sqrt(list_dot_product(b.v, b.v))) >= 0.93
), reach(a, b) AS (
  SELECT a, b FROM pairs UNION SELECT r.a, p.b FROM reach r JOIN pairs p ON r.b = p.a
), counted AS (SELECT a, count(*) AS n FROM pairs GROUP BY a),
smallest AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(b, vec_id)) AS component_id,
       vec_id <= coalesce(b, vec_id) AS kept
FROM embeddings LEFT JOIN counted ON counted.a = vec_id LEFT JOIN smallest ON smallest.a = vec_id
"""

ORACLE["op7_urls"] = r"""
WITH u AS (
  SELECT page_id, CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) END AS rest FROM pages
), p AS (
  SELECT page_id,
         coalesce(translate(regexp_extract(rest, '^([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                            'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1, 's'), '') AS path
  FROM u
), g AS (
  SELECT *, list_transform(list_filter(string_split(path, '/'), lambda x: x <> ''), lambda x:
              CASE WHEN regexp_matches(x, '[0-9]') THEN '*' || regexp_extract(x, '(\.[A-Za-z]{1,5})?$', 1) ELSE x END) AS seg
  FROM p
), m AS (
  SELECT doc_id AS page_id, min(quality) AS good FROM labels WHERE quality IS NOT NULL GROUP BY 1
), c AS (
  SELECT host, seg, coalesce(sum((good = 1)::INT), 0) AS good, coalesce(sum((good = 0)::INT), 0) AS bad
  FROM g LEFT JOIN m USING (page_id) GROUP BY ALL
), s AS (
  SELECT c.*, unnest(range(1, len(seg) + 1)) AS i FROM c
), k AS (
  SELECT host, seg[1:i - 1] AS before, count(DISTINCT seg[i]) AS n FROM s GROUP BY ALL
), w AS (
  SELECT s.host, s.seg, s.good, s.bad, list(CASE WHEN k.n > 50 THEN '*' ELSE s.seg[i] END ORDER BY i) AS template
  FROM s JOIN k ON s.host = k.host AND s.seg[1:i - 1] = k.before GROUP BY ALL
  UNION ALL SELECT host, seg, good, bad, seg FROM c WHERE len(seg) = 0
), b AS (
  SELECT host, template, len(template) AS depth, template[1:greatest(len(template) - 1, 0)] AS above,
         sum(good)::DOUBLE AS good, sum(bad)::DOUBLE AS bad
  FROM w GROUP BY ALL
), f AS (
  SELECT *, sum(good) OVER fam AS all_good, sum(bad) OVER fam AS all_bad,
         sum(good) OVER () AS t_good, sum(bad) OVER () AS t_bad
  FROM b WINDOW fam AS (PARTITION BY host, depth, above)
), z AS (
  SELECT *, all_bad / nullif(all_good + all_bad, 0) AS pooled, good + bad AS n,
         all_good + all_bad - good - bad AS others FROM f
), j AS (
  SELECT *, NOT coalesce(n > 0 AND others > 0 AND pooled > 0 AND pooled < 1 AND
    abs(bad / nullif(n, 0) - (all_bad - bad) / nullif(others, 0))
      / nullif(sqrt(pooled * (1 - pooled) * (1.0 / nullif(n, 0) + 1.0 / nullif(others, 0))), 0) >= 1.96, false) AS merged
  FROM z
), q AS (
  SELECT *, CASE WHEN merged THEN sum(good) FILTER (merged) OVER fam ELSE good END AS g2,
         CASE WHEN merged THEN sum(bad) FILTER (merged) OVER fam ELSE bad END AS b2
  FROM j WINDOW fam AS (PARTITION BY host, depth, above)
), v AS (
  SELECT host, template,
         (g2 + 10.0::DOUBLE * CASE WHEN t_good + t_bad > 0 THEN t_good / (t_good + t_bad) ELSE 1.0::DOUBLE END) / (g2 + b2 + 10.0::DOUBLE)
           AS purity
  FROM q
)
SELECT page_id, g.host, path,
       CASE WHEN on_org AND starts_with(path, '/en/1') AND on_example THEN 'example.org/en/1'
            WHEN on_example AND starts_with(path, '/es/') THEN 'example.org/es/'
            WHEN on_org AND starts_with(path, '/') THEN 'org/'
            WHEN on_com AND starts_with(path, '/fr/') THEN 'com/fr/'
            WHEN on_com AND starts_with(path, '/de/') THEN 'com/de/' END AS rule,
       CASE rule WHEN 'example.org/en/1' THEN 'block' WHEN 'example.org/es/' THEN 'block' WHEN 'org/' THEN 'allow'
            WHEN 'com/fr/' THEN 'allow' WHEN 'com/de/' THEN 'block'
            ELSE CASE WHEN purity < 0.5 THEN 'block' ELSE 'allow' END END AS verdict,
       array_to_string(w.template, '/') AS template, purity
FROM (SELECT *, host = 'org' OR ends_with(host, '.org') AS on_org, host = 'com' OR ends_with(host, '.com') AS on_com,
             host = 'example.org' OR ends_with(host, '.example.org') AS on_example FROM g) g
JOIN w ON g.host = w.host AND g.seg = w.seg JOIN v ON w.host = v.host AND w.template = v.template
"""

_ESCAPED = r"regexp_replace({0}, '(\\|###|</turn>)', '\\\1', 'g')"

ORACLE["op8_chat"] = rf"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), ''))
         AS loss_sha256,
       CAST(sum(4 + length(replace({_ESCAPED.format('role')}, chr(10), '\n')) + 1
                + length({_ESCAPED.format('text')}) + 9) AS BIGINT) AS formatted_chars
FROM c GROUP BY conv_id
"""


def _score(shard: str) -> str:
    digest = f"md5(coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || {shard})"
    return f"-1.0 / ln((CAST('0x' || substr({digest}, 1, 13) AS BIGINT) + 0.5::DOUBLE) / 4503599627370496::DOUBLE)"


# CRC-32 (reflected polynomial 0xEDB88320) by the bit, over the bytes of the text in hex
_CRC_TABLE = """
  list_transform(range(256), lambda n: list_reduce(range(8), lambda c, k:
    CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, n))
"""

ORACLE["op9_sharding"] = f"""
WITH crc AS (SELECT {_CRC_TABLE} AS t),
d AS (
  SELECT doc_id, text, octet_length(encode(coalesce(text, ''))) + 8 AS size FROM documents
), b AS (
  SELECT doc_id, size, text, hex(encode(coalesce(text, ''))) AS h FROM d
), c AS (
  SELECT doc_id, size, xor(4294967295, list_reduce(
           list_transform(range(1, CAST(length(h) AS BIGINT), 2), lambda i: CAST('0x' || substr(h, i, 2) AS BIGINT)),
           lambda a, x: xor(a >> 8, t[CAST(xor(a & 255, x) AS BIGINT) + 1]), 4294967295)) AS text_crc32
  FROM b, crc
), scored AS (
  SELECT doc_id, size, text_crc32, list_transform(range(25), lambda i: {_score('i')}) AS s FROM c
), placed AS (
  SELECT doc_id, size, text_crc32, 'key' AS law,
         CAST(list_position(s[1:24], list_max(s[1:24])) - 1 AS INTEGER) AS shard,
         CAST(list_position(s, list_max(s)) - 1 AS INTEGER) AS grown_shard
  FROM scored
)
SELECT *, row_number() OVER (
         PARTITION BY shard
         ORDER BY substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || text_crc32 || ':' || size), 1, 3),
                  doc_id NULLS FIRST, text_crc32, size) - 1 AS slot
FROM placed
"""
