"""The same as plain SQL, where SQL can express it."""

from __future__ import annotations

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP2 = r"""
WITH RECURSIVE
narrow AS (
  SELECT doc_id, source, CASE WHEN source IS NULL THEN 'null' ELSE '=' || source END AS key,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS n_tokens
  FROM documents),
sources AS (SELECT key, sum(n_tokens)::BIGINT AS tokens FROM narrow GROUP BY key),
shares AS (
  SELECT list(tokens::DOUBLE / total) AS ps, count(*) AS n
  FROM (SELECT tokens, sum(tokens) OVER () AS total FROM sources WHERE tokens > 0)),
bracket(i, low, high) AS (
  SELECT 0, 0.0::DOUBLE, 1.0::DOUBLE
  UNION ALL
  SELECT i + 1, CASE WHEN ok THEN low ELSE mid END, CASE WHEN ok THEN mid ELSE high END
  FROM (
    SELECT i, low, high, mid,
           ln(z) - mid * l / z <= 0.95::DOUBLE * ln(n) AND most / least <= 4.0::DOUBLE AS ok
    FROM (
      SELECT i, low, high, (low + high) / 2 AS mid, n,
             list_sum(list_transform(ps, lambda p: pow(p, (low + high) / 2))) AS z,
             list_sum(list_transform(ps, lambda p: pow(p, (low + high) / 2) * ln(p))) AS l,
             list_max(list_transform(ps, lambda p: pow(p, (low + high) / 2 - 1))) AS most,
             list_min(list_transform(ps, lambda p: pow(p, (low + high) / 2 - 1))) AS least
      FROM bracket, shares WHERE i < 24))),
chosen AS (SELECT least(1.0::DOUBLE, ceil(high * 1e6::DOUBLE) / 1e6::DOUBLE) AS exponent FROM bracket WHERE i = 24),
power AS (
  SELECT key, tokens, exponent,
         CASE WHEN tokens > 0 THEN pow(tokens::DOUBLE / (SELECT sum(tokens) FROM sources), exponent) END AS pw
  FROM sources, chosen),
sizes AS (SELECT sum(pw) AS z, max(tokens / pw) AS largest FROM power),
quotas AS (
  SELECT key, tokens, exponent, round(coalesce(pw / z, 0), 9) AS weight,
         floor(coalesce(pw / z, 0) * (largest * z) + 0.5::DOUBLE)::BIGINT AS quota
  FROM power, sizes),
plan AS (
  SELECT key, exponent, weight,
         CASE WHEN tokens > 0 THEN quota // tokens ELSE 1 END AS full_epochs,
         CASE WHEN tokens > 0 THEN quota % tokens ELSE 0 END AS rest,
         least(4096, greatest(1, ceil(tokens / 1048576.0::DOUBLE)))::BIGINT AS blocks
  FROM quotas),
readings AS (
  SELECT *, md5('7|' || epoch || '|' || doc_id) AS d
  FROM (SELECT narrow.*, plan.* EXCLUDE (key),
               unnest(range(0, full_epochs + CASE WHEN rest > 0 THEN 1 ELSE 0 END)) AS epoch
        FROM narrow JOIN plan USING (key))),
dealt AS (
  SELECT *, md5('7|' || key || '|' || epoch || '|' || block) AS u
  FROM (SELECT *, ('0x' || substr(d, 1, 8))::BIGINT % blocks AS block FROM readings)),
units AS (
  SELECT key, block, coalesce(sum(t) OVER (PARTITION BY key ORDER BY u ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS unit_start
  FROM (SELECT key, block, u, sum(n_tokens) AS t FROM dealt WHERE epoch = full_epochs GROUP BY ALL)),
placed AS (
  SELECT dealt.*, unit_start + coalesce(sum(n_tokens) OVER (
           PARTITION BY key, block ORDER BY d, doc_id, n_tokens ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM dealt JOIN units USING (key, block) WHERE epoch = full_epochs)
SELECT doc_id, source, n_tokens, exponent, weight, epoch::BIGINT AS epoch, block,
       substr(u, 1, 16) AS unit_order, substr(d, 1, 16) AS doc_order
FROM dealt WHERE epoch < full_epochs
UNION ALL
SELECT doc_id, source, n_tokens, exponent, weight, epoch::BIGINT AS epoch, block,
       substr(u, 1, 16) AS unit_order, substr(d, 1, 16) AS doc_order
FROM placed WHERE start < rest
"""

OP3 = f"""
WITH t AS (SELECT doc_id, {_LOWER.format("coalesce(text, '')")} AS norm FROM documents)
SELECT doc_id,
       max(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER same AS kept,
       sha256(norm) AS text_sha256
FROM t WINDOW same AS (PARTITION BY norm)
"""

OP7 = r"""
WITH bare AS (
  SELECT page_id AS p, md5(coalesce(html, '')) AS digest, strlen(coalesce(html, '')) AS size,
         regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS bare
  FROM pages),
named AS (
  SELECT *, 1600000000 + p * 60 AS ts, 1600000000 + p * 60 + 86400 + (p % 1000) * 37 AS again, 'day ' || (p % 365) AS modified,
         regexp_replace(lower(regexp_extract(bare, '^[^/?]*')), '^www\.|:(80|443)$', '', 'g')
         || regexp_replace(regexp_replace(regexp_extract(bare, '^[^/?]*(.*)$', 1),
              '([?&])(utm_[^&]*(&|$))+', '\1', 'g'), '/?[?&]*$', '') AS canonical_url
  FROM bare),
responses AS (SELECT canonical_url, ts, max(p * 3) AS response_id FROM named GROUP BY canonical_url, ts),
revisits AS (
  SELECT p * 3 + 1 AS record_id, canonical_url, again AS ts, p % 10 = 0 AS dated, modified,
         CASE WHEN p % 10 = 0 THEN NULL WHEN p % 14 = 0 THEN md5(digest) ELSE digest END AS tag,
         p % 14 <> 0 AND p % 6 = 0 AS weak, FALSE AS early
  FROM named WHERE p % 2 = 0
  UNION ALL
  SELECT p * 3 + 2, canonical_url, ts - 30, FALSE, NULL, digest, FALSE, TRUE FROM named WHERE p % 11 = 0),
found AS (
  SELECT v.*, r.response_id, n.digest AS full_tag, n.modified AS full_modified, n.size AS full_size
  FROM revisits v
  ASOF LEFT JOIN responses r ON v.canonical_url = r.canonical_url AND v.ts > r.ts
  LEFT JOIN named n ON n.p * 3 = r.response_id),
judged AS (
  SELECT *, CASE WHEN response_id IS NULL THEN 'orphan'
                 WHEN tag IS NOT NULL THEN CASE WHEN tag = full_tag THEN 'resolved' ELSE 'changed' END
                 WHEN modified = full_modified THEN 'resolved' ELSE 'changed' END AS outcome,
         CASE WHEN tag IS NOT NULL THEN 'etag: ' || CASE WHEN weak THEN 'W/' ELSE '' END || '"' || tag || '"' END AS tag_line
  FROM found)
SELECT record_id, canonical_url, response_id, outcome,
       array_to_string(list_sort(list_filter(CASE WHEN outcome = 'resolved' THEN [
           'content-length: ' || full_size, 'content-type: text/html', 'date: ' || ts, 'last-modified: ' || full_modified,
           coalesce(tag_line, 'etag: "' || full_tag || '"'), CASE WHEN dated THEN 'expires: ' || (ts + 600) END]
         WHEN dated THEN ['date: ' || ts, 'expires: ' || (ts + 600), 'last-modified: ' || modified]
         WHEN early THEN ['date: ' || ts, tag_line]
         ELSE ['content-length: 0', 'date: ' || ts, tag_line] END, lambda x: x IS NOT NULL)), chr(10)) AS headers
FROM judged
"""


OP13 = """
WITH kept AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v,
         row_number() OVER (ORDER BY vec_id) - 1 AS place
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
widths AS (SELECT (len(v) // 16)::BIGINT AS width FROM kept WHERE place = 0),
positions AS MATERIALIZED (SELECT unnest(range(1, width + 1)) AS k FROM widths),
parts AS MATERIALIZED (
  SELECT vec_id, place, part, v[part * width + 1 : (part + 1) * width] AS x
  FROM kept, widths, (SELECT unnest(range(0, 16)) AS part)),
book0 AS MATERIALIZED (SELECT part, place AS entry, x FROM parts WHERE place < 64),
chosen0 AS MATERIALIZED (
  SELECT vec_id, part, min({'d': d, 'e': entry}) AS best FROM (
    SELECT v.vec_id, v.part, b.entry,
           list_sum(list_transform(list_zip(v.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
    FROM parts v JOIN book0 b ON v.part = b.part) GROUP BY vec_id, part),
means0 AS (
  SELECT part, entry, list(mean ORDER BY k) AS x FROM (
    SELECT v.part, c.best.e AS entry, k, floor(sum(v.x[k])::DOUBLE / count(*))::BIGINT AS mean
    FROM parts v JOIN chosen0 c ON v.vec_id = c.vec_id AND v.part = c.part, positions
    GROUP BY v.part, c.best.e, k) GROUP BY part, entry),
book1 AS MATERIALIZED (
  SELECT b.part, b.entry, coalesce(m.x, b.x) AS x
  FROM book0 b LEFT JOIN means0 m ON b.part = m.part AND b.entry = m.entry),
chosen1 AS MATERIALIZED (
  SELECT vec_id, part, min({'d': d, 'e': entry}) AS best FROM (
    SELECT v.vec_id, v.part, b.entry,
           list_sum(list_transform(list_zip(v.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
    FROM parts v JOIN book1 b ON v.part = b.part) GROUP BY vec_id, part),
means1 AS (
  SELECT part, entry, list(mean ORDER BY k) AS x FROM (
    SELECT v.part, c.best.e AS entry, k, floor(sum(v.x[k])::DOUBLE / count(*))::BIGINT AS mean
    FROM parts v JOIN chosen1 c ON v.vec_id = c.vec_id AND v.part = c.part, positions
    GROUP BY v.part, c.best.e, k) GROUP BY part, entry),
book2 AS MATERIALIZED (
  SELECT b.part, b.entry, coalesce(m.x, b.x) AS x
  FROM book1 b LEFT JOIN means1 m ON b.part = m.part AND b.entry = m.entry),
chosen2 AS MATERIALIZED (
  SELECT vec_id, part, min({'d': d, 'e': entry}) AS best FROM (
    SELECT v.vec_id, v.part, b.entry,
           list_sum(list_transform(list_zip(v.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
    FROM parts v JOIN book2 b ON v.part = b.part) GROUP BY vec_id, part),
digest AS (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM book2),
codes AS (
  SELECT vec_id, string_agg(printf('%02x', best.e), '' ORDER BY part) AS code, sum(best.d)::BIGINT AS error
  FROM chosen2 GROUP BY vec_id)
SELECT c.vec_id, c.code, c.error, sum(c.error) OVER (PARTITION BY k.label)::BIGINT AS label_error, d.codebooks_sha256
FROM codes c JOIN kept k ON c.vec_id = k.vec_id, digest d
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op2_temperature_mixing": OP2,
        "op3_exact_dedup": OP3,
        "op7_warc_revisits": OP7,
        "op13_vector_codes": OP13,
    }
