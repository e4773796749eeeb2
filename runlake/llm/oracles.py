"""DuckDB's SQL for the operators whose whole result SQL can express."""

from __future__ import annotations

#: Exact weights, one period by earliest deadline first (a recursive walk over its slots), then places.
MIXING = """
WITH RECURSIVE keyed AS (
  SELECT doc_id, coalesce(source, '') AS source, md5(coalesce(CAST(doc_id AS VARCHAR), '?' || coalesce(text, ''))) AS hash FROM documents
), placed AS (
  SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY hash, doc_id) - 1 AS at FROM keyed
), shares AS (
  SELECT source, count(*) AS n, CAST(floor(sqrt(count(*))) AS BIGINT) AS w FROM keyed GROUP BY source
), numbered AS (
  SELECT *, row_number() OVER (ORDER BY w, source) AS i FROM shares
), listed AS (
  SELECT list(w ORDER BY i) AS w, count(*) AS k, CAST(sum(w) AS BIGINT) AS period FROM numbered
), walk(t, had, won) AS (
  SELECT CAST(-1 AS BIGINT), list_transform(range(k), lambda x: CAST(0 AS BIGINT)), CAST(NULL AS BIGINT) FROM listed WHERE k > 0
  UNION ALL
  SELECT t, list_transform(had, lambda x, i: CASE WHEN i = won THEN x + 1 ELSE x END), won
  FROM (
    SELECT t + 1 AS t, had,
           list_min(list_filter(list_transform(range(1, k + 1), lambda i:
             CASE WHEN had[i] * period // w[i] <= t + 1
                  THEN ((had[i] + 1) * period + w[i] - 1) // w[i] * 1000000 + i END), lambda x: x IS NOT NULL)) % 1000000 AS won
    FROM walk, listed WHERE t < period - 1
  )
), turns AS (
  SELECT t AS slot, won AS i, had[won] - 1 AS turn FROM walk WHERE won IS NOT NULL
), ends AS (
  SELECT *, CAST(ceil(n / 64.0) AS BIGINT) AS blocks FROM numbered
), horizon AS (
  SELECT min(blocks // s.w * l.period + t.slot) AS horizon FROM ends s JOIN turns t ON t.i = s.i AND t.turn = blocks % s.w, listed l
), final AS (
  SELECT p.doc_id, p.source, p.at // 64 AS block, (p.at // 64) // s.w * l.period + t.slot AS early, CAST(p.at % 64 AS INTEGER) AS place,
         ((p.at // 64 + 1) * l.period + s.w - 1) // s.w AS due, s.i, l.k
  FROM placed p JOIN numbered s USING (source) JOIN turns t ON t.i = s.i AND t.turn = (p.at // 64) % s.w, listed l
)
SELECT doc_id, source, CAST(block AS BIGINT) AS block, CAST(CASE WHEN early < horizon THEN early ELSE horizon + (due - horizon - 1) * k + i - 1 END AS BIGINT) AS slot,
       place, early < horizon AS in_mix FROM final, horizon
"""

#: Each five hex digits of a SHA-1 are four base32 letters.
WARC = """
WITH payloads AS (
  SELECT page_id, url, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages
), firsts AS (
  SELECT *, min(page_id) OVER own AS first, row_number() OVER (own ORDER BY page_id NULLS LAST, url NULLS FIRST) = 1 AS answers
  FROM payloads WINDOW own AS (PARTITION BY hex)
), numbers AS (
  SELECT *, list_transform(range(0, 8), lambda i: CAST('0x' || substr(hex, CAST(i * 5 + 1 AS INTEGER), 5) AS BIGINT)) AS fives FROM firsts
)
SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(fives, lambda v:
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((v >> 15) & 31 AS INTEGER) + 1, 1) || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((v >> 10) & 31 AS INTEGER) + 1, 1) ||
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((v >> 5) & 31 AS INTEGER) + 1, 1) || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(v & 31 AS INTEGER) + 1, 1)), '') AS payload_digest,
       CASE WHEN first IS NOT NULL AND NOT answers THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first IS NOT NULL AND NOT answers THEN first END AS refers_to
FROM numbers
"""

#: All pairs of usable vectors of one length; then each row takes the least id of its neighbours until none changes.
EMBEDDINGS = """
WITH RECURSIVE numbered AS (
  SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings
), usable AS MATERIALIZED (
  SELECT row, vec_id, v, len(v) AS size FROM numbered
  WHERE len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(v, lambda x: x <> 0)) > 0
), pairs AS MATERIALIZED (
  SELECT a.row AS a, b.row AS b FROM usable a JOIN usable b ON a.size = b.size AND a.row < b.row AND list_cosine_similarity(a.v, b.v) >= 0.95
), links AS MATERIALIZED (
  SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs
), reached(row, component) USING KEY (row) AS (
  SELECT row, vec_id FROM numbered
  UNION
  (SELECT own.row, min(near.component) FROM reached near JOIN links ON links.b = near.row JOIN recurring.reached own ON own.row = links.a
   WHERE own.component IS NULL OR near.component < own.component GROUP BY own.row HAVING min(near.component) IS NOT NULL)
), counted AS (
  SELECT a AS row, count(*) AS n FROM links GROUP BY a
)
SELECT n.vec_id, CAST(coalesce(c.n, 0) AS BIGINT) AS n_links, r.component AS component_id,
       coalesce(n.vec_id = r.component, u.row IS NULL) AS kept
FROM numbered n JOIN reached r USING (row) LEFT JOIN counted c USING (row) LEFT JOIN usable u USING (row)
"""

#: Each anchor against all rows, in whole numbers that doubles hold exactly.
NEGATIVES = """
WITH usable AS (
  SELECT row_number() OVER () AS row, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS MATERIALIZED (
  SELECT a.row AS anchor, a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM usable a JOIN usable b ON a.row <> b.row WHERE a.vec_id % 100 = 0
), positives AS (
  SELECT *, row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id) AS k FROM scored WHERE same QUALIFY k <= 5
)
SELECT p.anchor_id, p.vec_id AS positive_id, CAST(row_number() OVER (PARTITION BY p.anchor, p.k ORDER BY n.score DESC, n.vec_id) AS INTEGER) AS rank,
       n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON n.anchor = p.anchor AND NOT n.same AND 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score
QUALIFY rank <= 10
"""

ORACLES: dict[str, str] = {"op1_mixing": MIXING, "op7_warc": WARC, "op10_embedding_near_dedup": EMBEDDINGS, "op13_hard_negatives": NEGATIVES}
