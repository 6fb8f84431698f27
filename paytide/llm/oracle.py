"""DuckDB SQL of the registered queries that SQL can express."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

ORACLE["op6_warc_bundles"] = """
WITH sized AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages
), told AS (
  SELECT page_id, octet_length(payload)::BIGINT AS payload_bytes, sha256(payload) AS payload_digest FROM sized
), first AS (
  SELECT payload_digest, min(page_id) AS keeper FROM told WHERE payload_bytes >= 100 GROUP BY payload_digest
)
SELECT t.page_id, t.payload_bytes, t.payload_digest,
       CASE WHEN f.keeper IS NOT NULL AND f.keeper <> t.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN f.keeper <> t.page_id THEN f.keeper END AS refers_to
FROM told t LEFT JOIN first f USING (payload_digest)
"""

ORACLE["op8_decontaminate"] = r"""
WITH doc AS (
  SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{M}\p{N}]+') AS w FROM documents
), item AS (
  SELECT item_id, regexp_extract_all(lower(text), '[\p{L}\p{M}\p{N}]+') AS w FROM benchmark
), doc_word AS (
  SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS p FROM doc
), item_word AS (
  SELECT item_id, len(w) AS size, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS q FROM item
), doc_line AS (
  SELECT doc_id, p, word AS w0, lead(word, 1) OVER x AS w1, lead(word, 2) OVER x AS w2, lead(word, 3) OVER x AS w3,
         lead(word, 4) OVER x AS w4, lead(word, 5) OVER x AS w5, lead(word, 6) OVER x AS w6, lead(word, 7) OVER x AS w7
  FROM doc_word WINDOW x AS (PARTITION BY doc_id ORDER BY p)
), item_line AS (
  SELECT item_id, q, word AS w0, lead(word, 1) OVER x AS w1, lead(word, 2) OVER x AS w2, lead(word, 3) OVER x AS w3,
         lead(word, 4) OVER x AS w4, lead(word, 5) OVER x AS w5, lead(word, 6) OVER x AS w6, lead(word, 7) OVER x AS w7
  FROM item_word WINDOW x AS (PARTITION BY item_id ORDER BY q)
), hit AS (
  SELECT doc_id, item_id, p - q AS shift, q FROM doc_line d JOIN item_line i USING (w0, w1, w3, w5, w6)
  WHERE d.w7 IS NOT NULL AND i.w7 IS NOT NULL
  UNION
  SELECT doc_id, item_id, p - q AS shift, q FROM doc_line d JOIN item_line i USING (w0, w2, w3, w4, w7)
), marked AS (
  SELECT *, CASE WHEN q - lag(q) OVER x <= 16 THEN 0 ELSE 1 END AS new
  FROM hit WINDOW x AS (PARTITION BY doc_id, item_id, shift ORDER BY q)
), numbered AS (
  SELECT *, sum(new) OVER (PARTITION BY doc_id, item_id, shift ORDER BY q) AS stretch FROM marked
), found AS (
  SELECT doc_id, item_id, shift, stretch, min(q) AS first, max(q) - min(q) + 8 AS n FROM numbered GROUP BY ALL
), judged AS (
  SELECT f.doc_id, f.item_id, f.shift, f.first, f.n, any_value(i.size) AS size, greatest(0, -f.shift) AS whole_from,
         count(*) FILTER (d.word = i.word) AS whole_same,
         count(*) FILTER (d.word = i.word AND i.q >= f.first AND i.q < f.first + f.n) AS same
  FROM found f JOIN item_word i USING (item_id) JOIN doc_word d ON d.doc_id = f.doc_id AND d.p = i.q + f.shift
  GROUP BY f.doc_id, f.item_id, f.shift, f.stretch, f.first, f.n
), told AS (
  SELECT doc_id, item_id, shift, whole_same * 100 >= size * 80 AS whole,
         CASE WHEN whole THEN size ELSE n END AS n_words, CASE WHEN whole THEN whole_same ELSE same END AS n_same,
         CASE WHEN whole THEN whole_from ELSE first END AS item_word
  FROM judged WHERE whole OR (n >= 13 AND same * 100 >= n * 80)
)
SELECT doc_id, item_id, n_words::INTEGER AS n_words, n_same::INTEGER AS n_same,
       (item_word + shift)::INTEGER AS doc_word, item_word::INTEGER AS item_word
FROM told
QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY n_same DESC, n_words, item_word + shift, item_word) = 1
"""

ORACLE["op1_repeated_passages"] = r"""
WITH unit AS (
  SELECT doc_id, unnest(u) AS raw, generate_subscripts(u, 1) - 1 AS nth
  FROM (SELECT doc_id, regexp_extract_all(text, '[^\n.!?]*[.!?\n]+|[^\n.!?]+') AS u FROM documents)
), placed AS (
  SELECT doc_id, nth, sum(length(raw)) OVER x - length(raw) AS start, sum(length(raw)) OVER x AS stop,
         trim(regexp_replace(translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                             '[\x09-\x0D\x20]+', ' ', 'g')) AS plain
  FROM unit WINDOW x AS (PARTITION BY doc_id ORDER BY nth ROWS UNBOUNDED PRECEDING)
), told AS (
  SELECT *, min(doc_id) OVER (PARTITION BY plain) AS kept,
         row_number() OVER (PARTITION BY plain ORDER BY doc_id, nth) AS rank,
         CASE WHEN plain = '' THEN 0 ELSE len(string_split(plain, ' ')) END AS n_words
  FROM placed
), numbered AS (
  SELECT *, nth - row_number() OVER (PARTITION BY doc_id ORDER BY nth) AS run FROM told WHERE rank > 1
)
SELECT doc_id, min(start)::INTEGER AS start, max(stop)::INTEGER AS stop, count(*) AS n_units,
       sum(n_words)::BIGINT AS n_words, min_by(kept, nth) AS kept_doc_id
FROM numbered GROUP BY doc_id, run HAVING sum(CASE WHEN n_words >= 4 THEN n_words ELSE 0 END) >= 20
"""

ORACLE["op12_filter_audit"] = r"""
WITH worded AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), told AS (
  SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id
), judged AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
         (len(w) < 50)::INT + 2 * (100 * len(list_distinct(w)) < 65 * len(w))::INT
         + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t))::INT
         + 8 * regexp_matches(t, '[#$%&*|]')::INT
         + 16 * coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false)::INT AS mask
  FROM worded LEFT JOIN told USING (doc_id)
), cell AS (
  SELECT part, mask, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM judged GROUP BY ALL
), letter AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f
), orders AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order FROM letter a, letter b, letter c, letter d, letter e
  WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5
), stage AS (
  SELECT filter_order, step, filter_order[step] AS f, 1 << (ascii(filter_order[step]) - 65) AS bit
  FROM orders, range(1, 6) r(step)
), chain AS (
  SELECT *, (sum(bit) OVER (PARTITION BY filter_order ORDER BY step))::INT AS upto FROM stage
), counted AS (
  SELECT part, filter_order, step, f,
         coalesce(sum(n) FILTER (mask & upto = 0), 0)::BIGINT AS kept,
         coalesce(sum(n) FILTER (mask & upto = bit), 0)::BIGINT AS removed,
         coalesce(sum(n) FILTER (mask & bit > 0 AND mask & upto <> bit), 0)::BIGINT AS redundant,
         coalesce(sum(n) FILTER (mask = bit), 0)::BIGINT AS unique_fails,
         coalesce(sum(good) FILTER (mask & upto = bit), 0)::BIGINT AS good_lost,
         coalesce(sum(toxic) FILTER (mask & upto = bit), 0)::BIGINT AS toxic_lost
  FROM cell, chain GROUP BY ALL
)
SELECT part, filter_order, step::INTEGER AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley
FROM counted
"""
