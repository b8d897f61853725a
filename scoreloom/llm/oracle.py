"""DuckDB statements with the results of the queries that SQL can express."""

from __future__ import annotations

_WORDS = r"list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '')"

# Windows of lines that reach fifty words first; a line goes if a window around it stood before.
LINE_DEDUP = r"""
WITH cut AS (SELECT doc_id, text, string_split(text, chr(10)) AS raw FROM documents),
marked AS (
  SELECT doc_id, text, raw,
    list_transform(raw, lambda l: translate(trim(regexp_replace(l, '[\x20\x09-\x0D]+', ' ', 'g'), ' '), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS norm FROM cut),
lines AS (
  SELECT doc_id, unnest(norm) AS line, generate_subscripts(norm, 1) AS spot FROM marked),
solid AS (
  SELECT doc_id, line, spot, row_number() OVER (PARTITION BY doc_id ORDER BY spot) - 1 AS i,
    len(string_split(line, ' ')) AS n FROM lines WHERE line <> ''),
summed AS (
  SELECT *, sum(n) OVER (PARTITION BY doc_id ORDER BY i) AS through FROM solid),
ends AS (
  SELECT a.doc_id, a.i, min(b.i) AS e FROM summed a JOIN summed b
    ON a.doc_id = b.doc_id AND b.i >= a.i AND b.through - a.through + a.n >= 50
  GROUP BY a.doc_id, a.i),
docs AS (SELECT doc_id, list(line ORDER BY i) AS doc_lines FROM solid GROUP BY doc_id),
windows AS (
  SELECT ends.doc_id, i, e, list_slice(doc_lines, i + 1, e + 1) AS window_lines FROM ends JOIN docs USING (doc_id)),
placed AS (
  SELECT doc_id, i, e, row_number() OVER (PARTITION BY window_lines ORDER BY doc_id, i) AS turn FROM windows),
gone AS (
  SELECT DISTINCT doc_id, unnest(generate_series(i, e)) AS i FROM placed WHERE turn > 1),
places AS (
  SELECT gone.doc_id, list(spot) AS spots, count(*) AS n_removed FROM gone JOIN solid USING (doc_id, i) GROUP BY gone.doc_id),
owners AS (
  SELECT l.doc_id, l.spot, max(s.spot) AS owner FROM lines l JOIN solid s ON l.doc_id = s.doc_id AND s.spot <= l.spot GROUP BY l.doc_id, l.spot),
kept AS (
  SELECT o.doc_id, list(o.spot) AS lost FROM owners o JOIN places p ON o.doc_id = p.doc_id AND list_contains(p.spots, o.owner) GROUP BY o.doc_id)
SELECT marked.doc_id AS doc_id,
  CASE WHEN lost IS NULL THEN text ELSE array_to_string(list_filter(raw, lambda l, spot: NOT list_contains(lost, spot)), chr(10)) END AS text,
  CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed
FROM marked LEFT JOIN places ON marked.doc_id = places.doc_id LEFT JOIN kept ON marked.doc_id = kept.doc_id
"""

# Every row is its own, whatever its doc_id.
NGRAM_JOIN = rf"""
WITH RECURSIVE numbered AS (SELECT row_number() OVER () AS r, doc_id, text FROM documents),
listed AS (
  SELECT r, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM numbered),
grams AS (
  SELECT DISTINCT r, array_to_string(CASE WHEN len(w) < 4 THEN w ELSE list_slice(w, i, i + 3) END, ' ') AS g
  FROM (SELECT r, w, unnest(generate_series(1, greatest(1, len(w) - 3))) AS i FROM listed WHERE len(w) > 0)),
sizes AS (SELECT r, count(*) AS n FROM grams GROUP BY r),
counts AS (
  SELECT a.r AS a, b.r AS b, count(*) AS o FROM grams a JOIN grams b ON a.g = b.g AND a.r <> b.r GROUP BY 1, 2),
links AS (
  SELECT a, b FROM counts JOIN sizes x ON x.r = a JOIN sizes y ON y.r = b WHERE 100 * o >= 85 * (x.n + y.n - o)),
reach AS (
  SELECT r AS node, r AS seen FROM numbered
  UNION SELECT reach.node, links.b FROM reach JOIN links ON reach.seen = links.a),
named AS (SELECT node, min(doc_id) AS c FROM reach JOIN numbered ON seen = r GROUP BY node)
SELECT d.doc_id AS doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, c AS component_id
FROM numbered d JOIN named ON d.r = node LEFT JOIN sizes ON d.r = sizes.r
"""

QUALITY = rf"""
WITH listed AS (
  SELECT doc_id, source, text, {_WORDS} AS w FROM documents),
wins AS (
  SELECT doc_id, unnest(generate_series(1, len(w) - 7)) AS i, w FROM listed WHERE len(w) > 8),
keyed AS (SELECT doc_id, i, array_to_string(list_slice(w, i, i + 7), ' ') AS k FROM wins),
twice AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, k) AS c FROM keyed) WHERE c > 1),
covered AS (
  SELECT doc_id, sum(least(8, coalesce(nxt - i, 8))) AS n
  FROM (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS nxt FROM twice) GROUP BY doc_id),
base AS (
  SELECT l.doc_id, source, text, CAST(len(w) AS BIGINT) AS n_words,
    CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(coalesce(len(regexp_extract_all(text, '[#*$%&|<>]')), 0) AS BIGINT) AS n_symbols,
    CAST(coalesce(len(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))
       - len(list_distinct(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))), 0) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words
  FROM listed l LEFT JOIN covered c ON l.doc_id = c.doc_id),
lines AS (
  SELECT doc_id, source, trim(lower(regexp_replace(unnest(string_split(text, chr(10))), '[\x20\x09-\x0D]+', ' ', 'g')), ' ') AS line FROM documents),
counted AS (
  SELECT doc_id, source, line, sum(len(string_split(line, ' '))) AS n FROM lines WHERE line <> '' GROUP BY 1, 2, 3),
common AS (
  SELECT *, count(*) OVER (PARTITION BY source, line) AS docs, min(doc_id) OVER (PARTITION BY source, line) AS keeper FROM counted),
gone AS (SELECT doc_id, CAST(sum(n) AS BIGINT) AS gone FROM common WHERE docs > 20 AND doc_id <> keeper GROUP BY doc_id)
SELECT b.doc_id AS doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AS base_failed,
  coalesce(gone, 0) AS n_removed_words,
  NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND n_words - coalesce(gone, 0) >= 20
    AND 100 * (n_words - coalesce(gone, 0)) >= 50 * n_words AS kept
FROM base b LEFT JOIN gone g ON b.doc_id = g.doc_id
"""

# Rows are candidates of their own; ties go to the smaller vec_id, a null one last.
TOPK = """
WITH whole AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
scored AS (
  SELECT q.r AS query, q.vec_id AS query_id, c.vec_id AS vec_id,
    CAST(list_inner_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
  FROM whole q JOIN whole c ON q.r <> c.r WHERE q.vec_id % 20 = 0),
ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query ORDER BY score DESC, vec_id NULLS LAST) AS INTEGER) AS rank, vec_id, score FROM scored)
SELECT * FROM ranked WHERE rank <= 20
"""

_BASE32 = """array_to_string(list_transform(generate_series(0, 31), lambda i:
  substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((CAST('0x' || substr(d, 1 + 10 * (i // 8), 10) AS BIGINT) >> CAST(35 - 5 * (i % 8) AS BIGINT)) & 31 AS INTEGER) + 1, 1)), '')"""

WARC = f"""
WITH held AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
kept AS (SELECT page_id, payload, sha1(payload) AS d, min(page_id) OVER (PARTITION BY payload) AS first FROM held)
SELECT page_id, CAST(octet_length(encode(payload)) AS BIGINT) AS payload_bytes, {_BASE32} AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM kept
"""

ORACLE: dict[str, str] = {
    "op2_line_dedup": LINE_DEDUP,
    "op3_ngram_join": NGRAM_JOIN,
    "op8_quality": QUALITY,
    "op9_topk": TOPK,
    "op10_warc": WARC,
}
