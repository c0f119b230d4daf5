"""DuckDB SQL for the queries that SQL can express.

Classifiers, fields, forests, permutations, XXH64 and backoff weights are not
expressible; their operators are tested against brute force.
"""

from __future__ import annotations

OP2 = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
    ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
reach(a, b) AS (
  SELECT vec_id, vec_id FROM embeddings
  UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY 1)
SELECT vec_id, (SELECT count(*) FROM links WHERE links.a = vec_id) AS n_links, component_id,
  vec_id = component_id AS kept
FROM embeddings JOIN least ON vec_id = a
"""

OP9 = """
WITH texts AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n
  FROM documents),
windows AS (
  SELECT doc_id, p, substr(h, 2 * p - 1, 100) AS s
  FROM (SELECT doc_id, h, unnest(range(1, n - 48)) AS p FROM texts)),
repeated AS (
  SELECT doc_id, p FROM (SELECT *, min(doc_id) OVER (PARTITION BY s) AS first FROM windows)
  WHERE first < doc_id),
bytes AS (
  SELECT t.doc_id, t.p, byte, max(r.p) OVER (PARTITION BY t.doc_id
    ORDER BY t.p ROWS UNBOUNDED PRECEDING) >= t.p - 49 AS covered
  FROM (SELECT doc_id, unnest(regexp_extract_all(h, '..')) AS byte,
    unnest(range(1, n + 1)) AS p FROM texts) t
  LEFT JOIN repeated r ON r.doc_id = t.doc_id AND r.p = t.p),
marked AS (
  SELECT doc_id, p, byte, coalesce(covered, false) AS gone,
    lag(coalesce(covered, false), 1, false) OVER (PARTITION BY doc_id ORDER BY p) AS before
  FROM bytes),
counted AS (
  SELECT doc_id, count(*) FILTER (gone) AS n_removed,
    count(*) FILTER (gone AND NOT before) AS n_spans,
    string_agg(byte, '' ORDER BY p) FILTER (NOT gone) AS kept
  FROM marked GROUP BY 1)
SELECT doc_id, n AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM texts LEFT JOIN counted USING (doc_id)
"""

OP10 = r"""
WITH texts AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (
  SELECT doc_id, p, array_to_string(w[p:p + 34], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS p FROM texts)),
repeated AS (
  SELECT doc_id, p FROM (SELECT *, count(*) OVER (PARTITION BY s) AS n FROM windows) WHERE n > 1),
words AS (
  SELECT t.doc_id, t.p, word, coalesce(max(r.p) OVER (PARTITION BY t.doc_id
    ORDER BY t.p ROWS UNBOUNDED PRECEDING) >= t.p - 34, false) AS gone
  FROM (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM texts) t
  LEFT JOIN repeated r ON r.doc_id = t.doc_id AND r.p = t.p),
counted AS (
  SELECT doc_id, count(*) FILTER (gone) AS n_removed,
    string_agg(word, ' ' ORDER BY p) FILTER (NOT gone) AS kept
  FROM words GROUP BY 1)
SELECT doc_id, len(w) AS n_words, coalesce(n_removed, 0) AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM texts LEFT JOIN counted USING (doc_id)
"""

# Triplets of bytes hash by the product's upper byte; 64, 128 and 192 are the places of the
# quartiles among 256 counts; a digest's length grows by steps of an eighth.
OP11 = r"""
WITH RECURSIVE steps(reached, k) AS (
  SELECT 1::BIGINT, 1
  UNION ALL SELECT reached + greatest(1, reached // 8), k + 1 FROM steps WHERE k < 255),
ordered AS (
  SELECT doc_id, coalesce(text, '') AS t,
    row_number() OVER (ORDER BY doc_id NULLS FIRST) AS i, count(*) OVER () AS n FROM documents),
texts AS (
  SELECT a.doc_id, a.i, b.i AS next, a.t,
    left(a.t, length(a.t) - length(a.t) // 4) || left(b.t, length(a.t) // 4) AS e
  FROM ordered a JOIN ordered b ON b.i = a.i % a.n + 1),
both_texts AS (
  SELECT i, 0 AS which, hex(encode(t)) AS h FROM texts
  UNION ALL SELECT i, 1, hex(encode(e)) FROM texts),
bytes AS (
  SELECT i, which, ('0x' || byte)::BIGINT AS b0, lead(byte_value, 1) OVER w AS b1,
    lead(byte_value, 2) OVER w AS b2, lead(byte_value, 3) OVER w AS b3
  FROM (SELECT *, ('0x' || byte)::BIGINT AS byte_value FROM (
    SELECT i, which, unnest(regexp_extract_all(h, '..')) AS byte,
      unnest(range(length(h) // 2)) AS p FROM both_texts))
  WINDOW w AS (PARTITION BY i, which ORDER BY p)),
triplets AS (
  SELECT i, which, b0 + b1 * 256 + b2 * 65536 AS v FROM bytes WHERE b2 IS NOT NULL
  UNION ALL
  SELECT i, which, b0 + b1 * 256 + b3 * 65536 + 16777216 FROM bytes WHERE b3 IS NOT NULL
  UNION ALL
  SELECT i, which, b0 + b2 * 256 + b3 * 65536 + 33554432 FROM bytes WHERE b3 IS NOT NULL),
found AS (
  SELECT i, which, ((v * 2654435761) % 4294967296) // 16777216 AS bucket, count(*) AS c
  FROM triplets GROUP BY ALL),
counts AS (
  SELECT t.i, t.which, k.bucket, coalesce(c, 0) AS c
  FROM both_texts t CROSS JOIN (SELECT unnest(range(256)) AS bucket) k
  LEFT JOIN found f ON f.i = t.i AND f.which = t.which AND f.bucket = k.bucket),
quartiles AS (
  SELECT i, which, list_sort(list(c)) AS s FROM counts GROUP BY ALL),
codes AS (
  SELECT i, which, bucket,
    (c > s[64])::BIGINT + (c > s[128])::BIGINT + (c > s[192])::BIGINT AS code
  FROM counts JOIN quartiles USING (i, which)),
sizes AS (
  SELECT i, which, (SELECT count(*) FROM steps WHERE reached <= length(h) // 2) AS size
  FROM both_texts),
digests AS (
  SELECT i, which, list(code ORDER BY bucket) AS codes,
    [count(*) FILTER (code = 0), count(*) FILTER (code = 1), count(*) FILTER (code = 2),
      count(*) FILTER (code = 3)] AS many,
    any_value(size) AS size,
    string_agg(CASE WHEN bucket % 2 = 0 THEN
      substr('0123456789abcdef', 1 + 4 * code + after, 1) ELSE '' END, '' ORDER BY bucket) AS head
  FROM (SELECT *, lead(code) OVER (PARTITION BY i, which ORDER BY bucket) AS after FROM codes)
  JOIN sizes USING (i, which) GROUP BY i, which),
named AS (
  SELECT *, head || lower(printf('%02x', size)) AS digest FROM digests),
pairs AS (
  SELECT i, i AS j, 1 AS which FROM texts UNION ALL SELECT i, next, 0 FROM texts),
parts AS (
  SELECT p.i, p.which, least(20, abs(a.size - b.size)) AS steps,
    list_sum(list_transform(list_zip(a.codes, b.codes), lambda x: abs(x[1] - x[2])))::BIGINT AS body,
    (SELECT sum(abs(x - y) * a.many[x + 1] * b.many[y + 1])
      FROM (SELECT unnest(range(4)) AS x) CROSS JOIN (SELECT unnest(range(4)) AS y))::BIGINT AS chance
  FROM pairs p JOIN named a ON a.i = p.i AND a.which = 0
  JOIN named b ON b.i = p.j AND b.which = p.which),
likes AS (
  SELECT i, which, CASE WHEN chance = 0 THEN (20 - steps)::DOUBLE / 20 ELSE
    greatest(0, 20 * (chance - 256 * body) - steps * chance)::DOUBLE / (20 * chance) END AS near
  FROM parts)
SELECT t.doc_id, length(t.t) AS n_chars, sha256(t.e) AS edited_sha256, a.digest AS fingerprint,
  b.digest AS edited_fingerprint, x.near AS near_edited, y.near AS near_next
FROM texts t JOIN named a ON a.i = t.i AND a.which = 0 JOIN named b ON b.i = t.i AND b.which = 1
JOIN likes x ON x.i = t.i AND x.which = 1 JOIN likes y ON y.i = t.i AND y.which = 0
"""

_ROUND = """
apart{n} AS (
  SELECT u.part, u.v, b.entry, list_sum(list_transform(list_zip(u.v, b.c),
    lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
  FROM (SELECT DISTINCT part, v FROM pieces) u JOIN book{n} b ON b.part = u.part),
near{n} AS (
  SELECT part, v, entry, d FROM apart{n}
  QUALIFY row_number() OVER (PARTITION BY part, v ORDER BY d, entry) = 1)"""

_MOVE = """,
sums{n} AS (
  SELECT p.part, entry, k, sum(p.v[k])::BIGINT AS total, count(*) AS many
  FROM pieces p JOIN near{n} a ON a.part = p.part AND a.v = p.v
  CROSS JOIN (SELECT unnest(range(1, width + 1)) AS k FROM dims) GROUP BY ALL),
means{n} AS (
  SELECT part, entry, list((total - (total % many + many) % many) // many ORDER BY k) AS c
  FROM sums{n} GROUP BY ALL),
book{m} AS (
  SELECT b.part, b.entry, coalesce(m.c, b.c) AS c
  FROM book{n} b LEFT JOIN means{n} m ON m.part = b.part AND m.entry = b.entry),"""

OP12 = (
    """
WITH kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS x,
    row_number() OVER (ORDER BY vec_id NULLS LAST) AS i
  FROM embeddings WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
dims AS (SELECT len(x) // 16 AS width FROM kept LIMIT 1),
pieces AS (
  SELECT vec_id, label, i, part, x[part * width + 1 : (part + 1) * width] AS v
  FROM kept, dims, (SELECT unnest(range(16)) AS part)),
book0 AS (SELECT part, i - 1 AS entry, v AS c FROM pieces WHERE i <= 64),"""
    + "".join(_ROUND.format(n=n) + (_MOVE.format(n=n, m=n + 1) if n < 2 else "") for n in range(3))
    + """,
codes AS (
  SELECT p.vec_id, p.i, p.label, string_agg(printf('%02x', a.entry), '' ORDER BY p.part) AS code,
    sum(a.d)::BIGINT AS error
  FROM pieces p JOIN near2 a ON a.part = p.part AND a.v = p.v GROUP BY ALL)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
  (SELECT sha256(string_agg(c[k]::VARCHAR, ',' ORDER BY part, entry, k))
   FROM book2, (SELECT unnest(range(1, width + 1)) AS k FROM dims)) AS codebooks_sha256
FROM codes
"""
)

ORACLES: dict[str, str] = {
    "op2_embedding_links": OP2,
    "op9_suffix_repeats": OP9,
    "op10_repeated_windows": OP10,
    "op11_text_digests": OP11,
    "op12_vector_codes": OP12,
}
