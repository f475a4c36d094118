"""SQL, for DuckDB, of the queries that SQL can express over whole tables."""

from __future__ import annotations

# crc32 of a text, byte by byte over a table of 256 entries made by the polynomial's rule
CRC_TABLE = """(SELECT list(v ORDER BY i) FROM (SELECT i, list_reduce([i] || range(8),
    lambda c, step: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(256) t(i)))"""

SHARDING = f"""
WITH crc AS (SELECT {CRC_TABLE} AS entries),
bytes AS (
  SELECT doc_id, source, coalesce(text, '') AS text, hex(encode(coalesce(text, ''))) AS h FROM documents),
rows AS (
  SELECT doc_id, source, length(h) // 2 + 8 AS size,
    xor(list_reduce([4294967295::BIGINT] || list_transform(range(0, length(h) // 2),
          lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT),
        lambda c, b: xor(c >> 8, entries[(xor(c, b) & 255) + 1])), 4294967295) AS text_crc32,
    ('0x' || substr(md5('17:' || doc_id::VARCHAR), 1, 15))::BIGINT AS draw
  FROM bytes, crc),
ranked AS (
  SELECT *, (2 * row_number() OVER (PARTITION BY source ORDER BY draw, doc_id) - 1)::DOUBLE
            / (2 * count(*) OVER (PARTITION BY source)) AS fraction FROM rows),
placed AS (
  SELECT *, row_number() OVER (ORDER BY fraction, source, draw, doc_id) - 1 AS position, count(*) OVER () AS whole
  FROM ranked)
SELECT doc_id, size, text_crc32, 'rows' AS law, ((position * 24) // whole)::INTEGER AS shard,
  position - (((position * 24) // whole) * whole + 23) // 24 AS slot, NULL::INTEGER AS grown_shard
FROM placed
"""

JACCARD = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s
  FROM words),
sizes AS (SELECT doc_id, len(s)::BIGINT AS n FROM sets),
shingles AS (SELECT doc_id, unnest(s) AS shingle FROM sets),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM shingles a JOIN shingles b USING (shingle)
  JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 80 * (x.n + y.n - count(*))),
reach(a, b) AS (
  SELECT doc_id, doc_id FROM sizes UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b)
SELECT doc_id, n AS n_shingles, component_id FROM sizes
JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) USING (doc_id)
"""

WARC = """
WITH hashed AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages),
firsts AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS first FROM hashed)
SELECT page_id, payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + ((('0x' || substr(h, 5 * (i // 4) + 1, 5))::INTEGER >> (15 - 5 * (i % 4))) & 31), 1)), '') AS payload_digest,
  CASE WHEN page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id > first THEN first END AS refers_to
FROM firsts
"""

CODE_ROUNDS = 4
_NEAREST = """SELECT n, p, part, min(distance * 256 + e) AS found FROM (
    SELECT n, parts.p, part, e, list_sum(list_transform(range(1, len(part) + 1),
      lambda i: (part[i] - entry[i]) * (part[i] - entry[i])))::BIGINT AS distance
    FROM parts JOIN {books} books ON books.p = parts.p) GROUP BY n, p, part"""
_MOVED = """SELECT books.p, books.e, coalesce(moved, entry) AS entry FROM {books} books LEFT JOIN (
    SELECT p, e, list(x ORDER BY i) AS moved FROM (
      SELECT p, found % 256 AS e, i, ((sum(part[i]) - ((sum(part[i]) % count(*)) + count(*)) % count(*))
        // count(*))::BIGINT AS x
      FROM nearest{r}, range(1, (SELECT max(len(part)) FROM parts) + 1) places(i) GROUP BY p, e, i) GROUP BY p, e) sums
    ON sums.p = books.p AND sums.e = books.e"""

VECTOR_CODES = """
WITH kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v,
    row_number() OVER (ORDER BY vec_id) - 1 AS n
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS (SELECT n, p, v[(p * (len(v) // 4) + 1):((p + 1) * (len(v) // 4))] AS part FROM kept, range(4) positions(p)),
books0 AS (SELECT p, n AS e, part AS entry FROM parts WHERE n < 256),
""" + "".join(f"nearest{r} AS ({_NEAREST.format(books=f'books{r}')}),\n"
              f"books{r + 1} AS ({_MOVED.format(books=f'books{r}', r=r)}),\n" for r in range(CODE_ROUNDS)) + f"""
assigned AS ({_NEAREST.format(books=f'books{CODE_ROUNDS}')}),
digest AS (
  SELECT sha256(string_agg(array_to_string(entry, ','), ',' ORDER BY p, e)) AS sha FROM books{CODE_ROUNDS}),
coded AS (
  SELECT n, string_agg(printf('%02x', found % 256), '' ORDER BY p) AS code, sum(found // 256)::BIGINT AS error
  FROM assigned GROUP BY n)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, sha AS codebooks_sha256
FROM kept JOIN coded USING (n), digest
"""

SQL = {"op2_sharding": SHARDING, "op6_jaccard": JACCARD, "op7_warc": WARC, "op13_vector_codes": VECTOR_CODES}
