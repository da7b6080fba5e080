"""DuckDB statements for the queries of the subpackage that SQL can express."""

OP8 = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (
  SELECT row_number() OVER () AS r, doc_id, t,
         regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
         list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS ls
  FROM d),
win AS (
  SELECT r, i, array_to_string(ws[i:i + 7], ' ') AS win
  FROM (SELECT r, ws, unnest(range(1, len(ws) - 6)) AS i FROM w WHERE len(ws) >= 8)),
rep AS (SELECT r, i FROM win QUALIFY count(*) OVER (PARTITION BY r, win) > 1),
cov AS (SELECT r, count(DISTINCT i + k) AS n FROM rep, range(0, 8) AS x(k) GROUP BY r),
m AS (
  SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words,
         CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(cov.n, 0) AS BIGINT) AS n_repeat_words,
         len(ls) AS n_lines,
         length(regexp_replace(t, '[^\p{Lu}]', '', 'g')) AS n_capitals,
         length(regexp_replace(t, '[^\p{L}]', '', 'g')) AS n_letters,
         length(regexp_replace(t, '[^!?]', '', 'g')) AS n_marks
  FROM w LEFT JOIN cov USING (r)),
f AS (
  SELECT *, CAST(
      CASE WHEN n_words < 20 THEN 1 ELSE 0 END
    + CASE WHEN 100 * n_repeat_words > 30 * n_words THEN 2 ELSE 0 END
    + CASE WHEN 10 * n_symbols > 3 * n_words THEN 4 ELSE 0 END
    + CASE WHEN n_dup_lines >= 3 AND 100 * n_dup_lines > 30 * n_lines THEN 8 ELSE 0 END
    + CASE WHEN word_chars < 2 * n_words OR word_chars > 25 * n_words THEN 16 ELSE 0 END
    + CASE WHEN 100 * n_capitals > 60 * word_chars THEN 32 ELSE 0 END
    + CASE WHEN 100 * n_letters < 50 * word_chars THEN 64 ELSE 0 END
    + CASE WHEN 10 * n_marks > 3 * n_words THEN 128 ELSE 0 END AS BIGINT) AS failures
  FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
       failures = 0 AS kept, failures
FROM f
"""

OP11 = """
WITH r AS (
  SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
pairs AS (
  SELECT a.id AS anchor_id, b.id, a.label = b.label AS same,
         CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM r a JOIN r b ON a.id % 100 = 0 AND a.id <> b.id),
pos AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) AS INTEGER) AS rank,
       id AS negative_id, positive_score, score AS negative_score
FROM pos JOIN pairs USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) <= 5
"""

OP12 = r"""
WITH crc AS (
  SELECT list(c ORDER BY n) AS steps FROM (
    SELECT n, list_reduce(list_prepend(n, [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
             lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM (SELECT unnest(range(0, 256)) AS n))),
d AS (
  SELECT doc_id, strlen(t) + 16 AS size, CAST('0x' || substr(md5(t), 1, 15) AS BIGINT) AS h,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS k,
         xor(list_reduce(list_prepend(4294967295, list_transform(
             regexp_extract_all(hex(encode(t)), '..'), lambda p: CAST('0x' || p AS BIGINT))),
           lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1])), 4294967295) AS crc
  FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents), crc),
o AS (
  SELECT *, row_number() OVER w AS place, CAST(sum(size) OVER w AS BIGINT) AS upto,
         lead(h) OVER w IS DISTINCT FROM h AS ends_group, sum(size) OVER () AS total
  FROM d WINDOW w AS (ORDER BY h, k ROWS UNBOUNDED PRECEDING)),
ends AS (
  SELECT place, upto, ends_group, total FROM o
  UNION ALL SELECT 0, 0, true, max(total) FROM o),
e AS (
  SELECT s, place, ends_group, total, abs(40 * upto - total * s) AS error
  FROM ends, (SELECT unnest(range(1, 40)) AS s)),
bounds AS (
  SELECT s, CASE WHEN min(error) FILTER (WHERE ends_group) <= 0.01 * max(total)
                 THEN arg_min(place, error * 1000000000 + place) FILTER (WHERE ends_group)
                 ELSE arg_min(place, error * 1000000000 + place) END AS bound
  FROM e GROUP BY s)
SELECT doc_id, size, crc AS text_crc32, 'bytes' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY h, k) - 1 AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM (SELECT *, CAST((SELECT count(*) FROM bounds WHERE bound < place) AS INTEGER) AS shard FROM o)
"""

ORACLES = {
    "op8_quality_rules": OP8,
    "op11_hard_negatives": OP11,
    "op12_sharding": OP12,
}
