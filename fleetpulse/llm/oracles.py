"""The training-data queries that DuckDB can express, from their definitions."""

ORACLES = {
    "op12_phrase_collocations": r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
worded AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
grams AS (
  SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
  FROM worded, (SELECT unnest([1, 2, 3]) AS k) WHERE len(w) >= k),
f AS MATERIALIZED (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL),
totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
candidate AS (SELECT lang, k AS size, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND f >= 10),
part AS MATERIALIZED (
  SELECT lang, size, phrase, a, k, array_to_string(w[1:k], ' ') AS head, array_to_string(w[k + 1:], ' ') AS rest
  FROM candidate, (SELECT unnest([1, 2]) AS k) WHERE k < size),
cut AS (
  SELECT p.lang, p.size, p.phrase, p.a, p.k, x.f AS l, y.f AS r,
         CAST(1000000::HUGEINT * p.a * p.a // (x.f::HUGEINT * y.f) AS BIGINT) AS score
  FROM part p JOIN f x ON x.lang = p.lang AND x.phrase = p.head JOIN f y ON y.lang = p.lang AND y.phrase = p.rest),
lowest AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
covered AS (
  SELECT lang, phrase, max(a) AS a FROM (
    SELECT lang, array_to_string(w[1:2], ' ') AS phrase, a FROM candidate WHERE size = 3
    UNION ALL SELECT lang, array_to_string(w[2:3], ' '), a FROM candidate WHERE size = 3) GROUP BY ALL),
ranked AS (
  SELECT l.*, row_number() OVER (PARTITION BY l.lang ORDER BY score DESC, l.a DESC, l.phrase) AS rank
  FROM lowest l LEFT JOIN covered c ON c.lang = l.lang AND c.phrase = l.phrase
  WHERE c.a IS NULL OR 100 * c.a < 50 * l.a)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
""",
    "op13_spelling_variants": r"""
WITH RECURSIVE steps AS (
  SELECT i::BIGINT AS byte, 0 AS step, i::BIGINT AS c FROM range(256) t(i)
  UNION ALL
  SELECT byte, step + 1, CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END FROM steps WHERE step < 8),
crc AS MATERIALIZED (SELECT list(c ORDER BY byte) AS crc FROM steps WHERE step = 8),
runs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{00C0}-\x{00FF}]+')) AS run
  FROM documents),
counted AS MATERIALIZED (SELECT doc_id, run, length(run) AS size, count(*) AS n FROM runs WHERE length(run) >= 7 GROUP BY ALL),
summed AS MATERIALIZED (
  SELECT doc_id, run, size, n,
    xor(list_reduce(
      flatten(list_transform(string_split(concat(doc_id, ':', run), ''), lambda x: CASE WHEN unicode(x) < 128 THEN [unicode(x)::BIGINT] ELSE [195::BIGINT, unicode(x)::BIGINT - 64] END)),
      lambda h, x: xor(h >> 8, crc[(xor(h, x) & 255) + 1]), 4294967295::BIGINT), 4294967295::BIGINT) AS h
  FROM counted, crc),
harmed AS (
  SELECT CASE WHEN h % 31 = 0 THEN left(run, (h % size)::INT) || substr(run, (h % size)::INT + 2) ELSE run END AS word, n FROM summed),
word AS MATERIALIZED (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM harmed WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
shorter AS MATERIALIZED (
  SELECT word, n, i, left(word, i - 1) || substr(word, i + 1) AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1))::INT AS i FROM word)),
pair AS MATERIALIZED (
  SELECT DISTINCT s.word AS word, s.n AS n, w.word AS other, w.n AS other_n FROM shorter s JOIN word w ON s.rest = w.word
  UNION SELECT DISTINCT w.word, w.n, s.word, s.n FROM shorter s JOIN word w ON s.rest = w.word
  UNION SELECT DISTINCT s.word, s.n, o.word, o.n FROM shorter s JOIN shorter o ON s.rest = o.rest AND s.i = o.i WHERE s.word <> o.word),
near AS MATERIALIZED (
  SELECT word, n, count(*) OVER (PARTITION BY word) AS n_near, other, other_n FROM pair
  QUALIFY row_number() OVER (PARTITION BY word ORDER BY other_n DESC, other) = 1),
form AS MATERIALIZED (SELECT word, other AS form, other_n AS form_n FROM near WHERE other_n >= 10 * n),
walk AS (
  SELECT word, form AS root FROM form
  UNION ALL SELECT w.word, f.form FROM walk w JOIN form f ON f.word = w.root),
root AS (SELECT word, root FROM walk w WHERE NOT EXISTS (SELECT 1 FROM form f WHERE f.word = w.root))
SELECT w.word, f.form, coalesce(r.root, w.word) AS root, w.n, CAST(coalesce(x.n_near, 0) AS BIGINT) AS n_near, f.form_n
FROM word w LEFT JOIN near x USING (word) LEFT JOIN form f USING (word) LEFT JOIN root r USING (word)
""",
}
