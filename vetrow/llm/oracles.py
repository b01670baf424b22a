"""DuckDB SQL for the queries that SQL can express; the others are tested against brute force."""

_VECTORS = """
ok AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
)"""

NEAREST = f"""WITH {_VECTORS},
d AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         sqrt(list_sum(list_transform(list_zip(q.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))) AS score
  FROM ok q JOIN ok c ON c.vec_id <> q.vec_id WHERE q.vec_id % 100 = 0
),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS INTEGER) AS rank FROM d)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10"""

EMBEDDING_DEDUP = f"""WITH RECURSIVE {_VECTORS},
edges AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_sum(list_transform(list_zip(a.v, b.v), lambda p: p[1] * p[2]))
    >= 0.9 * sqrt(list_sum(list_transform(a.v, lambda x: x * x))) * sqrt(list_sum(list_transform(b.v, lambda x: x * x)))
),
reach(source, node) AS (
  SELECT vec_id, vec_id FROM embeddings UNION SELECT r.source, e.b FROM reach r JOIN edges e ON e.a = r.node
),
least AS (SELECT source AS vec_id, min(node) AS component_id FROM reach GROUP BY source),
degree AS (SELECT a AS vec_id, count(*) AS n FROM edges GROUP BY a)
SELECT l.vec_id, coalesce(n, 0) AS n_links, component_id, l.vec_id = component_id AS kept
FROM least l LEFT JOIN degree d ON d.vec_id = l.vec_id"""

NGRAM_JOIN = r"""WITH RECURSIVE cut AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
  FROM documents
),
shingle AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) < 4 THEN array_to_string(w, ' ') ELSE array_to_string(w[i : i + 3], ' ') END AS s
  FROM cut, unnest(range(1, greatest(len(w) - 2, 2))) AS t(i) WHERE len(w) > 0
),
size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
several AS (SELECT doc_id, s FROM shingle WHERE s IN (SELECT s FROM shingle GROUP BY s HAVING count(*) > 1)),
shared AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM several x JOIN several y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY 1, 2),
edges AS (
  SELECT a, b FROM shared JOIN size m ON m.doc_id = a JOIN size n ON n.doc_id = b WHERE 100 * k >= 85 * (m.n + n.n - k)
),
reach(source, node) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.source, e.b FROM reach r JOIN edges e ON e.a = r.node),
least AS (SELECT source AS doc_id, min(node) AS component_id FROM reach GROUP BY source)
SELECT l.doc_id, coalesce(n, 0) AS n_shingles, component_id FROM least l LEFT JOIN size USING (doc_id)"""

IMPORTANCE = r"""WITH low AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
),
feature AS (
  SELECT doc_id, unnest(list_filter(regexp_split_to_array(t, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '')) AS w FROM low
),
aim AS (
  SELECT unnest(list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '')) AS w FROM benchmark
),
vocabulary AS (SELECT w FROM feature UNION SELECT w FROM aim),
crc_table AS (
  SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) ORDER BY i) AS t
  FROM range(256) AS r(i)
),
bytes AS (
  SELECT w, list_transform(range(octet_length(encode(w))),
    lambda i: CAST('0x' || substr(hex(encode(w)), CAST(2 * i + 1 AS INTEGER), 2) AS BIGINT)) AS b FROM vocabulary
),
bucket AS (
  SELECT w, xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), b),
    lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1]))) % 10000 AS k FROM bytes, crc_table
),
s AS (SELECT k, count(*) AS n FROM feature JOIN bucket USING (w) GROUP BY k),
t AS (SELECT k, count(*) AS n FROM aim JOIN bucket USING (w) GROUP BY k),
gain AS (
  SELECT r.k, CAST(floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * ((SELECT count(*) FROM feature) + 10000)::DOUBLE
    / ((coalesce(s.n, 0) + 1)::DOUBLE * ((SELECT count(*) FROM aim) + 10000)::DOUBLE))) AS BIGINT) AS g
  FROM range(10000) AS r(k) LEFT JOIN s ON s.k = r.k LEFT JOIN t ON t.k = r.k
),
weighed AS (
  SELECT doc_id, count(*) AS n_features, CAST(floor(sum(g)::DOUBLE / count(*)) AS BIGINT) AS weight
  FROM feature JOIN bucket USING (w) JOIN gain USING (k) GROUP BY doc_id
),
scored AS (
  SELECT d.doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || d.doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE)
      / 4294967296::DOUBLE))) AS BIGINT) AS score
  FROM documents d LEFT JOIN weighed w ON w.doc_id = d.doc_id
),
drawn AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n FROM scored WHERE n_features >= 20
)
SELECT s.doc_id, n_features, weight, score, CASE WHEN rank <= 10 * n // 100 THEN rank END AS rank
FROM scored s LEFT JOIN drawn d ON d.doc_id = s.doc_id"""

MIXING = r"""WITH sized AS (
  SELECT doc_id, source, len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '')) AS size FROM documents
),
source AS (
  SELECT source, source_size, 3 * source_size AS cap, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight
  FROM (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source)
),
-- the clamped sources are those with the smallest caps for their weight
filling AS (
  SELECT *, (SELECT sum(source_size) FROM source) - coalesce(sum(cap) OVER before, 0) AS budget, sum(weight) OVER onward AS weights
  FROM source WINDOW before AS (ORDER BY cap::DOUBLE / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
    onward AS (ORDER BY cap::DOUBLE / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
),
level AS (
  SELECT CAST(budget AS DOUBLE) AS budget, CAST(weights AS DOUBLE) AS weights FROM filling WHERE weight * budget <= cap * weights
  ORDER BY cap::DOUBLE / weight, source NULLS LAST LIMIT 1
),
target AS (
  SELECT f.source, f.source_size, CASE WHEN f.weight * f.budget > f.cap * f.weights THEN CAST(f.cap AS DOUBLE)
    ELSE f.weight * l.budget / l.weights END AS target FROM filling f LEFT JOIN level l ON true
),
plan AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS repeats FROM target
),
ahead AS (
  SELECT d.*, p.source_size, target, repeats, least(CAST(floor(target - repeats * p.source_size + 0.5) AS BIGINT), p.source_size) AS rest,
    coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY substr(md5('2024:' || doc_id), 1, 16)
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM sized d JOIN plan p ON d.source IS NOT DISTINCT FROM p.source
),
cut AS (SELECT *, CAST(greatest(0, least(size, rest - before)) AS BIGINT) AS part FROM ahead)
SELECT doc_id, size, source_size, target, repeats, part, repeats * size + part AS taken FROM cut"""

PHRASES = r"""WITH piece AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p FROM documents
),
cut AS (SELECT lang, list_filter(regexp_split_to_array(p, '[\x20\x09]+'), lambda w: w <> '') AS w FROM piece),
size AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM cut GROUP BY lang),
run AS (
  SELECT lang, k, w[i : i + k - 1] AS phrase FROM cut, unnest([1, 2, 3, 4]) AS s(k), unnest(range(1, len(w) - k + 2)) AS t(i)
),
f AS (SELECT lang, phrase, count(*) AS f FROM run GROUP BY lang, phrase HAVING count(*) >= 30),
sides AS (
  SELECT lang, phrase, f AS a, k, phrase[1 : k] AS head, phrase[k + 1 : len(phrase)] AS tail FROM f, unnest([1, 2, 3]) AS s(k) WHERE k < len(phrase)
),
split AS (
  SELECT x.lang, x.phrase, a, k, y.f AS l, z.f AS r, 2000000::HUGEINT * a // (y.f + z.f) AS score
  FROM sides x JOIN f y ON y.lang = x.lang AND y.phrase = x.head JOIN f z ON z.lang = x.lang AND z.phrase = x.tail
),
lowest AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS place FROM split),
held AS (
  SELECT lang, phrase[i : i + m - 1] AS phrase, max(f) AS longer FROM f, unnest([2, 3]) AS s(m), unnest(range(1, len(phrase) - m + 2)) AS t(i)
  WHERE len(phrase) > m GROUP BY 1, 2
),
kept AS (
  SELECT x.lang, array_to_string(x.phrase, ' ') AS phrase, a, l, r, score FROM lowest x
  LEFT JOIN held h ON h.lang = x.lang AND h.phrase = x.phrase WHERE place = 1 AND (longer IS NULL OR 100 * longer < 80 * a)
),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT r.lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM ranked r JOIN size s ON s.lang = r.lang WHERE rank <= 2000"""

ORACLES = {
    "op1_embedding_dedup": EMBEDDING_DEDUP,
    "op9_ngram_join": NGRAM_JOIN,
    "op10_nearest": NEAREST,
    "op11_importance": IMPORTANCE,
    "op12_mixing": MIXING,
    "op13_phrases": PHRASES,
}
