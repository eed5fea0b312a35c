"""SQL for the queries that SQL can express, over whole tables."""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

SHINGLE_JACCARD = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [w]
    ELSE list_transform(range(1, len(w) - 1), lambda s: w[s : s + 2]) END) AS shingle FROM words
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), links AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
  WHERE 100 * least(x.n, y.n) >= 90 * greatest(x.n, y.n)
  GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 90 * (x.n + y.n - count(*))
), reached AS (
  SELECT doc_id AS node, doc_id AS other FROM documents
  UNION SELECT r.node, l.b FROM reached r JOIN links l ON l.a = r.other
), least_reached AS (
  SELECT node, min(other) AS component_id FROM reached GROUP BY node
)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, c.component_id
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id JOIN least_reached c ON c.node = d.doc_id
"""

TOP_K = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda t: t[1] * t[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
), ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
  FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""

_WORDS = f"regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

PHRASES = f"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents
), items AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id, {_WORDS} AS w FROM benchmark
), sized AS (
  SELECT item_id, w, least(len(w), 10) AS n FROM items WHERE len(w) > 0
), wanted AS (
  SELECT DISTINCT item_id, n, unnest(list_transform(range(1, len(w) - n + 2), lambda s: array_to_string(w[s : s + n - 1], ' '))) AS phrase
  FROM sized
), lengths AS (
  SELECT DISTINCT n FROM wanted
), places AS (
  SELECT r, n, unnest(range(1, len(w) - n + 2)) AS s, w FROM docs, lengths WHERE len(w) >= n
), found AS (
  SELECT p.r, p.n, p.s, x.item_id FROM places p JOIN wanted x ON x.n = p.n AND x.phrase = array_to_string(p.w[p.s : p.s + p.n - 1], ' ')
), covered AS (
  SELECT r, count(DISTINCT place) AS n_hit FROM (SELECT r, unnest(range(s, s + n)) AS place FROM found) GROUP BY r
), listed AS (
  SELECT r, list_sort(list(DISTINCT item_id)) AS ids FROM found GROUP BY r
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(c.n_hit, 0) AS n_hit,
  CAST(coalesce(len(l.ids), 0) AS BIGINT) AS n_items, sha256(coalesce(array_to_string(l.ids, ','), '')) AS items_sha256,
  c.n_hit IS NOT NULL AS contaminated
FROM docs d LEFT JOIN covered c ON c.r = d.r LEFT JOIN listed l ON l.r = d.r
"""

_ALL_WORDS = "regexp_extract_all(coalesce(text, ''), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"
_LOWERED = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_CRC_BIT = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END"

RESAMPLE = f"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents
), used AS (
  SELECT r, unnest(w) AS word FROM docs
), wanted AS (
  SELECT unnest({_WORDS}) AS word FROM benchmark
), spelled AS (
  SELECT word, list_transform(range(0, strlen(word)), lambda i: ('0x' || substr(hex(encode(word)), 2 * i + 1, 2))::UBIGINT) AS bytes
  FROM (SELECT word FROM used UNION SELECT word FROM wanted)
), hashed AS (
  SELECT word, CAST(xor(list_reduce(bytes, lambda s, b: list_reduce(range(0, 8), lambda c, k: {_CRC_BIT}, xor(s, b)),
    4294967295::UBIGINT), 4294967295::UBIGINT) % 10000 AS BIGINT) AS bucket FROM spelled
), source AS (
  SELECT bucket, count(*) AS s FROM used JOIN hashed USING (word) GROUP BY bucket
), target AS (
  SELECT bucket, count(*) AS t FROM wanted JOIN hashed USING (word) GROUP BY bucket
), gains AS (
  SELECT b.bucket, CAST(floor(1000 * ln((coalesce(t, 0) + 1.0::DOUBLE) * ((SELECT count(*) FROM used) + 10000)
    / ((coalesce(s, 0) + 1.0::DOUBLE) * ((SELECT count(*) FROM wanted) + 10000)))) AS BIGINT) AS gain
  FROM (SELECT DISTINCT bucket FROM hashed) b LEFT JOIN source USING (bucket) LEFT JOIN target USING (bucket)
), weights AS (
  SELECT r, CAST(sum(gain) AS BIGINT) AS weight FROM used JOIN hashed USING (word) JOIN gains USING (bucket) GROUP BY r
), scored AS (
  SELECT r, doc_id, CAST(len(w) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln(
    (('0x' || substr(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296.0::DOUBLE))) AS BIGINT) AS score
  FROM docs LEFT JOIN weights USING (r)
), ranked AS (
  SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, n_features DESC) AS place, (10 * count(*) OVER ()) // 100 AS drawn
  FROM scored WHERE n_features >= 20
)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= drawn THEN place END AS rank FROM scored LEFT JOIN ranked USING (r)
"""

_KEY = _LOWERED.format("regexp_replace(line, '^[\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+$', '', 'g')")

LINES = f"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents
), lines AS (
  SELECT r, doc_id, unnest(l) AS line, unnest(range(0, len(l))) AS place FROM docs
), keyed AS (
  SELECT r, doc_id, line, place, {_KEY} AS key FROM lines
), common AS (
  SELECT key, max(doc_id) AS keep FROM keyed WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), marked AS (
  SELECT k.r, k.line, k.place, c.key IS NOT NULL AND k.doc_id IS NOT NULL AND k.doc_id <> c.keep AS gone FROM keyed k LEFT JOIN common c ON c.key = k.key
), told AS (
  SELECT r, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
    coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT gone), '') AS kept FROM marked GROUP BY r
)
SELECT doc_id, n_lines, n_dropped, sha256(kept) AS kept_sha256 FROM docs JOIN told USING (r)
"""

SEARCH = f"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, {_ALL_WORDS} AS w FROM documents
), used AS (
  SELECT r, {_LOWERED.format('unnest(w)')} AS term FROM docs
), counted AS (
  SELECT r, term, count(*) AS tf FROM used GROUP BY r, term
), total AS (
  SELECT count(*) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS n_terms FROM docs WHERE len(w) > 0
), norms AS (
  SELECT r, doc_id, 25 + (75 * len(w) * n_docs) // n_terms AS m FROM docs, total WHERE len(w) > 0
), weights AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * max(n_docs) + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS weight FROM counted, total GROUP BY term
), items AS (
  SELECT row_number() OVER () AS i, item_id, {_ALL_WORDS} AS w FROM benchmark
), asked AS (
  SELECT i, term, count(*) AS often FROM (SELECT i, {_LOWERED.format('unnest(w)')} AS term FROM items) GROUP BY i, term
), scored AS (
  SELECT i, r, doc_id, CAST(sum(often * weight * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM asked JOIN counted USING (term) JOIN weights USING (term) JOIN norms USING (r) GROUP BY i, r, doc_id
), ranked AS (
  SELECT i, doc_id, score, CAST(row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank
  FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked JOIN items USING (i) WHERE rank <= 10
"""
