"""DuckDB SQL of the corpus queries that SQL can express, over the same tables."""

from __future__ import annotations

EXACT_DEDUP = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
"""

#: crc32 is linear: a feature's is the XOR of what each byte adds with so many bytes after it, and of the initial value's share
RESAMPLING = r"""
WITH RECURSIVE
bits(i, k, v) AS (
    SELECT i, 0, i::BIGINT FROM range(256) t(i)
    UNION ALL SELECT i, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM bits WHERE k < 8),
one AS (SELECT i, v FROM bits WHERE k = 8),
texts AS (
    SELECT true AS source, doc_id, text FROM documents UNION ALL SELECT false, NULL, text FROM benchmark),
cut AS (
    SELECT row_number() OVER () AS r, source, doc_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts),
runs AS (
    SELECT r, source, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS f FROM cut),
kinds AS (SELECT f, hex(f) AS x, strlen(f) AS n FROM (SELECT DISTINCT f FROM runs)),
longest AS (SELECT coalesce(max(n), 0) AS n FROM kinds),
-- what a byte adds to the remainder when k bytes follow it
after(k, i, v) AS (
    SELECT 0, i, v FROM one
    UNION ALL SELECT k + 1, a.i, xor(a.v >> 8, one.v) FROM after a, one WHERE one.i = a.v & 255 AND k + 1 < (SELECT n FROM longest)),
-- what the initial remainder becomes over n bytes
start(n, v) AS (
    SELECT 0, 4294967295::BIGINT
    UNION ALL SELECT s.n + 1, xor(s.v >> 8, one.v) FROM start s, one WHERE one.i = s.v & 255 AND s.n < (SELECT n FROM longest)),
bytes AS (SELECT f, n, unnest(range(n)) AS p, x FROM kinds),
sums AS (
    SELECT f, b.n, bit_xor(a.v) AS v
    FROM (SELECT f, n, n - 1 - p AS k, ('0x' || substr(x, 2 * p + 1, 2))::BIGINT AS i FROM bytes) b JOIN after a USING (k, i) GROUP BY f, b.n),
buckets AS (SELECT f, xor(xor(sums.v, start.v), 4294967295) % 10000 AS b FROM sums JOIN start USING (n)),
of_text AS (SELECT r, source, b, count(*) AS n FROM runs JOIN buckets USING (f) GROUP BY ALL),
totals AS (
    SELECT b, coalesce(sum(n) FILTER (source), 0)::DOUBLE AS s, coalesce(sum(n) FILTER (NOT source), 0)::DOUBLE AS t FROM of_text GROUP BY b),
gains AS (
    SELECT b, floor(1000 * ln((t + 1) * ((SELECT sum(s) FROM totals) + 10000) / ((s + 1) * ((SELECT sum(t) FROM totals) + 10000))))::BIGINT AS g FROM totals),
weights AS (SELECT r, floor(sum(n * g) / sum(n))::BIGINT AS weight FROM of_text JOIN gains USING (b) WHERE source GROUP BY r),
scored AS (
    SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) + greatest(len(w) - 1, 0))::BIGINT AS n_features, coalesce(weight, 0) AS weight,
           coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('7:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
    FROM cut LEFT JOIN weights USING (r) WHERE source),
ranked AS (
    SELECT *, CASE WHEN n_words >= 20 THEN row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id) END AS place FROM scored)
SELECT doc_id, n_words, n_features, weight, score,
       CASE WHEN place <= (SELECT count(*) FROM scored WHERE n_words >= 20) * 25 // 100 THEN place END AS rank
FROM ranked
"""

HARD_NEGATIVES = """
WITH whole AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
    SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score
    FROM whole a JOIN whole b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
positives AS (
    SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scores WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT anchor_id, positive_id, row_number() OVER w AS rank, other_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scores USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id)
QUALIFY rank <= 3
"""

#: equal sets stand once while pairs are looked for; the classes are what links reach
JACCARD_JOIN = r"""
WITH RECURSIVE
cut AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
    SELECT doc_id, list_sort(list_distinct(CASE
               WHEN len(w) >= 4 THEN list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))
               WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END)) AS shingles FROM cut),
kinds AS (SELECT shingles, min(doc_id) AS name, len(shingles) AS n FROM sets WHERE len(shingles) > 0 GROUP BY shingles),
apart AS (SELECT name, n, unnest(shingles) AS x FROM kinds),
links AS (
    SELECT a.name AS a, b.name AS b FROM apart a JOIN apart b ON a.x = b.x AND a.name <> b.name
    GROUP BY a.name, b.name, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
reach AS (SELECT name AS a, name AS b FROM kinds UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
classes AS (SELECT a AS name, min(b) AS component FROM reach GROUP BY a)
SELECT doc_id, len(sets.shingles)::BIGINT AS n_shingles, coalesce(component, doc_id) AS component_id
FROM sets LEFT JOIN kinds USING (shingles) LEFT JOIN classes USING (name)
"""

SUBSTRING_DEDUP = r"""
WITH cut AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (
    SELECT r, unnest(list_transform(range(1, len(w) - 33), lambda i: {'i': i, 's': sha256(array_to_string(w[i:i + 34], ' '))})) AS x
    FROM cut WHERE len(w) >= 35),
again AS (SELECT r, x.i AS i FROM windows QUALIFY count(*) OVER (PARTITION BY x.s) > 1),
gone AS (SELECT DISTINCT r, unnest(range(i, i + 35)) AS p FROM again),
words AS (SELECT r, unnest(range(1, len(w) + 1)) AS p, unnest(w) AS word FROM cut),
kept AS (SELECT r, string_agg(word, ' ' ORDER BY p) AS text FROM words ANTI JOIN gone USING (r, p) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, (SELECT count(*) FROM gone WHERE gone.r = cut.r) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM cut LEFT JOIN kept USING (r)
"""

#: every pair is compared: what hashing misses would show
EMBEDDING_DEDUP = """
WITH RECURSIVE
unit AS (
    SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM unit a JOIN unit b
    ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.9),
reach AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
classes AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT vec_id, (SELECT count(*) FROM links WHERE links.a = vec_id) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN classes USING (vec_id)
"""

SQL = {
    "op1_exact_dedup": EXACT_DEDUP,
    "op3_jaccard_join": JACCARD_JOIN,
    "op5_substring_dedup": SUBSTRING_DEDUP,
    "op9_embedding_dedup": EMBEDDING_DEDUP,
    "op12_resampling": RESAMPLING,
    "op13_hard_negatives": HARD_NEGATIVES,
}
