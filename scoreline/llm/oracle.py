"""Expected results as DuckDB SQL, of the operators that SQL can express."""

from __future__ import annotations

HARD_NEGATIVES = """
WITH rows AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label::BIGINT END AS label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
           list_dot_product(a.v, b.v)::BIGINT AS score
    FROM rows a JOIN rows b ON a.vec_id % 100 = 0
), positives AS (
    SELECT anchor_id, id AS positive_id, score AS positive_score
    FROM scored WHERE same AND id <> anchor_id
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT p.anchor_id, p.positive_id,
       row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.id)::INTEGER AS rank,
       n.id AS negative_id, p.positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same
 AND 80 * p.positive_score <= 100 * n.score AND 100 * n.score <= 100 * p.positive_score
QUALIFY rank <= 5
"""

# the table of crc32 by its polynomial; bytes of letters up to U+00FF in UTF-8
SPELLING = """
WITH RECURSIVE crc_table AS (
    SELECT list(r ORDER BY b) AS crc FROM (
        SELECT b, list_reduce(list_prepend(b, [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
            lambda r, k: CASE WHEN r & 1 = 1 THEN xor(3988292384, r >> 1) ELSE r >> 1 END) AS r
        FROM range(256) t(b))
), runs AS (
    SELECT doc_id, run, count(*) AS n FROM (
        SELECT doc_id, unnest(regexp_extract_all(
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS run
        FROM documents)
    GROUP BY doc_id, run
), coded AS (
    SELECT doc_id, run, n, list_prepend(4294967295, flatten(list_transform(
        string_split(coalesce(doc_id::VARCHAR, '') || ':' || run, ''),
        lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT]
                       ELSE [192 | (unicode(c)::BIGINT >> 6), 128 | (unicode(c)::BIGINT & 63)] END))) AS bytes
    FROM runs
), hashed AS (
    SELECT doc_id, run, n, xor(4294967295, list_reduce(bytes, lambda r, b: xor(r >> 8, crc[(xor(r, b) & 255) + 1]))) AS h
    FROM coded, crc_table
), results AS (
    SELECT CASE WHEN doc_id IS NOT NULL AND h % 97 = 0
                THEN left(run, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2) ELSE run END AS word, n
    FROM hashed
), words AS (
    SELECT word, sum(n)::BIGINT AS n FROM results WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3
), skips AS (
    SELECT word, n, i, left(word, i - 1) || substr(word, i + 1) AS rest, left(word, i - 1) AS head
    FROM words, range(1, 1000) t(i) WHERE i <= length(word)
), near AS (
    SELECT a.word, b.word AS other, b.n FROM skips a JOIN skips b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
    UNION SELECT s.word, w.word, w.n FROM skips s JOIN words w ON w.word = s.rest
    UNION SELECT w.word, s.word, s.n FROM skips s JOIN words w ON w.word = s.rest
), best AS (
    SELECT word, count(*) AS n_near, max(n) AS most FROM near GROUP BY word
), forms AS (
    SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.most >= 2 * w.n THEN b.most END AS form_n,
           CASE WHEN b.most >= 2 * w.n
                THEN (SELECT min(x.other) FROM near x WHERE x.word = w.word AND x.n = b.most) END AS form
    FROM words w LEFT JOIN best b ON b.word = w.word
), chain AS (
    SELECT word, form AS at FROM forms WHERE form IS NOT NULL
    UNION SELECT c.word, f.form FROM chain c JOIN forms f ON f.word = c.at WHERE f.form IS NOT NULL
), ends AS (
    SELECT c.word, c.at AS root FROM chain c JOIN forms f ON f.word = c.at WHERE f.form IS NULL
)
SELECT f.word, f.form, coalesce(e.root, f.word) AS root, f.n, f.n_near, f.form_n
FROM forms f LEFT JOIN ends e ON e.word = f.word
"""

SQL = {"op11_anchor_tree": HARD_NEGATIVES, "op12_trie_pairs": SPELLING}
