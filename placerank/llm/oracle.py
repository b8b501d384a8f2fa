"""DuckDB SQL of the training-data queries that SQL expresses exactly: exact top-k search, the
near-duplicate join and the removal of repeated passages. The others depend on trained models,
tokenizers or hashes and are compared with brute-force versions in the tests."""

# Words of a text: runs of bytes other than \\x20 and \\x09-\\x0D.
_WORDS = "[x for x in string_split_regex(coalesce({text}, ''), '[\\x20\\x09-\\x0D]+') if x <> '']"
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP5 = """
WITH c AS (
  SELECT vec_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
), bad AS (SELECT DISTINCT vec_id FROM c WHERE x IS NULL OR NOT isfinite(x)),
q AS (SELECT vec_id, i, CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) AS x FROM c WHERE vec_id NOT IN (SELECT vec_id FROM bad)),
s AS (
  SELECT a.vec_id AS query_id, b.vec_id, CAST(sum(a.x * b.x) AS BIGINT) AS score
  FROM q a JOIN q b ON a.i = b.i AND a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0 GROUP BY a.vec_id, b.vec_id
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY rank <= 5
"""

OP7 = f"""
WITH RECURSIVE d AS (SELECT doc_id, {_WORDS.format(text=_LOWER)} AS w FROM documents),
sh AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) >= 5 THEN array_to_string(w[i:i + 4], ' ') ELSE array_to_string(w, ' ') END AS s
  FROM (SELECT doc_id, w, unnest(generate_series(1, CASE WHEN len(w) >= 5 THEN len(w) - 4 WHEN len(w) > 0 THEN 1 ELSE 0 END)) AS i
        FROM d)
),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS m FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * m >= 80 * (x.n + y.n - m)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id, doc_id AS o FROM documents UNION SELECT r.doc_id, e.b FROM r JOIN e ON r.o = e.a)
SELECT r.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(o) AS component_id
FROM r LEFT JOIN n ON n.doc_id = r.doc_id GROUP BY r.doc_id
"""

OP8 = f"""
WITH d AS (SELECT doc_id, {_WORDS.format(text="text")} AS w FROM documents),
k AS (
  SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS k
  FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 19)) AS i FROM d)
),
r AS (SELECT doc_id, i FROM k QUALIFY row_number() OVER (PARTITION BY k ORDER BY doc_id, i) > 1),
g AS (SELECT DISTINCT doc_id, unnest(generate_series(i, i + 19)) AS j FROM r),
a AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS j FROM d),
s AS (SELECT a.doc_id, string_agg(word, ' ' ORDER BY a.j) AS t, count(*) AS n FROM a ANTI JOIN g ON a.doc_id = g.doc_id AND a.j = g.j GROUP BY a.doc_id)
SELECT d.doc_id, len(w) AS n_words, len(w) - coalesce(s.n, 0) AS n_removed, sha256(coalesce(s.t, '')) AS kept_sha256
FROM d LEFT JOIN s ON d.doc_id = s.doc_id
"""

ORACLE = {"op5_topk": OP5, "op7_near_duplicates": OP7, "op8_substring_dedup": OP8}
