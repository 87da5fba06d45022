"""SQL counterparts, for the operators that SQL can express."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

ORACLES["op10_substring_dedup"] = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), n AS (
  SELECT doc_id, ws, len(ws) AS n FROM w
), win AS (
  SELECT doc_id, p, sha256(array_to_string(ws[p:p + 49], ' ')) AS h
  FROM (SELECT doc_id, ws, unnest(range(1, n - 48)) AS p FROM n WHERE n >= 50)
), hit AS (
  SELECT doc_id, p FROM (SELECT doc_id, p, min(doc_id) OVER (PARTITION BY h) AS owner FROM win) WHERE owner < doc_id
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(p, p + 50)) AS p FROM hit
), word AS (
  SELECT doc_id, unnest(ws) AS word, unnest(range(1, n + 1)) AS p FROM n
), kept AS (
  SELECT word.doc_id, count(gone.p) AS n_removed,
         coalesce(string_agg(word, ' ' ORDER BY word.p) FILTER (gone.p IS NULL), '') AS kept
  FROM word LEFT JOIN gone ON word.doc_id = gone.doc_id AND word.p = gone.p GROUP BY word.doc_id
)
SELECT n.doc_id, n.n::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM n LEFT JOIN kept ON n.doc_id = kept.doc_id
"""

ORACLES["op3_vector_dedup"] = """
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
    AND len([x FOR x IN embedding IF x <> 0]) > 0
), link AS (
  SELECT a.vec_id AS u, b.vec_id AS w FROM v a JOIN v b ON a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.95
), reach(u, w) AS (
  SELECT u, w FROM link UNION SELECT r.u, l.w FROM reach r JOIN link l ON r.w = l.u
)
SELECT e.vec_id, (SELECT count(*) FROM link WHERE u = e.vec_id) AS n_links,
       least(e.vec_id, coalesce((SELECT min(w) FROM reach WHERE u = e.vec_id), e.vec_id)) AS component_id,
       e.vec_id <= coalesce((SELECT min(w) FROM reach WHERE u = e.vec_id), e.vec_id) AS kept
FROM embeddings e
"""

ORACLES["op6_hyperminhash"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS ws FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(ws[p:p + 2], ' ') AS shingle
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 1, 2))) AS p FROM w WHERE len(ws) > 0)
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), link AS (
  SELECT x.u, x.w FROM (
    SELECT a.doc_id AS u, b.doc_id AS w, count(*) AS both FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
    GROUP BY a.doc_id, b.doc_id
  ) x JOIN n na ON na.doc_id = x.u JOIN n nb ON nb.doc_id = x.w WHERE 100 * x.both >= 85 * (na.n + nb.n - x.both)
), reach(u, w) AS (
  SELECT u, w FROM link UNION SELECT r.u, l.w FROM reach r JOIN link l ON r.w = l.u
), least_reached AS (
  SELECT u, min(w) AS w FROM reach GROUP BY u
)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, least(d.doc_id, coalesce(r.w, d.doc_id)) AS component_id,
       d.doc_id <= coalesce(r.w, d.doc_id) AS kept
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN least_reached r ON r.u = d.doc_id
"""

ORACLES["op8_block_search"] = """
WITH v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
    AND len([x FOR x IN embedding IF x <> 0]) > 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0
), r AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""

ORACLES["op2_suffix_dedup"] = """
WITH d AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents
), w AS (
  SELECT doc_id, p, md5_number(substr(x, 2 * p + 1, 800)) AS h
  FROM (SELECT doc_id, x, unnest(range(0, len(x) // 2 - 399)) AS p FROM d WHERE len(x) >= 800)
), hit AS (
  SELECT doc_id, p FROM (SELECT doc_id, p, count(*) OVER (PARTITION BY h) AS n FROM w) WHERE n > 1
), step AS (
  SELECT doc_id, p, p - coalesce(lag(p) OVER (PARTITION BY doc_id ORDER BY p), -1000) > 400 AS fresh FROM hit
), span AS (
  SELECT doc_id, min(p) AS a, max(p) + 400 AS b
  FROM (SELECT doc_id, p, count(*) FILTER (fresh) OVER (PARTITION BY doc_id ORDER BY p) AS g FROM step) GROUP BY doc_id, g
), cut AS (
  SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM span
), kept AS (
  SELECT cut.doc_id, sum(b - a) AS gone, count(*) AS spans,
         string_agg(substr(x, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) || substr(any_value(x), 2 * max(b) + 1) AS x
  FROM cut JOIN d ON d.doc_id = cut.doc_id GROUP BY cut.doc_id
)
SELECT d.doc_id, (len(d.x) // 2)::BIGINT AS n_bytes, coalesce(gone, 0)::BIGINT AS n_removed, coalesce(spans, 0)::BIGINT AS n_spans,
       sha256(unhex(coalesce(kept.x, d.x))) AS kept_sha256
FROM d LEFT JOIN kept ON kept.doc_id = d.doc_id
"""

# CRC-32 of a decimal number: eight steps with the polynomial, reversed, per character.
CRC32 = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
    lambda c, x: list_reduce([xor(c, x), 0, 0, 0, 0, 0, 0, 0, 0], lambda r, i: xor(r >> 1, 3988292384::BIGINT * (r & 1)))), 4294967295::BIGINT)"""

ORACLES["op12_periodic_runs"] = rf"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), c AS (
  SELECT doc_id, ws, len(ws)::BIGINT AS n, {CRC32} AS h FROM w
), e AS (
  SELECT doc_id, ws, n, h % 10 = 0 AND n > 0 AS changed, CASE WHEN n > 0 THEN (h // 10) % n ELSE 0 END AS a, h // 10 AS g FROM c
), d AS (
  SELECT doc_id, n, CASE WHEN changed THEN ws[1:a] || list_transform(range(0, n - a), lambda i: ws[a + 1 + i % (1 + (n - a) // (3 + g % 8))])
                    ELSE ws END AS ws FROM e
), word AS (
  SELECT doc_id, n, unnest(ws) AS word, unnest(range(0, n)) AS i FROM d
), equal AS (
  SELECT a.doc_id, b.i - a.i AS q, a.i FROM word a JOIN word b ON a.doc_id = b.doc_id AND a.word = b.word AND b.i > a.i
  WHERE 4 * (b.i - a.i) <= a.n
), island AS (
  SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS k FROM equal
), stretch AS (
  SELECT doc_id, q, min(i) AS start, count(*) + q AS length FROM island GROUP BY doc_id, q, k
  HAVING count(*) + q >= greatest(6, 4 * q)
), run AS (
  SELECT doc_id, start, length, min(q) AS period FROM stretch GROUP BY doc_id, start, length
), total AS (
  SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS runs FROM run GROUP BY doc_id
), longest AS (
  SELECT * FROM run QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY length DESC, start, period) = 1
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM run
), kept AS (
  SELECT word.doc_id, string_agg(word, ' ' ORDER BY word.i) AS words
  FROM word LEFT JOIN gone ON word.doc_id = gone.doc_id AND word.i = gone.i WHERE gone.i IS NULL GROUP BY word.doc_id
)
SELECT d.doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, start::BIGINT AS start, length::BIGINT AS length, period::BIGINT AS period,
       ((1000 * length) // period)::BIGINT AS exponent_milli, sha256(coalesce(runs, '')) AS runs_sha256,
       sha256(coalesce(words, '')) AS collapsed_sha256
FROM d LEFT JOIN total ON total.doc_id = d.doc_id LEFT JOIN longest ON longest.doc_id = d.doc_id LEFT JOIN kept ON kept.doc_id = d.doc_id
"""

ORACLES["op11_collocations"] = r"""
WITH piece AS (
  SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS ws
  FROM documents
), n AS (
  SELECT lang, sum(len(ws))::BIGINT AS n FROM piece GROUP BY lang
), f AS (
  SELECT lang, m, phrase, count(*) AS a FROM (
    SELECT lang, m, array_to_string(ws[p:p + m - 1], ' ') AS phrase
    FROM (SELECT lang, ws, m, unnest(range(1, len(ws) - m + 2)) AS p FROM piece, (SELECT unnest([1, 2, 3]) AS m))
  ) GROUP BY lang, m, phrase
), c AS (
  SELECT lang, m, phrase, a, string_split(phrase, ' ') AS w FROM f WHERE m > 1 AND a >= 10
), cut AS (
  SELECT lang, phrase, a, k, array_to_string(w[1:k], ' ') AS x, array_to_string(w[k + 1:], ' ') AS y
  FROM (SELECT *, unnest(range(1, m)) AS k FROM c)
), s AS (
  SELECT cut.lang, cut.phrase, cut.a, k, x.a AS l, y.a AS r,
         (1000000 * cut.a::HUGEINT * cut.a::HUGEINT) // (x.a::HUGEINT * y.a::HUGEINT) AS score
  FROM cut JOIN f x ON x.lang = cut.lang AND x.phrase = cut.x JOIN f y ON y.lang = cut.lang AND y.phrase = cut.y
), best AS (
  SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), inside AS (
  SELECT lang, array_to_string(w[p:p + 1], ' ') AS phrase, max(a) AS longer
  FROM (SELECT lang, w, a, unnest([1, 2]) AS p FROM c WHERE m = 3) GROUP BY 1, 2
), kept AS (
  SELECT best.* FROM best LEFT JOIN inside ON inside.lang = best.lang AND inside.phrase = best.phrase
  WHERE longer IS NULL OR 100 * longer < 50 * best.a
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept
)
SELECT ranked.lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score::BIGINT AS score
FROM ranked JOIN n ON n.lang = ranked.lang WHERE rank <= 2000
"""
