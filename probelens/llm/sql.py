"""DuckDB statements of the queries that SQL can express.

Ops 3, 5 to 7, 9 and 13 and the pipeline have none (concentration steps, span
positions, a DOM, zstandard sizes, XXH64); nor has op 4, whose statement over every
50-byte window of whole texts is too slow. Their tests compare them with brute
force or measure held-out accuracy.
"""

from __future__ import annotations

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

_LM_SCORING = r"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[^\x20\x09-\x0D]+') AS w FROM documents
), places AS (
  SELECT doc_id, i, w[i] AS v, CASE WHEN i > 1 THEN w[i - 1] END AS u, CASE WHEN i > 2 THEN w[i - 2] END AS t
  FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM docs)
), pairs AS (
  SELECT doc_id, u, v, sum(count(*)) OVER (PARTITION BY u, v) - count(*) AS others
  FROM places WHERE i > 1 GROUP BY doc_id, u, v
), triples AS (
  SELECT doc_id, t, u, v, sum(count(*)) OVER (PARTITION BY t, u, v) - count(*) AS others
  FROM places WHERE i > 2 GROUP BY doc_id, t, u, v
), vocabulary AS (
  SELECT v AS word, count(*) AS c FROM places GROUP BY v
), total AS (
  SELECT sum(c)::DOUBLE AS n FROM vocabulary
), worth AS (
  SELECT p.doc_id, p.i, coalesce(b.others, 0) > 0 AS seen, coalesce(a.others, 0) > 0 AS longest,
         CASE WHEN a.others > 0 THEN ln(a.others) - ln(context.others)
              ELSE CASE WHEN p.i > 2 THEN ln(0.4) ELSE 0 END
                + CASE WHEN b.others > 0 THEN ln(b.others) - ln(vu.c)
                       ELSE CASE WHEN p.i > 1 THEN ln(0.4) ELSE 0 END + ln(vv.c) - ln(n) END END AS gain
  FROM places p CROSS JOIN total JOIN vocabulary vv ON p.v = vv.word
  LEFT JOIN vocabulary vu ON p.u = vu.word
  LEFT JOIN pairs b ON b.doc_id = p.doc_id AND b.u = p.u AND b.v = p.v
  LEFT JOIN pairs context ON context.doc_id = p.doc_id AND context.u = p.t AND context.v = p.u
  LEFT JOIN triples a ON a.doc_id = p.doc_id AND a.t = p.t AND a.u = p.u AND a.v = p.v
)
SELECT d.doc_id, len(any_value(d.w))::BIGINT AS n_words, coalesce(sum(seen::INT), 0)::BIGINT AS n_seen,
       coalesce(sum(longest::INT), 0)::BIGINT AS n_longest, round(sum(gain) / len(any_value(d.w)), 6) AS score
FROM docs d LEFT JOIN worth USING (doc_id) GROUP BY d.doc_id
"""

_MIXING = rf"""
WITH docs AS (
  SELECT doc_id, source, md5(text) AS digest, len({_WORDS})::BIGINT AS size FROM documents
), units AS (
  SELECT doc_id, source, digest, size, count(*) AS n,
         md5(concat_ws(':', 'mix', coalesce(doc_id::VARCHAR, '-'), coalesce(digest, '-'))) AS shuffle
  FROM docs GROUP BY ALL
), sources AS (
  SELECT source, sum(size) AS source_size,
         [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight
  FROM docs GROUP BY source
), caps AS (
  SELECT *, source_size * 3 AS cap, source_size * 3 / weight AS ratio, sum(source_size) OVER () AS budget FROM sources
), levels AS (
  SELECT *, (budget - coalesce(sum(cap) OVER w1, 0)) / sum(weight) OVER w2 AS level,
         row_number() OVER (ORDER BY ratio, source NULLS LAST) AS place
  FROM caps
  WINDOW w1 AS (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
         w2 AS (ORDER BY ratio, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
), plan AS (
  SELECT source, source_size, weight, budget,
         least(cap::DOUBLE, coalesce((SELECT arg_min(level, place) FROM levels WHERE level <= ratio) * weight, cap::DOUBLE)) AS target
  FROM levels
), served AS (
  SELECT u.*, p.source_size, p.weight, p.target, p.budget,
         sum(u.size * n) OVER (PARTITION BY u.source ORDER BY shuffle, doc_id NULLS FIRST ROWS UNBOUNDED PRECEDING) AS served
  FROM units u JOIN plan p ON u.source IS NOT DISTINCT FROM p.source
), queue AS (
  SELECT *, (served + epoch * source_size) / weight AS finish
  FROM served, (SELECT unnest([0, 1, 2]) AS epoch)
), ranked AS (
  SELECT *, sum(size * n) OVER (ORDER BY finish, source NULLS FIRST, shuffle, doc_id NULLS FIRST, epoch ROWS UNBOUNDED PRECEDING) AS run FROM queue
), taken AS (
  SELECT doc_id, source, digest, size, n, any_value(source_size)::BIGINT AS source_size, any_value(weight)::INT AS weight,
         any_value(target) AS target, count(*) FILTER (run <= budget AND size > 0) AS copies
  FROM ranked GROUP BY doc_id, source, digest, size, n
)
SELECT doc_id, source, size, source_size, weight, target, copies, copies * size AS taken
FROM taken, unnest(range(n)) AS r(i)
"""

_TRIMMED = "trim(l, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"
_HAS_WORD = r"regexp_matches(l, '[^\x20\x09-\x0D]')"

_LINE_DEDUP = rf"""
WITH pages AS (
  SELECT DISTINCT source, text FROM documents WHERE source IS NOT NULL AND text IS NOT NULL
), totals AS (
  SELECT source, count(*) AS pages FROM pages GROUP BY source
), seen AS (
  SELECT source, {_TRIMMED} AS line, count(DISTINCT text) AS seen
  FROM (SELECT source, text, unnest(string_split(text, chr(10))) AS l FROM pages)
  WHERE {_HAS_WORD} GROUP BY ALL
), common AS (
  SELECT source, list(line) AS drops FROM seen JOIN totals USING (source)
  WHERE seen >= 5 AND seen > pages * 0.02::DOUBLE GROUP BY source
), cut AS (
  SELECT d.*, CASE WHEN text IS NULL THEN 0 ELSE len(string_split(text, chr(10))) END AS n_lines,
         list_filter(string_split(text, chr(10)), lambda l: NOT ({_HAS_WORD} AND list_contains(coalesce(drops, []), {_TRIMMED}))) AS kept
  FROM documents d LEFT JOIN common c ON d.source = c.source
)
SELECT doc_id, source, CASE WHEN text IS NULL THEN NULL ELSE array_to_string(kept, chr(10)) END AS text,
       n_lines::BIGINT AS n_lines, CASE WHEN text IS NULL THEN 0 ELSE n_lines - len(kept) END::BIGINT AS n_dropped
FROM cut
"""

_DECONTAMINATION = r"""
WITH item_words AS (
  SELECT item_id, regexp_extract_all(lower(text), '[^\x20\x09-\x0D]+') AS w FROM benchmark WHERE text IS NOT NULL
), items AS (
  SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS s
  FROM (SELECT item_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM (SELECT *, least(len(w), 5) AS k FROM item_words WHERE len(w) > 0))
), sizes AS (
  SELECT item_id, count(*) AS n_item FROM items GROUP BY item_id
), doc_words AS (
  SELECT doc_id, regexp_extract_all(lower(text), '[^\x20\x09-\x0D]+') AS w FROM documents WHERE text IS NOT NULL
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + k - 1], ' ') AS s
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM doc_words, (SELECT DISTINCT k FROM items))
)
SELECT doc_id, item_id, count(*) AS n_shared, any_value(n_item) AS n_item, count(*) / any_value(n_item) AS containment
FROM shingles JOIN items USING (s) JOIN sizes USING (item_id)
GROUP BY doc_id, item_id HAVING count(*) >= ceil(any_value(n_item) * 0.8::DOUBLE - 1e-9)
"""

_ROUND = """, a{r} AS (
  SELECT id, arg_min(c, d * 1000 + c) AS c, min(d) AS d
  FROM (SELECT k.id, c{r}.c, list_sum(list_transform(list_zip(k.v, c{r}.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS d FROM kept k, c{r})
  GROUP BY id
)"""
_MOVE = """, c{n} AS (
  SELECT c{r}.c, coalesce(m.v, c{r}.v) AS v
  FROM c{r} LEFT JOIN (
    SELECT c, list(s ORDER BY i) AS v
    FROM (SELECT a.c, i, floor(sum(k.v[i]) / count(*))::BIGINT AS s FROM kept k JOIN a{r} a USING (id), range(1, 65) t(i) GROUP BY a.c, i)
    GROUP BY c
  ) m USING (c)
)"""
_CENTROIDS = (
    """
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id) AS id, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64
), c0 AS (
  SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id), v) - 1 AS c, v FROM kept ORDER BY sha256('2:' || vec_id), v LIMIT 40
)"""
    + "".join(_ROUND.format(r=r) + _MOVE.format(r=r, n=r + 1) for r in range(5))
    + _ROUND.format(r=5)
    + """
SELECT vec_id, a.c::INTEGER AS cluster, d AS distance, (sum(d) OVER (PARTITION BY a.c))::BIGINT AS cluster_inertia,
       (sum(d) OVER ())::BIGINT AS inertia, sha256(array_to_string(c5.v, ',')) AS centroid_sha256
FROM a5 a JOIN kept USING (id) JOIN c5 ON c5.c = a.c
"""
)

_LETTERS = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_TERMS = rf"regexp_extract_all(translate(coalesce(text, ''), {_LETTERS}), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
_LEXICAL_SEARCH = f"""
WITH docs AS MATERIALIZED (
  SELECT doc_id, t FROM (SELECT doc_id, {_TERMS} AS t FROM documents) WHERE len(t) > 0
), sizes AS (
  SELECT count(*) AS n_docs, sum(len(t))::BIGINT AS n_terms FROM docs
), asked AS (
  SELECT item_id, term, count(*) AS q FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark) GROUP BY ALL
), found AS (
  SELECT doc_id, n, term, count(*) AS tf
  FROM (SELECT doc_id, len(t)::BIGINT AS n, unnest(t) AS term FROM docs)
  WHERE term IN (SELECT term FROM asked) GROUP BY ALL
), weights AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
  FROM found, sizes GROUP BY term, n_docs
), scores AS (
  SELECT item_id, doc_id, sum(q * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * n_docs) // n_terms))))::BIGINT AS score
  FROM asked JOIN found USING (term) JOIN weights USING (term), sizes GROUP BY item_id, doc_id
)
SELECT item_id, (row_number() OVER best)::INTEGER AS rank, doc_id, score
FROM scores WHERE score > 0
WINDOW best AS (PARTITION BY item_id ORDER BY score DESC, doc_id) QUALIFY row_number() OVER best <= 10
"""

ORACLE_SQL: dict[str, str] = {
    "op1_lm_scoring": _LM_SCORING,
    "op2_source_mixing": _MIXING,
    "op8_line_dedup": _LINE_DEDUP,
    "op10_benchmark_decontamination": _DECONTAMINATION,
    "op11_centroid_clustering": _CENTROIDS,
    "op12_lexical_search": _LEXICAL_SEARCH,
}
