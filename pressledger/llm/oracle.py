"""Expected results of the registered queries as DuckDB SQL, written from their contracts."""

from pressledger.llm import quality

OP3 = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))), 1, 15))::BIGINT AS key
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source
), w AS (
  SELECT *, ([5.0, 2.0, 1.0]::DOUBLE[])[(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight FROM s
), b AS (
  SELECT *, 2.0::DOUBLE * source_size / weight AS bound_at FROM w
), f AS (
  SELECT *, row_number() OVER o AS place,
         (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(2.0::DOUBLE * source_size)
            OVER (ORDER BY bound_at, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(weight) OVER (ORDER BY bound_at, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM b WINDOW o AS (ORDER BY bound_at, source NULLS LAST)
), t AS (
  SELECT source, source_size,
         least(2.0::DOUBLE * source_size, weight * (SELECT min_by(level, place) FROM f WHERE level <= bound_at)) AS target
  FROM f
), r AS (
  SELECT d.doc_id, d.size, t.source_size, t.target,
         CASE WHEN t.target > t.source_size THEN t.target - t.source_size ELSE t.target END AS budget,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key RANGE UNBOUNDED PRECEDING) AS upto,
         sum(d.size) OVER (PARTITION BY d.source, d.key) AS own
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       (size * ((target > source_size)::INT
        + (upto <= budget OR (upto - own <= budget AND 2 * (budget - (upto - own)) > own))::INT))::BIGINT AS taken
FROM r
"""

OP2 = r"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
), r AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank, vec_id, score FROM s
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 5
"""

# crc32 has no function there: eight shifts per byte of the decimal id.
OP11 = r"""
WITH RECURSIVE c AS (
  SELECT *, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda d: ascii(d)::BIGINT)),
    lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda y, z: xor(y >> 1, 3988292384 * (y & 1)))) AS crc
  FROM documents
), e AS (
  SELECT doc_id, source, text, xor(crc, 4294967295) % 5 = 0 AS tampered,
         concat_ws('', coalesce(strlen(doc_id::VARCHAR)::VARCHAR || ':' || doc_id::VARCHAR, '-'), coalesce(strlen(source)::VARCHAR || ':' || source, '-'),
           coalesce(strlen(lang)::VARCHAR || ':' || lang, '-'), coalesce(strlen(n_chars::VARCHAR)::VARCHAR || ':' || n_chars::VARCHAR, '-')) AS head,
         translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS small
  FROM c
), h AS (
  SELECT doc_id, source, sha256(head || coalesce(strlen(text)::VARCHAR || ':' || text, '-')) AS leaf,
         CASE WHEN coalesce(tampered, false) THEN sha256(head || coalesce(strlen(small)::VARCHAR || ':' || small, '-')) END AS changed
  FROM e
), l AS (
  SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS grp, count(*) OVER (PARTITION BY source) AS n,
         row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos
  FROM h
), t AS (
  SELECT grp, 0 AS level, pos AS idx, leaf AS digest, n FROM l
  UNION ALL
  SELECT grp, level + 1, idx // 16, sha256(string_agg(digest, '' ORDER BY idx)), (n + 15) // 16
  FROM t WHERE n > 1 GROUP BY grp, level, idx // 16, n
), s AS (
  SELECT grp, digest, max(level) OVER () AS high FROM t WHERE n = 1
), u AS (
  SELECT 0 AS level, grp AS idx, digest, count(*) OVER () AS n FROM s
  UNION ALL
  SELECT level + 1, idx // 16, sha256(string_agg(digest, '' ORDER BY idx)), (n + 15) // 16 FROM u WHERE n > 1 GROUP BY level, idx // 16, n
), f AS (
  SELECT doc_id, leaf, grp, pos, 0 AS level, pos AS idx, coalesce(changed, leaf) AS x FROM l
  UNION ALL
  SELECT f.doc_id, f.leaf, f.grp, f.pos, f.level + 1, f.idx // 16, sha256(string_agg(CASE WHEN t.idx = f.idx THEN f.x ELSE t.digest END, '' ORDER BY t.idx))
  FROM f JOIN t ON t.grp = f.grp AND t.level = f.level AND t.idx // 16 = f.idx // 16 AND t.n > 1
  GROUP BY f.doc_id, f.leaf, f.grp, f.pos, f.level, f.idx
), g AS (
  SELECT f.*, s.digest AS subroot FROM f JOIN s USING (grp) JOIN t ON t.grp = f.grp AND t.level = f.level AND t.n = 1
), k AS (
  SELECT doc_id, leaf, grp, pos, subroot, 0 AS level, grp AS idx, x FROM g
  UNION ALL
  SELECT k.doc_id, k.leaf, k.grp, k.pos, k.subroot, k.level + 1, k.idx // 16, sha256(string_agg(CASE WHEN u.idx = k.idx THEN k.x ELSE u.digest END, '' ORDER BY u.idx))
  FROM k JOIN u ON u.level = k.level AND u.idx // 16 = k.idx // 16 AND u.n > 1
  GROUP BY k.doc_id, k.leaf, k.grp, k.pos, k.subroot, k.level, k.idx
), p AS (
  SELECT f.grp, f.pos, 0 AS tree, f.level, t.idx, t.digest FROM f JOIN t ON t.grp = f.grp AND t.level = f.level AND t.idx // 16 = f.idx // 16 AND t.idx <> f.idx
  UNION ALL
  SELECT k.grp, k.pos, 1, k.level, u.idx, u.digest FROM k JOIN u ON u.level = k.level AND u.idx // 16 = k.idx // 16 AND u.idx <> k.idx
), q AS (
  SELECT grp, pos, string_agg(digest, '' ORDER BY tree, level, idx) AS proof FROM p GROUP BY grp, pos
), r AS (
  SELECT digest AS root FROM u WHERE n = 1
)
SELECT doc_id, leaf, subroot, root, sha256(coalesce(proof, '')) AS proof_sha256, x AS folded_root, x = root AS verified
FROM k JOIN u ON u.level = k.level AND u.n = 1 CROSS JOIN r LEFT JOIN q USING (grp, pos)
"""

OP13 = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
"""

OP8 = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS w
  FROM documents
), s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
                                    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s
  FROM w
), e AS (
  SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM s
), l AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
), r AS (
  SELECT doc_id, doc_id AS c FROM documents UNION SELECT l.b, r.c FROM r JOIN l ON l.a = r.doc_id
), c AS (
  SELECT doc_id, min(c) AS component_id FROM r GROUP BY doc_id
)
SELECT doc_id, len(s)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept FROM s JOIN c USING (doc_id)
"""

_JENSEN_SHANNON = """sqrt(greatest(list_sum(list_transform(range(1, len({p}) + 1), lambda i:
      CASE WHEN {p}[i] > 0 THEN {p}[i] * log2(2 * {p}[i] / ({p}[i] + {q}[i])) ELSE 0 END
      + CASE WHEN {q}[i] > 0 THEN {q}[i] * log2(2 * {q}[i] / ({p}[i] + {q}[i])) ELSE 0 END)) / 2, 0))"""

# Counts, limits and bins are those of the operator's docstring and parameters; repeated windows are compared as texts.
OP4 = r"""
WITH d AS (
  SELECT doc_id, lang, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
), g AS (
  SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS x FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d)
), twice AS (
  SELECT doc_id, i FROM g QUALIFY count(*) OVER (PARTITION BY doc_id, x) > 1
), covered AS (
  SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS j FROM twice) GROUP BY doc_id
), m AS (
  SELECT d.doc_id, lang, w, len(w) AS n_words, length(t) AS n_chars, len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words,
         [len(regexp_extract_all(t, '[\x20\x09-\x0D]')), len(regexp_extract_all(t, '[#*$%&|<>]')),
          len(regexp_extract_all(t, '[!\x22''()+,./:;=?@\[\\\]^_`{{}}~-]')), len(regexp_extract_all(t, '[A-Z]')),
          len(regexp_extract_all(t, '[0-9]')), len(regexp_extract_all(t, '[^\x00-\x7F]'))] AS k
  FROM d LEFT JOIN covered ON d.doc_id = covered.doc_id
), b AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m
), ranked AS (
  SELECT lang, word, row_number() OVER (PARTITION BY lang ORDER BY count(*) DESC, word) AS place
  FROM (SELECT lang, unnest(regexp_extract_all(lower(text), '[^\x20\x09-\x0D]+')) AS word FROM documents WHERE lang IS NOT NULL)
  WHERE length(word) <= {short} GROUP BY lang, word QUALIFY place <= {b3}
), written AS (
  SELECT lang, CASE WHEN place <= {b0} THEN 1 WHEN place <= {b1} THEN 2 WHEN place <= {b2} THEN 3 ELSE 4 END AS bin,
         unnest(list_distinct([word, upper(word), upper(word[1]) || word[2:]])) AS x
  FROM ranked
), hits AS (
  SELECT doc_id, lang, [count(*) FILTER (bin = 1), count(*) FILTER (bin = 2), count(*) FILTER (bin = 3), count(*) FILTER (bin = 4)] AS h
  FROM (SELECT doc_id, unnest(w) AS x FROM d) JOIN written USING (x) GROUP BY doc_id, lang
), pairs AS (
  SELECT b.*, l.lang AS other, coalesce(h, [0, 0, 0, 0]) AS h
  FROM b, (SELECT DISTINCT lang FROM ranked) l LEFT JOIN hits ON hits.doc_id = b.doc_id AND hits.lang = l.lang
), refs AS (
  SELECT other, list_transform([sum(k[1]), sum(k[2]), sum(k[3]), sum(k[4]), sum(k[5]), sum(k[6])], lambda x: x / sum(n_chars)) AS chars,
         list_transform([sum(h[1]), sum(h[2]), sum(h[3]), sum(h[4])], lambda x: x / sum(n_words)) AS words
  FROM pairs WHERE lang = other AND NOT base_failed GROUP BY other HAVING sum(n_chars) > 0 AND sum(n_words) > 0
), shares AS (
  SELECT doc_id, list_transform(list_append(k, greatest(n_chars - list_sum(k), 0)), lambda x: x / greatest(n_chars, 1)::DOUBLE) AS pc,
         list_transform(list_append(h, greatest(n_words - list_sum(h), 0)), lambda x: x / greatest(n_words, 1)::DOUBLE) AS pw,
         list_append(chars, greatest(0.0, 1 - list_sum(chars))) AS qc, list_append(words, greatest(0.0, 1 - list_sum(words))) AS qw
  FROM pairs JOIN refs USING (other)
), apart AS (
  SELECT doc_id, {c} AS chars, {w} AS words FROM shares
), best AS (
  SELECT doc_id, min(row(chars + words, chars, words)) AS r FROM apart GROUP BY doc_id
)
SELECT b.doc_id, n_words::BIGINT AS n_words, (n_chars - k[1])::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
       NOT base_failed AND coalesce(n_chars < {least_chars} OR r[2] <= {char_limit}, TRUE)
         AND coalesce(n_words < {least_words} OR r[3] <= {word_limit} + {scatter} / sqrt(greatest(n_words, 1)), TRUE) AS kept
FROM b LEFT JOIN best USING (doc_id)
""".format(
    short=quality.SHORT, b0=quality.BINS[0], b1=quality.BINS[1], b2=quality.BINS[2], b3=quality.BINS[3], least_chars=quality.LEAST_CHARS,
    least_words=quality.LEAST_WORDS, char_limit=quality.CHAR_LIMIT, word_limit=quality.WORD_LIMIT, scatter=quality.WORD_SCATTER,
    c=_JENSEN_SHANNON.format(p="pc", q="qc"), w=_JENSEN_SHANNON.format(p="pw", q="qw"),
)

ORACLE = {
    "op2_exact_topk": OP2, "op3_mixing": OP3, "op4_quality": OP4, "op8_near_duplicates": OP8, "op11_manifest": OP11, "op13_exact_dedup": OP13,
}
