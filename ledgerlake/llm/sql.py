"""DuckDB SQL for the operators that SQL can express (full computation, no index)."""

TOP_K = """
WITH v AS (
  SELECT vec_id, [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS c
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(embedding) > 0 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), pairs AS (
  SELECT q.vec_id AS query_id, d.vec_id, CAST(list_inner_product(q.c, d.c) AS BIGINT) AS score
  FROM v q JOIN v d ON q.vec_id % 50 = 0 AND d.vec_id <> q.vec_id
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM pairs
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 5
"""

WARC = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS body FROM pages
), h AS (
  SELECT page_id, octet_length(encode(body)) AS payload_bytes, sha1(body) AS payload_digest FROM p
), k AS (
  SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS keeper FROM h
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 1000 AND keeper <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND keeper <> page_id THEN keeper END AS refers_to
FROM k
"""

MIX = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
    md5('mix:' || CAST(doc_id AS VARCHAR)) AS drawn
  FROM documents WHERE doc_id IS NOT NULL
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source
), w AS (
  SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS no FROM s
), b AS (
  SELECT *, CAST(CASE no % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS DOUBLE) AS weight, source_size * 2 AS bound FROM w
), l AS (
  SELECT *, bound / weight AS ratio,
    (sum(source_size) OVER () * CAST(1.5 AS DOUBLE)
      - coalesce(sum(bound) OVER (ORDER BY bound / weight, no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY bound / weight, no ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM b
), t AS (
  SELECT source, no, source_size,
    least(weight * coalesce((SELECT level FROM l WHERE level <= ratio ORDER BY ratio, no LIMIT 1), CAST('inf' AS DOUBLE)),
          CAST(bound AS DOUBLE)) AS target
  FROM l
), q AS (
  SELECT doc_id, size, drawn, no, source_size, target,
    sum(size) OVER (PARTITION BY no ORDER BY drawn, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), e AS (
  SELECT *, CAST(copy * source_size + upto AS DOUBLE) / target AS time
  FROM q, (VALUES (0), (1)) AS c(copy) WHERE size > 0 AND target > 0
), o AS (
  SELECT doc_id, size, sum(size) OVER (ORDER BY time, no, drawn, doc_id, size, copy ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS used
  FROM e
), k AS (
  SELECT doc_id, sum(size) AS taken FROM o WHERE used <= floor((SELECT sum(size) FROM d) * 1.5) GROUP BY doc_id
)
SELECT q.doc_id, size, source_size, target, CAST(coalesce(k.taken, 0) AS BIGINT) AS taken
FROM q LEFT JOIN k ON q.doc_id = k.doc_id
"""

NEAR = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS words FROM documents WHERE doc_id IS NOT NULL
), g AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) = 0 THEN [] WHEN len(words) = 1 THEN [words[1]]
    ELSE [words[i] || ' ' || words[i + 1] FOR i IN range(1, len(words))] END) AS shingle FROM w
), n AS (
  SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id
), c AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common FROM g a JOIN g b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT x, y FROM c JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * common >= 80 * (nx.n + ny.n - common)
), reach AS (
  SELECT doc_id AS node, doc_id AS least FROM w
  UNION
  SELECT y, least FROM reach JOIN links ON node = x
), comp AS (
  SELECT node, min(least) AS component_id FROM reach GROUP BY node
)
SELECT w.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, component_id, w.doc_id = component_id AS kept
FROM w LEFT JOIN n USING (doc_id) JOIN comp ON comp.node = w.doc_id
"""

RUNS = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents WHERE doc_id IS NOT NULL
), bytes AS (
  SELECT doc_id, unnest(string_split(CAST(doc_id AS VARCHAR), '')) AS c, generate_subscripts(string_split(CAST(doc_id AS VARCHAR), ''), 1) AS i FROM (SELECT DISTINCT doc_id FROM d)
), key AS (
  SELECT doc_id, list(ascii(c) ORDER BY i) AS b FROM bytes GROUP BY doc_id
), entry AS (
  SELECT n, list_reduce(list_prepend(CAST(n AS BIGINT), range(8)), lambda x, i: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END) AS e FROM range(256) AS t(n)
), tab AS (
  SELECT list(CAST(e AS BIGINT) ORDER BY n) AS t FROM entry
), h AS (
  SELECT doc_id, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), [CAST(x AS BIGINT) FOR x IN b]),
    lambda x, y: xor(x // 256, t[xor(x % 256, y) + 1])), 4294967295) AS h FROM key, tab
), a AS (
  SELECT doc_id, w, len(w) AS n, h, h // 10 AS g, CASE WHEN len(w) > 0 THEN (h // 10) % len(w) END AS a FROM d JOIN h USING (doc_id)
), p AS (
  SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM a
), t AS (
  SELECT doc_id, n, CASE WHEN h % 10 = 0 AND n > 0 THEN w[1:a] || [w[a + (i - a) % p + 1] FOR i IN range(a, n)] ELSE w END AS w FROM p
), o AS (
  SELECT doc_id, n, unnest(w) AS word, unnest(range(n)) AS i FROM t
), pairs AS (
  SELECT x.doc_id, x.i, y.i - x.i AS q FROM o x JOIN o y ON x.doc_id = y.doc_id AND x.word = y.word AND y.i > x.i AND 4 * (y.i - x.i) <= x.n
), islands AS (
  SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM pairs
), stretches AS (
  SELECT doc_id, q, min(i) AS start, count(*) + q AS length FROM islands GROUP BY doc_id, q, island HAVING count(*) + q >= greatest(6, 4 * q)
), runs AS (
  SELECT doc_id, start, length, min(q) AS period FROM stretches GROUP BY ALL
), best AS (
  SELECT doc_id, count(*) AS n_runs, arg_max(struct_pack(s := start, l := length, p := period), struct_pack(l := length, s := -start, p := -period)) AS b,
    sha256(string_agg(CAST(start AS BIGINT) || ',' || CAST(length AS BIGINT) || ',' || CAST(period AS BIGINT) || chr(10), '' ORDER BY start, period)) AS runs_sha256 FROM runs GROUP BY doc_id
), edges AS (
  SELECT doc_id, place, sum(step) AS step FROM (SELECT doc_id, start + period AS place, 1 AS step FROM runs UNION ALL SELECT doc_id, start + length, -1 FROM runs) GROUP BY ALL
), covered AS (
  SELECT o.doc_id, o.i, o.word, coalesce(sum(step) OVER (PARTITION BY o.doc_id ORDER BY o.i), 0) AS inside FROM o LEFT JOIN edges ON edges.doc_id = o.doc_id AND place = o.i
), collapsed AS (
  SELECT doc_id, sha256(string_agg(word, ' ' ORDER BY i)) AS collapsed_sha256 FROM covered WHERE inside = 0 GROUP BY doc_id
)
SELECT t.doc_id, CAST(coalesce(n_runs, 0) AS BIGINT) AS n_runs, CAST(b.s AS BIGINT) AS start, CAST(b.l AS BIGINT) AS length, CAST(b.p AS BIGINT) AS period,
  CAST(1000 * b.l // b.p AS BIGINT) AS exponent_milli, coalesce(runs_sha256, sha256('')) AS runs_sha256, coalesce(collapsed_sha256, sha256('')) AS collapsed_sha256
FROM t LEFT JOIN best USING (doc_id) LEFT JOIN collapsed USING (doc_id)
"""

SUBSTRINGS = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents WHERE doc_id IS NOT NULL
), windows AS (
  SELECT doc_id, i, array_to_string(w[i + 1:i + 50], ' ') AS words FROM (SELECT doc_id, w, unnest(range(len(w) - 49)) AS i FROM d WHERE len(w) >= 50)
), repeated AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY words) AS first FROM windows) WHERE first < doc_id
), o AS (
  SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS i FROM d
), last AS (
  SELECT o.doc_id, o.i, o.word, max(r.i) OVER (PARTITION BY o.doc_id ORDER BY o.i) AS before FROM o LEFT JOIN repeated r ON r.doc_id = o.doc_id AND r.i = o.i
), kept AS (
  SELECT doc_id, count(*) AS n_words, count(*) FILTER (i - before < 50) AS n_removed,
    sha256(coalesce(string_agg(word, ' ' ORDER BY i) FILTER (before IS NULL OR i - before >= 50), '')) AS kept_sha256
  FROM last GROUP BY doc_id
)
SELECT d.doc_id, CAST(coalesce(n_words, 0) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(kept_sha256, sha256('')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

PHRASES = r"""
WITH d AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
), p AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM d
), grams AS (
  SELECT lang, k, unnest([array_to_string(w[i:i + k - 1], ' ') FOR i IN range(1, len(w) - k + 2)]) AS phrase FROM p, range(1, 5) AS s(k)
), f AS (
  SELECT lang, k, phrase, CAST(count(*) AS HUGEINT) AS f FROM grams GROUP BY ALL
), total AS (
  SELECT lang, sum(f) AS n FROM f WHERE k = 1 GROUP BY lang
), cand AS (
  SELECT lang, k AS words, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k >= 2 AND f >= 30
), cuts AS (
  SELECT c.lang, c.phrase, a, cut, x.f AS l, y.f AS r, (2000000 * a) // (x.f + y.f) AS score
  FROM (SELECT *, unnest(range(1, words)) AS cut FROM cand) c
  JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(w[1:cut], ' ')
  JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(w[cut + 1:words], ' ')
), best AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
), spans AS (
  SELECT lang, a AS longer, unnest([array_to_string(w[i:i + s - 1], ' ') FOR i IN range(1, words - s + 2)]) AS phrase
  FROM (SELECT *, unnest(range(2, words)) AS s FROM cand WHERE words > 2)
), around AS (
  SELECT lang, phrase, max(longer) AS longer FROM spans GROUP BY ALL
), ranked AS (
  SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS rank
  FROM best b LEFT JOIN around o ON o.lang = b.lang AND o.phrase = b.phrase WHERE longer IS NULL OR 100 * longer < 80 * a
)
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ranked JOIN total USING (lang) WHERE rank <= 2000
"""

ORACLE = {
    "op1_impact_topk": TOP_K,
    "op3_warc_revisit": WARC,
    "op4_fair_mix": MIX,
    "op10_tensored_minhash": NEAR,
    "op11_periodic_runs": RUNS,
    "op12_vertical_collocations": PHRASES,
    "op13_sketch_substrings": SUBSTRINGS,
}
