"""The operators that plain SQL can express, for comparison on small tables."""

ORACLE = {
    "op3_va_file": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
  FROM (SELECT * FROM v WHERE vec_id % 100 = 0) q
  JOIN v c ON c.vec_id <> q.vec_id AND len(c.e) = len(q.e)
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM scored
)
SELECT query_id, n::INTEGER AS rank, vec_id, score FROM ranked WHERE n <= 10
""",
    "op4_waterfill": r"""
WITH d AS (
  SELECT doc_id, source, md5('0:' || coalesce(doc_id::VARCHAR, '')) AS key,
    CASE WHEN text IS NULL THEN 0 ELSE len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) END::BIGINT AS size
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size, 2 * sum(size)::BIGINT AS cap,
    [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight
  FROM d GROUP BY source
), r AS (
  SELECT *, sum(source_size) OVER () * 3 AS budget, sum(weight) OVER () AS w_all,
    coalesce(sum(cap) OVER before, 0) AS cap_before, coalesce(sum(weight) OVER before, 0) AS w_before
  FROM s
  WINDOW before AS (ORDER BY cap * (10 // weight), source NULLS LAST
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), c AS (
  SELECT *, 2 * cap::HUGEINT * (w_all - w_before) <= (budget - 2 * cap_before) * weight AS stops FROM r
), t AS (
  SELECT source, source_size,
    CASE WHEN stops THEN cap::DOUBLE
      ELSE (weight * (budget - 2 * sum(CASE WHEN stops THEN cap ELSE 0 END) OVER ()))::DOUBLE
        / (2 * sum(CASE WHEN stops THEN 0 ELSE weight END) OVER ())::DOUBLE END AS target
  FROM c
), u AS (
  SELECT *, CASE WHEN source_size > 0 THEN least(floor(target / source_size), 2)::BIGINT ELSE 0 END AS whole FROM t
), x AS (
  SELECT *, CASE WHEN whole >= 2 THEN 0.0::DOUBLE ELSE target - whole * source_size END AS extra FROM u
), m AS (
  SELECT d.doc_id, d.size, x.source_size, x.target, x.whole, x.extra,
    coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id, d.size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS taken_before
  FROM d JOIN x ON d.source IS NOT DISTINCT FROM x.source
)
SELECT doc_id, size, source_size, target,
  (size * (whole + CASE WHEN extra > 0 AND 2 * taken_before + size <= 2 * extra THEN 1 ELSE 0 END))::BIGINT AS taken
FROM m
""",
    "op7_pivots": """
WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b
  FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
    AND list_cosine_similarity(a.e, b.e) >= 0.93
), reach AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings
  UNION
  SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), parts AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, coalesce(c.n, 0)::BIGINT AS n_links, p.component_id,
  coalesce(e.vec_id = p.component_id, true) AS kept
FROM embeddings e LEFT JOIN parts p ON p.a = e.vec_id LEFT JOIN counts c ON c.a = e.vec_id
""",
    "op11_prefix_chat": r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS t FROM conversations
  UNION ALL
  SELECT -7, i, CASE i WHEN 0 THEN 'user' ELSE 'assistant' END, '\### Assistant: </turn> ok' FROM range(2) r(i)
), s AS (
  SELECT *, row_number() OVER w AS place, lead(0) OVER w IS NULL AS last,
    sum(length(role) + length(regexp_replace(role, '[^\\<>]', '', 'g'))
      + length(t) + length(regexp_replace(t, '[^\\<>]', '', 'g'))
      + length('<turn >') + length('</turn>') + 1) OVER (w ROWS UNBOUNDED PRECEDING) AS upto
  FROM c WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, t)
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || t || chr(10), '' ORDER BY place)) AS turns_sha256,
  coalesce(sum(length(t)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(t, '' ORDER BY place) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(upto) FILTER (role = 'assistant' OR last)::BIGINT AS formatted_chars,
  count(*) FILTER (role = 'assistant' OR last) AS n_examples
FROM s GROUP BY conv_id
""",
    "op13_filter_audit": r"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
    list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
  FROM documents
), m AS (
  SELECT doc_id, part, len(w) < 200 AS a, 100 * len(list_distinct(w)) < 50 * len(w) AS b,
    100 * length(regexp_replace(t, '[^A-Z]+', '', 'g')) > 2 * length(t) AS c,
    regexp_matches(t, '[#$%&*|]') AS d,
    coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false) AS e
  FROM d
), f AS (
  SELECT part, a, b, c, d, e, count(*) AS n,
    count(*) FILTER (EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = m.doc_id AND l.quality = 1)) AS good,
    count(*) FILTER (EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = m.doc_id AND l.toxic = 1)) AS toxic
  FROM m GROUP BY ALL
), g AS (
  SELECT part, n, good, toxic,
    concat(CASE WHEN a THEN 'A' END, CASE WHEN b THEN 'B' END, CASE WHEN c THEN 'C' END,
           CASE WHEN d THEN 'D' END, CASE WHEN e THEN 'E' END) AS fails
  FROM f
), x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (
  SELECT concat(p.x, q.x, r.x, s.x, u.x) AS filter_order FROM x p, x q, x r, x s, x u
  WHERE len(list_distinct([p.x, q.x, r.x, s.x, u.x])) = 5
), steps AS (
  SELECT filter_order, i::INTEGER AS step, filter_order[i] AS letter FROM o, unnest(range(1, 6)) AS r(i)
), hits AS (
  SELECT part, filter_order, step, letter, n, good, toxic, contains(fails, letter) AS here, fails = letter AS only_here,
    len(list_filter(range(1, step), lambda j: contains(fails, filter_order[j]))) > 0 AS gone
  FROM g, steps
), told AS (
  SELECT part, filter_order, step, letter,
    coalesce(sum(n) FILTER (NOT here AND NOT gone), 0)::BIGINT AS kept,
    coalesce(sum(n) FILTER (here AND NOT gone), 0)::BIGINT AS removed,
    coalesce(sum(n) FILTER (here AND gone), 0)::BIGINT AS redundant,
    coalesce(sum(n) FILTER (only_here), 0)::BIGINT AS unique_fails,
    coalesce(sum(good) FILTER (here AND NOT gone), 0)::BIGINT AS good_lost,
    coalesce(sum(toxic) FILTER (here AND NOT gone), 0)::BIGINT AS toxic_lost
  FROM hits GROUP BY ALL
)
SELECT * EXCLUDE (letter), (sum(removed) OVER (PARTITION BY part, letter))::BIGINT AS shapley FROM told
""",
}
