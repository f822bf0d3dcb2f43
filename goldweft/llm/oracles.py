"""The registered queries in DuckDB SQL, where SQL can express them."""

ORACLES: dict[str, str] = {}

ORACLES["op4_topk_search"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS w
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(list_zip(q.w, c.w), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
"""

_WORDS = r"list_filter(regexp_split_to_array(coalesce(text, ''), '[ \t\n\x0B\f\r]+'), lambda w: w <> '')"

ORACLES["op9_substring_dedup"] = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
p AS (SELECT doc_id, ws, unnest(generate_series(1, len(ws) - 19)) AS p FROM d WHERE len(ws) >= 20),
s AS (SELECT doc_id, p, array_to_string(ws[p:p + 19], ' ') AS s FROM p),
r AS (SELECT doc_id, p, row_number() OVER (PARTITION BY s ORDER BY doc_id, p) AS r FROM s),
gone AS (SELECT DISTINCT doc_id, p + k AS i FROM r, range(20) t(k) WHERE r > 1),
w AS (SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM d),
k AS (
  SELECT w.doc_id, count(*) AS n_words, count(gone.i) AS n_removed,
         coalesce(string_agg(w.w, ' ' ORDER BY w.i) FILTER (WHERE gone.i IS NULL), '') AS kept
  FROM w LEFT JOIN gone ON gone.doc_id = w.doc_id AND gone.i = w.i GROUP BY w.doc_id
)
SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k ON k.doc_id = d.doc_id
"""

#: Distinct shingles of five words; a shorter text is one shingle.
_SHINGLES = r"""
d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[ \t\n\x0B\f\r]+'), lambda w: w <> '') AS ws FROM documents
),
s AS (
  SELECT DISTINCT doc_id, array_to_string(ws[p:p + 4], ' ') AS s
  FROM (SELECT doc_id, ws, unnest(generate_series(1, greatest(len(ws) - 4, least(len(ws), 1)))) AS p FROM d)
),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id)
"""

ORACLES["op8_ngram_join"] = f"""
WITH RECURSIVE {_SHINGLES},
i AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM s x JOIN s y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM i JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * k >= 80 * (p.n + q.n - k)),
r(doc_id, c) AS (SELECT doc_id, doc_id FROM d UNION SELECT l.b, r.c FROM r JOIN l ON l.a = r.doc_id),
m AS (SELECT doc_id, min(c) AS component_id FROM r GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, component_id
FROM d JOIN m ON m.doc_id = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
"""

ORACLES["op2_line_dedup"] = r"""
WITH t AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
                  generate_subscripts(string_split(text, chr(10)), 1) AS place FROM documents),
l AS (SELECT doc_id, line, place, list_filter(regexp_split_to_array(line, '[ \t\n\x0B\f\r]+'), lambda w: w <> '') AS ws FROM t),
d AS (SELECT array_to_string(ws, ' ') AS s, any_value(ws) AS ws, len(any_value(ws)) AS n,
             min({'doc_id': doc_id, 'place': place}) AS first
      FROM l WHERE len(ws) >= 1 GROUP BY array_to_string(ws, ' ')),
c AS (SELECT s, ws, first, n, unnest(generate_series(1, n)) AS i FROM d WHERE n >= 5),
replaced AS (SELECT s, first, min(first) OVER (PARTITION BY i, array_to_string(ws[:i - 1] || [chr(1)] || ws[i + 1:], ' ')) AS least FROM c),
cut AS (SELECT c.s AS long, c.first AS long_first, d.s AS short, d.first AS short_first
        FROM c JOIN d ON array_to_string(c.ws[:c.i - 1] || c.ws[c.i + 1:], ' ') = d.s AND d.n >= 5),
near AS (SELECT s FROM replaced WHERE least < first UNION
         SELECT long FROM cut WHERE short_first < long_first UNION
         SELECT short FROM cut WHERE long_first < short_first),
gone AS (
  SELECT l.doc_id, l.place FROM l JOIN d ON d.s = array_to_string(l.ws, ' ')
  WHERE d.s IN (SELECT s FROM near) OR {'doc_id': l.doc_id, 'place': l.place} > d.first
)
SELECT o.doc_id, coalesce(count(l.place), 0) AS n_lines, count(gone.place) AS n_removed,
       CASE WHEN any_value(o.text) IS NOT NULL
         THEN sha256(coalesce(string_agg(l.line, chr(10) ORDER BY l.place) FILTER (WHERE gone.place IS NULL), '')) END AS kept_sha256
FROM documents o LEFT JOIN l ON l.doc_id = o.doc_id
LEFT JOIN gone ON gone.doc_id = l.doc_id AND gone.place = l.place
GROUP BY o.doc_id
"""

ORACLES["op10_tool_chat"] = r"""
WITH t AS (SELECT conv_id, turn, role, max(text) AS text FROM conversations
           WHERE role IN ('user', 'assistant') AND conv_id IS NOT NULL AND turn IS NOT NULL GROUP BY ALL),
p AS (SELECT *, max(CASE WHEN role = 'user' THEN turn END) OVER (
        PARTITION BY conv_id ORDER BY turn RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS last,
        count(*) FILTER (WHERE role = 'user') OVER (
        PARTITION BY conv_id ORDER BY turn RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS depth FROM t),
c AS (SELECT *, len(list_filter(regexp_split_to_array(coalesce(text, ''), '[ \t\n\x0B\f\r]+'), lambda w: w <> '')) AS words
      FROM p WHERE role = 'user'),
r AS (SELECT conv_id, last, count(*) AS n, arg_min(text, turn) AS text FROM p WHERE role = 'assistant' AND last IS NOT NULL GROUP BY ALL)
SELECT c.conv_id, c.conv_id || '.' || c.turn AS call, c.turn AS place, c.depth,
       coalesce(trim(c.text, ' ') <> '' AND words > 0, FALSE) AS valid, coalesce(r.n, 0) AS n_results,
       '{"arguments":{' || CASE WHEN c.last IS NOT NULL THEN '"after":"' || c.conv_id || '.' || c.last || '",' ELSE '' END
       || CASE WHEN c.text IS NOT NULL THEN '"query":' || to_json(c.text) || ',' ELSE '' END
       || '"words":' || words || '},"call":"' || c.conv_id || '.' || c.turn || '","depth":' || c.depth
       || ',"result":' || coalesce(CAST(to_json(r.text) AS VARCHAR), 'null') || ',"tool":"' || CASE WHEN c.last IS NULL THEN 'ask' ELSE 'follow_up' END
       || '","valid":' || CASE WHEN coalesce(trim(c.text, ' ') <> '' AND words > 0, FALSE) THEN 'true' ELSE 'false' END || '}' AS json,
       'call' AS status
FROM c LEFT JOIN r ON r.conv_id = c.conv_id AND r.last = c.turn
UNION ALL
SELECT conv_id, conv_id || '.' || last AS call, turn, NULL, NULL, NULL,
       '{"call":' || coalesce('"' || conv_id || '.' || last || '"', 'null')
       || ',"content":' || coalesce(CAST(to_json(text) AS VARCHAR), 'null') || ',"status":"' || status || '"}', status
FROM (SELECT *, CASE WHEN last IS NULL THEN 'orphan' ELSE 'result' END AS status,
             row_number() OVER (PARTITION BY conv_id, last ORDER BY turn) AS number
      FROM p WHERE role = 'assistant')
WHERE last IS NULL OR number > 1
UNION ALL
SELECT conv_id, NULL, turn, NULL, NULL, NULL,
       '{"content":' || coalesce(CAST(to_json(max(text)) AS VARCHAR), 'null')
       || ',"role":' || coalesce(CAST(to_json(role) AS VARCHAR), 'null') || ',"status":"context"}', 'context'
FROM conversations
WHERE conv_id IS NOT NULL AND turn IS NOT NULL AND coalesce(role NOT IN ('user', 'assistant'), TRUE)
GROUP BY conv_id, turn, role
"""

ORACLES["op12_collocations"] = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\n\x0B\f\r]')) AS piece
  FROM documents
),
w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[ \t]+'), lambda x: x <> '') AS ws FROM p),
s AS (
  SELECT lang, k, ws[i:i + k - 1] AS ws
  FROM (SELECT lang, ws, k, unnest(generate_series(1, len(ws) - k + 1)) AS i FROM w, range(1, 4) t(k))
),
f AS (SELECT lang, k, array_to_string(ws, ' ') AS phrase, any_value(ws) AS ws, count(*) AS f FROM s GROUP BY lang, k, array_to_string(ws, ' ')),
n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT * FROM f WHERE k > 1 AND f >= 10),
cuts AS (
  SELECT c.lang, c.phrase, c.f AS a, cut, l.f AS l, r.f AS r,
         CAST(1000000::HUGEINT * c.f * c.f // (l.f::HUGEINT * r.f) AS BIGINT) AS score
  FROM c JOIN range(1, 3) t(cut) ON cut < c.k
  JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.ws[1:cut], ' ')
  JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.ws[cut + 1:], ' ')
),
best AS (SELECT lang, phrase, a, l, r, score FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
inside AS (
  SELECT lang, unnest([array_to_string(ws[1:2], ' '), array_to_string(ws[2:3], ' ')]) AS phrase, f FROM c WHERE k = 3
),
longer AS (SELECT lang, phrase, max(f) AS f FROM inside GROUP BY lang, phrase),
kept AS (
  SELECT b.* FROM best b LEFT JOIN longer o ON o.lang = b.lang AND o.phrase = b.phrase
  WHERE o.f IS NULL OR 100 * o.f < 50 * b.a
)
SELECT kept.lang, row_number() OVER (PARTITION BY kept.lang ORDER BY score DESC, a DESC, phrase) AS rank,
       phrase, a, l, r, n, score
FROM kept JOIN n ON n.lang = kept.lang
QUALIFY rank <= 2000
"""
