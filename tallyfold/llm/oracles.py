"""DuckDB SQL for the queries that SQL can express."""

WS = r"' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

ORACLES = {
    "op2_source_mix": f"""
WITH d AS (SELECT doc_id, source, len({WORDS})::BIGINT AS size, md5('mix-1:' || coalesce(doc_id::VARCHAR, 'null')) AS hash FROM documents),
t AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, ([3.0, 1.0, 2.0]::DOUBLE[])[(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight, 2.0::DOUBLE * source_size AS clamp FROM t),
o AS (SELECT *, (sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE - coalesce(sum(clamp) OVER (ORDER BY clamp / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
  sum(weight) OVER () - coalesce(sum(weight) OVER (ORDER BY clamp / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS weight_left,
  row_number() OVER (ORDER BY clamp / weight, source NULLS LAST) AS nth FROM w),
f AS (SELECT nth, rest, weight_left FROM o WHERE clamp * weight_left > weight * rest ORDER BY nth LIMIT 1),
p AS (SELECT o.source, o.source_size, CASE WHEN f.nth IS NOT NULL AND o.nth >= f.nth THEN o.weight * (f.rest / f.weight_left) ELSE o.clamp END AS target FROM o LEFT JOIN f ON true),
q AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS whole FROM p),
c AS (SELECT d.*, q.source_size, q.target, q.whole, target - whole * source_size AS quota,
  sum(size) OVER (PARTITION BY d.source ORDER BY hash) - sum(size) OVER (PARTITION BY d.source, hash) AS before, sum(size) OVER (PARTITION BY d.source, hash) AS tied
  FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source)
SELECT doc_id, source, size, source_size, target, (whole + CASE WHEN quota > 0 AND before + tied / 2.0 <= quota THEN 1 ELSE 0 END)::BIGINT AS copies,
  (size * (whole + CASE WHEN quota > 0 AND before + tied / 2.0 <= quota THEN 1 ELSE 0 END))::BIGINT AS taken FROM c
""",
    "op7_line_dedup": f"""
WITH s AS (SELECT row_number() OVER () AS rid, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT rid, doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM s),
k AS (SELECT *, translate(trim(line, {WS}), '{UPPER}', '{LOWER}') AS key FROM l),
c AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) + max((doc_id IS NULL)::INT) >= 5),
j AS (SELECT k.*, c.key IS NOT NULL AND k.doc_id IS DISTINCT FROM c.keeper AS gone FROM k LEFT JOIN c ON k.key = c.key)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (WHERE gone)::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM j GROUP BY rid, doc_id
""",
    "op4_preference_format": """
WITH t0 AS (SELECT conv_id, coalesce(conv_id::VARCHAR, 'row ' || row_number() OVER ()) AS id, turn, replace(coalesce(role, ''), '<|', '< |') AS role, replace(coalesce(text, ''), '<|', '< |') AS text FROM conversations),
t AS (SELECT id, role, text, row_number() OVER (PARTITION BY id ORDER BY turn NULLS FIRST, role, text) AS i FROM t0),
nx AS (SELECT id, conv_id, lead(id) OVER (ORDER BY conv_id) AS next_id FROM (SELECT DISTINCT id, conv_id FROM t0 WHERE conv_id IS NOT NULL)),
l AS (SELECT id, count(*) AS n, coalesce(max(i) FILTER (WHERE role = 'assistant'), 0) AS last FROM t GROUP BY id),
a AS (SELECT nx.id AS before, t.role, t.text FROM t JOIN l ON t.id = l.id AND t.i = l.last JOIN nx ON nx.next_id = t.id),
c AS (SELECT t.id, 'c' AS side, t.i, t.role, t.text FROM t JOIN l ON t.id IS NOT DISTINCT FROM l.id WHERE l.last = 0 OR t.i <= l.last),
r AS (SELECT t.id, 'r' AS side, t.i, t.role, t.text FROM t JOIN l ON t.id IS NOT DISTINCT FROM l.id WHERE l.last = 0 OR t.i < l.last
  UNION ALL SELECT l.id, 'r', l.last, a.role, a.text FROM l JOIN a ON l.id = a.before WHERE l.last > 0),
m AS (SELECT l.id, coalesce(min(p.i) - 1, max(l.n_c)) AS n_prefix FROM (SELECT id, CASE WHEN last = 0 THEN n ELSE last END AS n_c FROM l) l
  LEFT JOIN (SELECT coalesce(c.id, r.id) AS id, coalesce(c.i, r.i) AS i FROM c FULL JOIN r ON c.id IS NOT DISTINCT FROM r.id AND c.i = r.i WHERE c.i IS NULL OR r.i IS NULL OR c.role <> r.role OR c.text <> r.text) p
  ON l.id IS NOT DISTINCT FROM p.id GROUP BY l.id),
s AS (SELECT x.*, m.n_prefix, x.i > m.n_prefix AS rest, '<|' || role || '|>' || chr(10) AS head, text || '<|end|>' || chr(10) AS body FROM (SELECT * FROM c UNION ALL SELECT * FROM r) x JOIN m ON x.id IS NOT DISTINCT FROM m.id),
o AS (SELECT *, coalesce(sum(length(head) + length(body)) OVER (PARTITION BY id, side, rest ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS pos FROM s)
SELECT try_cast(m.id AS BIGINT) AS conv_id, m.n_prefix::BIGINT AS n_prefix,
  coalesce(string_agg(head || body, '' ORDER BY i) FILTER (WHERE side = 'c' AND NOT rest), '') AS prompt,
  coalesce(string_agg(head || body, '' ORDER BY i) FILTER (WHERE side = 'c' AND rest), '') AS chosen,
  coalesce(string_agg(head || body, '' ORDER BY i) FILTER (WHERE side = 'r' AND rest), '') AS rejected,
  coalesce(string_agg((pos + length(head)) || ':' || (pos + length(head) + length(body)), ',' ORDER BY i) FILTER (WHERE side = 'c' AND rest AND role = 'assistant'), '') AS chosen_spans,
  coalesce(string_agg((pos + length(head)) || ':' || (pos + length(head) + length(body)), ',' ORDER BY i) FILTER (WHERE side = 'r' AND rest AND role = 'assistant'), '') AS rejected_spans
FROM m LEFT JOIN o ON m.id IS NOT DISTINCT FROM o.id GROUP BY m.id, m.n_prefix
""",
    "op3_quality_ledger": f"""
WITH w0 AS (SELECT doc_id, coalesce(text, '') AS text, {WORDS} AS ws FROM documents),
w AS (SELECT doc_id, unnest(ws) AS x, generate_subscripts(ws, 1) AS i FROM w0),
g AS (SELECT *, lead(x, 1) OVER d AS x1, lead(x, 2) OVER d AS x2 FROM w WINDOW d AS (PARTITION BY doc_id ORDER BY i)),
t AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, x, x1, x2) AS n FROM g WHERE x2 IS NOT NULL),
c AS (SELECT doc_id, count(DISTINCT i + o) AS n_repeat_words FROM t, (SELECT unnest([0, 1, 2]) AS o) WHERE n > 1 GROUP BY doc_id),
a AS (SELECT doc_id, count(*) AS n_words, sum(length(x)) AS word_chars, count(*) FILTER (x = '|') AS n_pipes, count(*) FILTER (x = x1) AS n_runs,
  count(*) FILTER (regexp_matches(x, '[^\x00-\x7F]') OR regexp_full_match(trim(x, '.,;:!?()"''-'), '[A-Za-z]+')) AS n_plain FROM g GROUP BY doc_id),
f AS (SELECT doc_id, max(n) AS top_word FROM (SELECT doc_id, x, count(*) AS n FROM w GROUP BY doc_id, x) GROUP BY doc_id),
l AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM w0) WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
m AS (SELECT w0.doc_id, coalesce(n_words, 0)::BIGINT AS n_words, coalesce(word_chars, 0)::BIGINT AS word_chars, length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
  coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, coalesce(n_lines, 0) AS n_lines, coalesce(n_pipes, 0) AS n_pipes, coalesce(n_runs, 0) AS n_runs, coalesce(n_plain, 0) AS n_plain, coalesce(top_word, 0) AS top_word
  FROM w0 LEFT JOIN a USING (doc_id) LEFT JOIN c USING (doc_id) LEFT JOIN f USING (doc_id) LEFT JOIN l USING (doc_id)),
b AS (SELECT *, ((n_words < 50)::BIGINT + 2 * (100 * n_repeat_words > 50 * n_words)::BIGINT + 4 * (100 * n_symbols > 5 * word_chars)::BIGINT + 8 * (100 * n_dup_lines > 40 * n_lines)::BIGINT
  + 16 * (word_chars < 2 * n_words OR word_chars > 15 * n_words)::BIGINT + 32 * (100 * n_plain < 60 * n_words)::BIGINT + 64 * (top_word > 3 AND 100 * top_word > 30 * n_words)::BIGINT + 128 * (100 * n_runs > 20 * n_words)::BIGINT + 256 * (100 * n_pipes > 10 * n_words)::BIGINT)::BIGINT AS failed_bits FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (failed_bits & 3) <> 0 AS base_failed, failed_bits = 0 AS kept, failed_bits, sole_rule,
  CASE WHEN sole_rule IS NOT NULL THEN count(*) OVER (PARTITION BY sole_rule) END AS sole_rule_rejects
FROM (SELECT *, CASE failed_bits WHEN 1 THEN 'few_words' WHEN 2 THEN 'repeated_windows' WHEN 4 THEN 'symbols' WHEN 8 THEN 'duplicate_lines' WHEN 16 THEN 'word_length'
  WHEN 32 THEN 'not_words' WHEN 64 THEN 'dominant_word' WHEN 128 THEN 'stuttering' WHEN 256 THEN 'table_pipes' END AS sole_rule FROM b)
""",
    "op9_fm_substring": f"""
WITH w0 AS (SELECT doc_id, {WORDS} AS ws FROM documents),
w AS (SELECT doc_id, unnest(ws) AS x, generate_subscripts(ws, 1) AS i FROM w0),
g AS (SELECT doc_id, i, count(*) OVER d AS n, string_agg(x, ' ') OVER d AS seq FROM w WINDOW d AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING)),
r AS (SELECT doc_id, i, row_number() OVER (PARTITION BY seq ORDER BY doc_id, i) AS nth FROM g WHERE n = 20),
c AS (SELECT DISTINCT doc_id, i + o AS i FROM (SELECT doc_id, i FROM r WHERE nth > 1), (SELECT unnest(range(20)) AS o)),
k AS (SELECT w.doc_id, w.i, w.x, c.i IS NOT NULL AS gone FROM w LEFT JOIN c ON c.doc_id = w.doc_id AND c.i = w.i)
SELECT w0.doc_id, len(w0.ws)::BIGINT AS n_words, coalesce(s.n, 0)::BIGINT AS n_removed, sha256(coalesce(s.rest, '')) AS kept_sha256
FROM w0 LEFT JOIN (SELECT doc_id, count(*) FILTER (gone) AS n, string_agg(x, ' ' ORDER BY i) FILTER (WHERE NOT gone) AS rest FROM k GROUP BY doc_id) s USING (doc_id)
""",
}
