"""DuckDB SQL of the subpackage's queries, where SQL can express them."""

from __future__ import annotations

from tidemark.llm import quality_rules, secret_scan

# Words of lower-cased texts; windows of ten words (a shorter item is one window); a document word is hit if any
# occurrence of a window covers it.
OP1 = r"""
WITH letters AS (SELECT 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' AS upper_, 'abcdefghijklmnopqrstuvwxyz' AS lower_,
                        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+' AS word),
items AS (
    SELECT coalesce(CAST(item_id AS VARCHAR), 'null') AS item,
           regexp_extract_all(translate(coalesce(text, ''), upper_, lower_), word) AS ws
    FROM benchmark, letters),
item_windows AS (
    SELECT item, least(10, len(ws)) AS span, unnest(range(len(ws) - least(10, len(ws)) + 1)) AS i, ws
    FROM items WHERE len(ws) > 0),
windows AS (SELECT DISTINCT item, span, list_slice(ws, i + 1, i + span) AS win FROM item_windows),
docs AS (
    SELECT row_number() OVER () AS rid, doc_id,
           regexp_extract_all(translate(coalesce(text, ''), upper_, lower_), word) AS ws
    FROM documents, letters),
spans AS (SELECT DISTINCT span FROM windows),
doc_windows AS (
    SELECT rid, span, unnest(range(len(ws) - span + 1)) AS i, ws FROM docs, spans WHERE len(ws) >= span),
hits AS (
    SELECT d.rid, d.i, d.span, w.item
    FROM (SELECT rid, span, i, list_slice(ws, i + 1, i + span) AS win FROM doc_windows) d
    JOIN windows w ON w.span = d.span AND w.win = d.win),
covered AS (
    SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest(range(i, i + span)) AS p FROM hits) GROUP BY rid),
named AS (
    SELECT rid, count(DISTINCT item) AS n, string_agg(DISTINCT item, ',' ORDER BY item) AS names
    FROM hits GROUP BY rid)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(c.n, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(m.n, 0) AS BIGINT) AS n_items, sha256(coalesce(m.names, '')) AS items_sha256,
       coalesce(c.n, 0) > 0 AS contaminated
FROM docs LEFT JOIN covered c USING (rid) LEFT JOIN named m USING (rid)
"""

# Weights tokens**a with the smallest a (a multiple of 1e-6) that repeats no source more than twice; each source's
# stream in the order of a keyed hash, cut into as many equal shares as the mixture has blocks.
OP5 = r"""
WITH light AS (
    SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS n_tokens,
           md5(coalesce(text, '')) AS text_hash
    FROM documents),
totals AS (SELECT source, CAST(sum(n_tokens) AS BIGINT) AS tokens FROM light GROUP BY source),
edge AS (SELECT max(tokens) AS hi, min(tokens) AS lo FROM totals WHERE tokens > 0),
exponent AS (
    SELECT hi, CASE WHEN hi = lo THEN 0.0
                    ELSE greatest(0, ceil(1e6 * (1 - ln(2.0) / ln(CAST(hi AS DOUBLE) / lo)))) / 1e6 END AS a FROM edge),
times AS (
    SELECT source, tokens,
           CASE WHEN tokens > 0 THEN pow(CAST(hi AS DOUBLE) / tokens, 1 - a) ELSE 1.0 END AS repetition
    FROM totals, exponent),
quotas AS (
    SELECT source, tokens, CAST(floor(repetition) AS BIGINT) AS passes,
           CAST(floor((repetition - floor(repetition)) * tokens) AS BIGINT) AS rest FROM times),
blocks AS (SELECT CAST(ceil(sum(passes * tokens + rest) / 1048576.0) AS BIGINT) AS n FROM quotas),
passes AS (
    SELECT l.*, q.tokens, q.passes, q.rest, unnest(range(q.passes + CASE WHEN q.rest > 0 THEN 1 ELSE 0 END)) AS copy
    FROM light l JOIN quotas q ON l.source IS NOT DISTINCT FROM q.source),
keyed AS (
    SELECT *, md5('mix:' || copy || ':' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || text_hash) AS key FROM passes),
streams AS (
    SELECT *, CAST(coalesce(sum(n_tokens) OVER (PARTITION BY source, copy ORDER BY key, n_tokens
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before FROM keyed),
placed AS (
    SELECT *, CAST(least(n - 1, floor(coalesce(CAST(copy * tokens + before AS DOUBLE)
                   / nullif(CAST(passes * tokens + rest AS DOUBLE), 0), 0) * n)) AS BIGINT) AS block
    FROM streams, blocks WHERE copy < passes OR before < rest)
SELECT doc_id, source, n_tokens, CAST(copy AS BIGINT) AS copy, block,
       CAST(row_number() OVER (PARTITION BY block ORDER BY md5(block || ':' || key), doc_id NULLS FIRST, n_tokens)
            AS BIGINT) AS position
FROM placed
"""

# Measures by words, windows and lines; then, per language and rule, the strictest of a sequence of cutoffs whose
# rejections of good labelled documents pass an exact binomial test.
_RULES = [(rule, num, den, j, c) for rule, (num, den, cs) in quality_rules.RULES.items() for j, c in enumerate(cs)]
_GRID = ", ".join(f"('{rule}', {j}, {c})" for rule, _, _, j, c in _RULES)
_VALUE = " ".join(f"WHEN rule = '{rule}' THEN {den} > 0 AND 1000 * ({num}) > cutoff * {den}"
                  for rule, (num, den, _) in quality_rules.RULES.items())
OP3 = rf"""
WITH docs AS (
    SELECT row_number() OVER () AS rid, doc_id, lang, coalesce(text, '') AS text,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
windows AS (
    SELECT rid, i, list_slice(ws, i, i + 4) AS win
    FROM (SELECT rid, ws, unnest(range(1, len(ws) - 3)) AS i FROM docs WHERE len(ws) >= 5)),
again AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, win) AS n FROM windows) WHERE n > 1),
repeats AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest(range(i, i + 5)) AS p FROM again) GROUP BY rid),
lines AS (
    SELECT rid, count(*) AS n, count(*) - count(DISTINCT line) AS dup
    FROM (SELECT rid, unnest(string_split(text, chr(10))) AS line FROM docs)
    WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY rid),
measures AS (
    SELECT d.rid, doc_id, lang, text, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
           len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, coalesce(l.dup, 0) AS n_dup_lines,
           coalesce(r.n, 0) AS n_repeat_words, coalesce(l.n, 0) AS n_lines
    FROM docs d LEFT JOIN lines l USING (rid) LEFT JOIN repeats r USING (rid)),
judged AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM measures),
good AS (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id HAVING max(quality) = 1),
holdouts AS (SELECT DISTINCT ON (doc_id, text) j.* FROM judged j JOIN good USING (doc_id) WHERE NOT base_failed),
grid(rule, j, cutoff) AS (VALUES {_GRID}),
weights(rule, weight) AS (VALUES {", ".join(f"('{r}', CAST({w} AS DOUBLE))" for r, w in quality_rules.WEIGHTS.items())}),
counted AS (
    SELECT lang, rule, j, cutoff, count(*) AS n, count(*) FILTER (CASE {_VALUE} END) AS k
    FROM holdouts, grid GROUP BY ALL),
allowed AS (
    SELECT rule, {quality_rules.ERROR} * weight / greatest(1, (SELECT count(*) FROM (SELECT DISTINCT lang FROM holdouts))) AS share,
           {quality_rules.RISK} * weight AS p FROM weights),
tails AS (
    SELECT lang, rule, j, cutoff, share, sum(exp(lgamma(n + 1) - lgamma(x + 1) - lgamma(n - x + 1)
                                                 + x * ln(p) + (n - x) * ln(1 - p))) AS tail
    FROM (SELECT *, unnest(range(k + 1)) AS x FROM counted JOIN allowed USING (rule)) GROUP BY ALL),
bad AS (SELECT lang, rule, min(j) FILTER (tail > share) AS first_bad FROM tails GROUP BY ALL),
cuts AS (
    SELECT t.lang, t.rule, arg_max(cutoff, j) AS cutoff
    FROM tails t JOIN bad b ON t.lang IS NOT DISTINCT FROM b.lang AND t.rule = b.rule AND j < coalesce(first_bad, 1000)
    GROUP BY ALL),
rejected AS (
    SELECT m.rid, string_agg(rule, ',' ORDER BY g.o) AS rules
    FROM judged m JOIN cuts c ON m.lang IS NOT DISTINCT FROM c.lang
    JOIN (SELECT rule, row_number() OVER () AS o FROM (VALUES {", ".join(f"('{r}')" for r in quality_rules.RULES)}) v(rule)) g
         USING (rule)
    WHERE CASE {_VALUE} END GROUP BY m.rid)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
       CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
       CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed, NOT base_failed AND rules IS NULL AS kept,
       coalesce(rules, '') AS rejected_by
FROM judged LEFT JOIN rejected USING (rid)
"""


def _sql_text(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


# Every kind's regex on every text; places from the lengths of the pieces between its matches.
_WIDER = {"access": ("AKIA[A-Z0-9]+", 18), "hex": ("[0-9a-f]+", 16)}          # matched first, short ones dropped then
_KINDS = [(r.kind, *_WIDER.get(r.kind, (r.regex, r.least)), r.group) for r in secret_scan.RULES]
_MATCHES = " UNION ALL ".join(
    f"SELECT rid, {i} AS o, {_sql_text(kind)} AS kind, regexp_extract_all(text, {_sql_text(regex)}) AS m, "
    f"string_split_regex(text, {_sql_text(regex)}) AS gaps, "
    f"regexp_extract_all(text, {_sql_text(regex)}, {group}) AS part, {least} AS least FROM docs"
    for i, (kind, regex, least, group) in enumerate(_KINDS))
OP4 = f"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
matches AS ({_MATCHES}),
cells AS (
    SELECT rid, o, kind, least, unnest(range(1, len(m) + 1)) AS i, m, gaps, part FROM matches WHERE len(m) > 0),
sized AS (
    SELECT rid, o, kind, least, i, length(m[i]) AS size, length(gaps[i]) AS gap, length(part[i]) AS part FROM cells),
placed AS (SELECT *, sum(gap + size) OVER (PARTITION BY rid, o ORDER BY i) AS stop FROM sized),
spans AS (
    SELECT rid, o, kind, CAST(stop - size AS BIGINT) AS start,
           kind || ':' || CAST(stop - size AS BIGINT) || ':' || CAST(stop AS BIGINT) AS name
    FROM placed WHERE part >= least),
named AS (
    SELECT rid, count(*) FILTER (o = 0) AS a, count(*) FILTER (o = 1) AS b, count(*) FILTER (o = 2) AS c,
           string_agg(name, ',' ORDER BY start, o) FILTER (o < 3) AS base,
           string_agg(name, ',' ORDER BY start, o) AS every FROM spans GROUP BY rid)
SELECT doc_id, CAST(coalesce(a, 0) AS BIGINT) AS n_assign, CAST(coalesce(b, 0) AS BIGINT) AS n_access,
       CAST(coalesce(c, 0) AS BIGINT) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
       coalesce(every, '') AS spans
FROM docs LEFT JOIN named USING (rid)
"""

# CRC-32 bit by bit (reflected polynomial 0xEDB88320); the subtree of a node is found through the prefixes of its
# nodes' smallest conversations.
OP11 = r"""
WITH told AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
           row_number() OVER (PARTITION BY conv_id
                              ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
    FROM conversations WHERE conv_id IS NOT NULL),
sizes AS (SELECT conv_id, count(*) AS n, conv_id - conv_id % 5 AS base FROM told GROUP BY conv_id),
bits AS (
    SELECT conv_id, [4294967295::BIGINT] || flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''),
           lambda x: list_transform(range(8), lambda i: (ascii(x)::BIGINT >> i::INTEGER) & 1))) AS bs FROM sizes),
hashes AS (
    SELECT conv_id, xor(4294967295::BIGINT, list_reduce(bs, lambda c, b: xor(c >> 1, (xor(c, b) & 1) * 3988292384))) % 9 AS h
    FROM bits),
plans AS (
    SELECT s.conv_id, s.n, s.base, h, least(h, coalesce(b.n, 0)) AS k
    FROM sizes s JOIN hashes USING (conv_id) LEFT JOIN sizes b ON b.conv_id = s.base),
turns AS (
    SELECT p.conv_id, t.pos, role, text FROM plans p JOIN told t ON t.conv_id = p.base WHERE t.pos <= h
    UNION ALL
    SELECT p.conv_id, t.pos - h + k, role, text FROM plans p JOIN told t USING (conv_id) WHERE t.pos > h),
keyed AS (
    SELECT conv_id, pos, CAST(strlen(text) AS BIGINT) AS bytes,
           string_agg(sha256(concat(strlen(role), ':', role, text)), '') OVER (PARTITION BY conv_id ORDER BY pos) AS path
    FROM turns
    UNION ALL SELECT conv_id, 0, 0, '' FROM sizes),
prefixes AS (SELECT conv_id, pos, bytes, path, max(pos) OVER (PARTITION BY conv_id) AS ends FROM keyed),
nodes AS (
    SELECT path, pos, min(conv_id) AS conv_id, count(*) AS n_convs, max(bytes) * (count(*) - 1) AS saving,
           sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ends = pos), '')) AS ends_sha256
    FROM prefixes GROUP BY path, pos),
kids AS (
    SELECT left(path, (pos - 1) * 64) AS path, count(*) AS n FROM nodes WHERE pos > 0 GROUP BY ALL),
known AS (SELECT nodes.*, coalesce(kids.n, 0) AS n_children FROM nodes LEFT JOIN kids USING (path)),
below AS (
    SELECT p.path, sum(CASE WHEN w.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum(w.saving) AS saved_tokens
    FROM known w JOIN prefixes p ON p.conv_id = w.conv_id AND p.pos <= w.pos GROUP BY p.path)
SELECT v.conv_id, CAST(v.pos AS BIGINT) AS depth, u.conv_id AS parent_conv_id, CAST(v.n_convs AS BIGINT) AS n_convs,
       CAST(v.n_children AS BIGINT) AS n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
       CAST(saved_tokens AS BIGINT) AS saved_tokens, v.ends_sha256
FROM known v JOIN below USING (path) LEFT JOIN nodes u ON v.pos > 0 AND u.path = left(v.path, (v.pos - 1) * 64)
"""

# Every phrase of one to four words as a list, counted; HUGEINT arithmetic is exact.
OP13 = r"""
WITH pieces AS (
    SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws
    FROM (SELECT coalesce(lang, 'und') AS lang,
                 unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                                        'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
          FROM documents)),
places AS (SELECT lang, ws, size, unnest(range(1, len(ws) - size + 2)) AS i FROM pieces, (SELECT unnest([1, 2, 3, 4]) AS size)),
counts AS (SELECT lang, list_slice(ws, i, i + size - 1) AS g, size, count(*) AS f FROM places GROUP BY ALL),
totals AS (SELECT lang, sum(f) AS n FROM counts WHERE size = 1 GROUP BY lang),
candidates AS (SELECT * FROM counts WHERE size > 1 AND f >= 30),
cuts AS (SELECT lang, g, size, f, unnest(range(1, size)) AS k FROM candidates),
scores AS (
    SELECT c.lang, c.g, c.f AS a, x.f AS l, y.f AS r, k, (CAST(2000000 AS HUGEINT) * c.f) // (x.f + y.f) AS score
    FROM cuts c JOIN counts x ON x.lang = c.lang AND x.g = list_slice(c.g, 1, k)
                JOIN counts y ON y.lang = c.lang AND y.g = list_slice(c.g, k + 1, c.size)),
lowest AS (SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1),
starts AS (SELECT lang, g, size, f, inner_size, unnest(range(1, size - inner_size + 2)) AS i
           FROM candidates, (SELECT unnest([2, 3]) AS inner_size) WHERE inner_size < size),
longer AS (SELECT lang, list_slice(g, i, i + inner_size - 1) AS g, max(f) AS f FROM starts GROUP BY ALL),
kept AS (
    SELECT s.*, array_to_string(s.g, ' ') AS phrase FROM lowest s LEFT JOIN longer b ON b.lang = s.lang AND b.g = s.g
    WHERE b.f IS NULL OR 100 * b.f < 80 * s.a)
SELECT lang, CAST(row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS BIGINT) AS rank, phrase,
       CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n,
       CAST(score AS BIGINT) AS score
FROM kept JOIN totals USING (lang) QUALIFY rank <= 2000
"""

SQL = {"op1_decontaminate": OP1, "op3_quality_rules": OP3, "op4_secret_scan": OP4, "op5_mix_sources": OP5,
       "op11_prefix_trie": OP11, "op13_phrases": OP13}
