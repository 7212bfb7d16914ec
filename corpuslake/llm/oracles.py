"""DuckDB SQL of the operators' queries that SQL can express."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORDS = r"list_filter(regexp_split_to_array({}, '[\x20\x09-\x0D]+'), lambda x: length(x) > 0)"

#: Exact classes: all pairs that share a shingle, then a recursive closure.
NEAR_DUPLICATES = f"""
WITH RECURSIVE w AS (SELECT doc_id, {_WORDS.format(f"translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}')")} AS w
                     FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS g
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM w WHERE len(w) > 0) z),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b USING (g)
      WHERE a.doc_id < b.doc_id GROUP BY 1, 2),
e AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 85 * (a.n + b.n - c)),
both_ways AS (SELECT x, y FROM e UNION SELECT y, x FROM e),
r(node, label) AS (SELECT doc_id, doc_id FROM documents
                   UNION SELECT b.y, r.label FROM r JOIN both_ways b ON b.x = r.node)
SELECT r.node AS doc_id, coalesce(max(n.n), 0)::BIGINT AS n_shingles, min(r.label) AS component_id,
       min(r.label) = r.node AS kept
FROM r LEFT JOIN n ON n.doc_id = r.node GROUP BY r.node"""

TOOL_CALLS = f"""
WITH RECURSIVE turns AS (
  SELECT conv_id, turn, role, text AS raw, coalesce(text, '') AS text, len({_WORDS.format("coalesce(text, '')")}) AS words,
         ascii(md5(coalesce(text, ''))) % 3 AS pick, 'call_' || conv_id || '_' || turn AS id FROM conversations),
every AS (
  SELECT id, conv_id, turn, text, words, pick, CASE WHEN turn >= 2 THEN 'call_' || conv_id || '_' || (turn - 2) END AS up,
         ['de', 'en', 'es', 'fr', 'xx'][(length(text) % 5 + 1)::INT] AS tgt,
         count(*) OVER (PARTITION BY id) AS n_calls,
         row_number() OVER (PARTITION BY id ORDER BY pick, text) AS nth
  FROM turns WHERE role = 'user' AND id IS NOT NULL),
calls AS (SELECT * FROM every WHERE nth = 1),
results AS (SELECT 'call_' || conv_id || '_' || (turn - 1) AS id, count(*) AS n_results, min(raw) AS content
            FROM turns WHERE role = 'assistant' AND id IS NOT NULL GROUP BY 1),
levels(id, depth, missing) AS (
  SELECT c.id, 0, c.up IS NOT NULL FROM calls c WHERE c.up IS NULL OR c.up NOT IN (SELECT id FROM calls)
  UNION ALL SELECT c.id, l.depth + 1, l.missing FROM calls c JOIN levels l ON c.up = l.id),
linked AS (
  SELECT c.*, l.depth, l.missing, coalesce(r.n_results, 0) AS n_results, r.content,
         row_number() OVER (PARTITION BY conv_id ORDER BY l.depth, turn, c.id) - 1 AS position
  FROM calls c JOIN levels l USING (id) LEFT JOIN results r USING (id)),
checked AS (
  SELECT *, CASE pick
    WHEN 0 THEN [CASE WHEN words NOT BETWEEN 1 AND 200 THEN '.limit: out of bounds' END,
                 CASE WHEN length(text) NOT BETWEEN 1 AND 2000 THEN '.query: wrong length' END]
    WHEN 1 THEN [CASE WHEN text = '' THEN '.text: wrong length' END, CASE WHEN tgt = 'xx' THEN '.to: not allowed' END]
    ELSE [CASE WHEN words < 1 THEN '.words: out of bounds' END] END AS bad FROM linked)
SELECT conv_id, turn, id AS call_id, depth::BIGINT AS depth, position::BIGINT AS position, n_calls::BIGINT AS n_calls,
       n_results::BIGINT AS n_results, len(list_filter(bad, lambda x: x IS NOT NULL)) = 0 AS valid,
       array_to_string(list_filter(list_concat(bad, [
         CASE WHEN missing THEN 'depends_on: missing' END, CASE WHEN n_results = 0 THEN 'result: missing' END,
         CASE WHEN n_calls > 1 THEN 'call: repeated id' END, CASE WHEN n_results > 1 THEN 'result: repeated' END]),
         lambda x: x IS NOT NULL), '; ') AS errors,
       '{{"arguments":' || CASE pick
         WHEN 0 THEN '{{"limit":' || words || ',"query":' || to_json(text) || '}}'
         WHEN 1 THEN '{{"text":' || to_json(text) || ',"to":"' || tgt || '"}}'
         ELSE '{{"of":' || to_json(text) || ',"words":' || words || '}}' END
       || ',"depends_on":' || coalesce(to_json(up)::VARCHAR, 'null') || ',"id":' || to_json(id)
       || ',"name":"' || ['search', 'translate', 'count'][pick + 1] || '","position":' || position
       || ',"result":' || coalesce(to_json(content)::VARCHAR, 'null') || '}}' AS json
FROM checked
UNION ALL SELECT NULL, NULL, id, NULL, NULL, 0, n_results, false,
       'call: missing' || CASE WHEN n_results > 1 THEN '; result: repeated' ELSE '' END,
       '{{"arguments":null,"depends_on":null,"id":' || to_json(id) || ',"name":null,"position":null,"result":'
       || coalesce(to_json(content)::VARCHAR, 'null') || '}}'
FROM results WHERE id IS NOT NULL AND id NOT IN (SELECT id FROM calls)"""

COLLOCATIONS = f"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang,
             unnest(regexp_split_to_array(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[.,;:!?\x0A-\x0D]')) AS piece
           FROM documents),
q AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: length(x) > 0) AS w FROM p),
g AS (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
      FROM q, (VALUES (1), (2), (3)) t(k) WHERE len(w) >= k),
f AS (SELECT lang, k, phrase, count(*) AS a FROM g GROUP BY ALL),
tot AS (SELECT lang, sum(a)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, phrase, a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND a >= 10),
cuts AS (SELECT c.*, cut, l.a AS l, r.a AS r, (1000000::HUGEINT * c.a * c.a) // (l.a::HUGEINT * r.a) AS score
         FROM (SELECT c.*, unnest(range(1, k)) AS cut FROM c) c
         JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(w[1:cut], ' ')
         JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(w[cut + 1:], ' ')),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
longer AS (SELECT lang, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase, a FROM c WHERE k = 3),
around AS (SELECT lang, phrase, max(a) AS around FROM longer GROUP BY ALL)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n,
       score::BIGINT AS score
FROM best LEFT JOIN around USING (lang, phrase) JOIN tot USING (lang)
WHERE around IS NULL OR 100 * around < 50 * a
QUALIFY rank <= 2000"""

#: crc32 of a text, a bit at a time: bytes are mixed in, negative entries shift.
_CRC = ("xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split({0}, ''), "
        "lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))), "
        "lambda a, x: CASE WHEN x < 0 THEN xor(a >> 1, 3988292384 * (a & 1)) ELSE xor(a, x) END), 4294967295)")

PREFIX_TRIE = f"""
WITH t AS (SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text, turn,
             md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || ':' || coalesce(text, '')) AS tid
           FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT c, tid, length(text) AS chars, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, tid) - 1 AS pos FROM t),
conv AS (SELECT DISTINCT c, c - c % 100 AS base, {_CRC.format("c::VARCHAR")} % 6 AS h FROM t),
seq AS (SELECT conv.c, 0 AS part, pos, tid, chars FROM conv JOIN own ON own.c = base WHERE pos < h
        UNION ALL SELECT conv.c, 1, pos, tid, chars FROM conv JOIN own ON own.c = conv.c WHERE pos >= h),
step AS (SELECT c, row_number() OVER (PARTITION BY c ORDER BY part, pos) AS depth, chars,
           md5(string_agg(tid, ',') OVER (PARTITION BY c ORDER BY part, pos)) AS node FROM seq
         UNION ALL SELECT c, 0, 0, 'root' FROM conv),
n AS (SELECT node, depth, min(c) AS conv_id, count(*) AS n_convs, max(chars) AS chars FROM step GROUP BY node, depth),
final AS (SELECT c, arg_max(node, depth) AS node FROM step GROUP BY c),
ends AS (SELECT node, sha256(string_agg(c::VARCHAR, ',' ORDER BY c)) AS ends FROM final GROUP BY node),
up AS (SELECT DISTINCT a.node AS child, b.node AS parent FROM step a JOIN step b ON a.c = b.c AND b.depth = a.depth - 1),
kids AS (SELECT parent AS node, count(*) AS n_children FROM up GROUP BY parent),
leaf AS (SELECT node FROM n WHERE node NOT IN (SELECT node FROM kids)),
leaves AS (SELECT s.node, count(DISTINCT f.node) AS n_leaves FROM step s JOIN final f USING (c) JOIN leaf l ON l.node = f.node GROUP BY s.node),
saved AS (SELECT s.node, sum((n.n_convs - 1) * n.chars) AS saved FROM n JOIN step s ON s.c = n.conv_id AND s.depth <= n.depth GROUP BY s.node)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children, n_leaves,
       saved::BIGINT AS saved_tokens, coalesce(ends, sha256('')) AS ends_sha256
FROM n LEFT JOIN up ON up.child = n.node LEFT JOIN n p ON p.node = up.parent LEFT JOIN kids ON kids.node = n.node
LEFT JOIN ends ON ends.node = n.node JOIN leaves ON leaves.node = n.node JOIN saved ON saved.node = n.node"""
