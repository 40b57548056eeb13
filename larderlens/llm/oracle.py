"""The same results in DuckDB SQL, where SQL can express them."""

from __future__ import annotations

ORACLE: dict[str, str] = {
    "op4_exact_dedup": r"""
WITH facts AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER same AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       row_number() OVER same = 1 AS kept,
       text_sha256
FROM facts
WINDOW same AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id NULLS LAST)
""",
    "op12_phrase_mining": r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
lists AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM pieces),
spots AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM lists),
grams AS (
  SELECT lang, m, ws[i:i + m - 1] AS words, count(*) AS f
  FROM spots, (SELECT unnest([1, 2, 3]) AS m) WHERE i + m - 1 <= len(ws)
  GROUP BY ALL),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM grams WHERE m = 1 GROUP BY lang),
candidates AS (SELECT lang, m, words, f AS a FROM grams WHERE m > 1 AND f >= 10),
cuts AS (SELECT lang, m, words, a, unnest(range(1, m)) AS k FROM candidates),
scores AS (
  SELECT c.lang, c.words, c.a, c.k, x.f AS l, y.f AS r, ((1000000::HUGEINT * c.a * c.a) // (x.f::HUGEINT * y.f))::BIGINT AS score
  FROM cuts c
  JOIN grams x ON x.lang = c.lang AND x.words = c.words[1:c.k]
  JOIN grams y ON y.lang = c.lang AND y.words = c.words[c.k + 1:]),
lowest AS (SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, words ORDER BY score, k) = 1),
covers AS (
  SELECT lang, words[1:2] AS words, max(a) AS longer FROM candidates WHERE m = 3 GROUP BY ALL
  UNION ALL
  SELECT lang, words[2:3] AS words, max(a) AS longer FROM candidates WHERE m = 3 GROUP BY ALL),
kept AS (
  SELECT lang, array_to_string(words, ' ') AS phrase, a, l, r, score
  FROM lowest s
  WHERE NOT EXISTS (SELECT 1 FROM covers c WHERE c.lang = s.lang AND c.words = s.words AND 100 * c.longer >= 50 * s.a))
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM kept JOIN totals USING (lang)
QUALIFY rank <= 2000
""",
    "op13_conversation_trie": r"""
WITH RECURSIVE bits(byte, v, k) AS (
  SELECT range, range, 0 FROM range(256)
  UNION ALL
  SELECT byte, CASE WHEN v % 2 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, k + 1 FROM bits WHERE k < 8),
crc AS (SELECT list(v ORDER BY byte) AS t FROM bits WHERE k = 8),
turns AS (
  SELECT conv_id, struct_pack(r := coalesce(role, ''), x := coalesce(text, '')) AS t,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS n
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (SELECT conv_id, list(t ORDER BY n) AS own FROM turns GROUP BY conv_id),
steps AS (
  SELECT conv_id, own,
         xor(list_reduce(list_transform(range(1, len(conv_id::VARCHAR) + 1), lambda i: ascii(substr(conv_id::VARCHAR, i, 1))::BIGINT),
                         lambda c, b: xor(c >> 8, t[(xor(c, b) % 256) + 1]), 4294967295::BIGINT), 4294967295) % 9 AS h
  FROM convs, crc),
built AS (
  SELECT s.conv_id, list_concat(coalesce(b.own, [])[1:s.h], s.own[s.h + 1:]) AS path
  FROM steps s LEFT JOIN convs b ON b.conv_id = s.conv_id - s.conv_id % 5),
spots AS (SELECT conv_id, path, unnest(range(0, len(path) + 1)) AS depth FROM built),
prefixes AS (
  SELECT conv_id, depth, depth = len(path) AS ends, md5(path[1:depth]::VARCHAR) AS node,
         CASE WHEN depth > 0 THEN md5(path[1:depth - 1]::VARCHAR) END AS parent,
         CASE WHEN depth > 0 THEN strlen(path[depth].x) ELSE 0 END AS size
  FROM spots),
nodes AS (
  SELECT node, min(conv_id) AS conv_id, any_value(depth) AS depth, any_value(parent) AS parent, any_value(size) AS size, count(*) AS n_convs,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
  FROM prefixes GROUP BY node),
kids AS (SELECT parent AS node, count(*) AS n_children FROM nodes WHERE parent IS NOT NULL GROUP BY parent),
facts AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM nodes n LEFT JOIN kids USING (node)),
sums AS (
  SELECT p.node, count(*) FILTER (WHERE f.n_children = 0) AS n_leaves, sum((f.n_convs - 1) * f.size)::BIGINT AS saved_tokens
  FROM facts f JOIN prefixes p ON p.conv_id = f.conv_id AND p.depth <= f.depth
  GROUP BY p.node)
SELECT f.conv_id, f.depth, u.conv_id AS parent_conv_id, f.n_convs, f.n_children, s.n_leaves, s.saved_tokens, f.ends_sha256
FROM facts f JOIN sums s USING (node) LEFT JOIN nodes u ON u.node = f.parent
""",
}
