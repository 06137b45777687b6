"""DuckDB SQL of the text operators that SQL can express whole."""

from __future__ import annotations


def crc32_sql(text: str) -> str:
    """Unsigned crc32 of an ASCII text, byte by byte (eight shifts each)."""
    reduce_bits = ("list_reduce([xor(a, x), 0, 0, 0, 0, 0, 0, 0, 0], lambda b, y: "
                   "xor(b >> 1, CASE WHEN b & 1 = 1 THEN 3988292384 ELSE 0 END))")
    return (f"xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform("
            f"string_split({text}, ''), lambda c: ascii(c)::BIGINT)), lambda a, x: {reduce_bits}), "
            f"4294967295::BIGINT)")


def field_sql(column: str) -> str:
    value = f"({column})::VARCHAR"
    return f"coalesce(strlen({value})::VARCHAR || ':' || {value}, '-')"


def merkle_sql() -> str:
    def leaf(text: str) -> str:
        return "sha256(" + " || ".join(field_sql(c) for c in (
            "doc_id", "source", "lang", "n_chars", text)) + ")"
    return f"""
WITH RECURSIVE
leaves AS (
  SELECT doc_id, source, {leaf('text')} AS leaf,
         CASE WHEN {crc32_sql('doc_id::VARCHAR')} % 2 = 0 THEN {leaf("replace(text, chr(10), '')")}
              ELSE {leaf('text')} END AS changed
  FROM documents),
placed AS (
  SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS src,
         row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
         count(*) OVER (PARTITION BY source) AS n
  FROM leaves),
inner_nodes(src, level, pos, n, d) AS (
  SELECT src, 0::BIGINT, pos, n, leaf FROM placed
  UNION ALL
  SELECT src, level + 1, pos // 3, (max(n) + 2) // 3, sha256(string_agg(d, '' ORDER BY pos))
  FROM inner_nodes WHERE n > 1 GROUP BY src, level, pos // 3),
subroots AS (SELECT src, level AS height, d AS subroot FROM inner_nodes WHERE n = 1),
top_nodes(level, pos, n, d) AS (
  SELECT 0::BIGINT, src, (SELECT count(*) FROM subroots), subroot FROM subroots
  UNION ALL
  SELECT level + 1, pos // 3, (max(n) + 2) // 3, sha256(string_agg(d, '' ORDER BY pos))
  FROM top_nodes WHERE n > 1 GROUP BY level, pos // 3),
the_root AS (SELECT d AS root FROM top_nodes WHERE n = 1),
-- every node under a parent: its tree (a source, or -1 for the tree of sources) and siblings
steps AS (
  SELECT src, level, pos,
         coalesce(string_agg(d, '') OVER (PARTITION BY src, level, pos // 3 ORDER BY pos
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
         coalesce(string_agg(d, '') OVER (PARTITION BY src, level, pos // 3 ORDER BY pos
           ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS behind
  FROM (SELECT * FROM inner_nodes UNION ALL SELECT -1, * FROM top_nodes) WHERE n > 1),
numbered AS (SELECT *, row_number() OVER () AS doc FROM placed),
climb(doc, src, level, pos, cur, proof) AS (
  SELECT doc, src, 0::BIGINT, pos, changed, '' FROM numbered
  UNION ALL
  SELECT c.doc, c.src, c.level + 1, c.pos // 3, sha256(s.before || c.cur || s.behind),
         c.proof || s.before || s.behind
  FROM climb c JOIN steps s ON s.src = c.src AND s.level = c.level AND s.pos = c.pos),
climb_on(doc, level, pos, cur, proof) AS (
  SELECT c.doc, 0::BIGINT, c.src, c.cur, c.proof
  FROM climb c JOIN subroots t ON t.src = c.src AND t.height = c.level
  UNION ALL
  SELECT c.doc, c.level + 1, c.pos // 3, sha256(s.before || c.cur || s.behind),
         c.proof || s.before || s.behind
  FROM climb_on c JOIN steps s ON s.src = -1 AND s.level = c.level AND s.pos = c.pos)
SELECT p.doc_id, p.leaf, t.subroot, r.root, sha256(c.proof) AS proof_sha256,
       c.cur AS folded_root, c.cur = r.root AS verified
FROM numbered p
JOIN climb_on c ON c.doc = p.doc
     AND c.level = (SELECT max(level) FROM top_nodes)
JOIN subroots t ON t.src = p.src
CROSS JOIN the_root r"""


def prefix_trie_sql() -> str:
    turn = "sha256(strlen(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, ''))"
    return f"""
WITH
turns AS (
  SELECT conv_id, {turn} AS step, length(coalesce(text, ''))::BIGINT AS points,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, substr({turn}, 1, 32)) AS place
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT conv_id, list({{'step': step, 'points': points}} ORDER BY place) AS path
        FROM turns GROUP BY conv_id),
cut AS (SELECT *, ({crc32_sql('conv_id::VARCHAR')} % 6)::BIGINT AS h FROM own),
built AS (
  SELECT c.conv_id,
         list_concat(coalesce(b.path[:c.h], []), c.path[c.h + 1:]) AS path
  FROM cut c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 100),
members AS (
  SELECT conv_id, len(path) AS size, d AS depth, path[d].points AS points,
         list_transform(path[:d], lambda s: s.step) AS steps
  FROM (SELECT *, unnest(range(0, len(path) + 1)) AS d FROM built)),
nodes AS (
  SELECT steps, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         CASE WHEN depth = 0 THEN 0 ELSE (count(*) - 1) * max(points) END AS saved,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)
                         FILTER (size = depth), '')) AS ends_sha256
  FROM members GROUP BY steps, depth),
kids AS (SELECT steps[:-2] AS steps, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1),
below AS (
  SELECT a.steps, sum(b.saved) AS saved, count(*) FILTER (k.n IS NULL) AS leaves
  FROM (SELECT *, unnest(range(0, depth + 1)) AS up FROM nodes) b
  JOIN nodes a ON a.steps = b.steps[:b.up]
  LEFT JOIN kids k ON k.steps = b.steps
  GROUP BY a.steps)
SELECT n.conv_id, n.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs,
       coalesce(k.n, 0) AS n_children, b.leaves AS n_leaves, b.saved::BIGINT AS saved_tokens,
       n.ends_sha256
FROM nodes n JOIN below b ON b.steps = n.steps
LEFT JOIN kids k ON k.steps = n.steps
LEFT JOIN nodes p ON n.depth > 0 AND p.steps = n.steps[:-2]"""


def shingle_join_sql() -> str:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return rf"""
WITH RECURSIVE
words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'),
                                    '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT doc_id, list_distinct(CASE
           WHEN len(w) = 0 THEN []
           WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
           ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s
  FROM words),
grams AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id
  HAVING 100 * count(*) >= 80 * (max(a.n) + max(b.n) - count(*))),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM sets
  UNION
  SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, min(r.other) AS component_id
FROM sets s JOIN reach r ON r.doc_id = s.doc_id
GROUP BY s.doc_id, len(s.s)"""
