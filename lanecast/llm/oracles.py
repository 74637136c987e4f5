"""SQL for the queries of this subpackage that SQL can express over whole tables, written over the given tables alone."""

from __future__ import annotations

# crc32 of the decimal digits of doc_id, unsigned: eight shifts a byte. 3988292384 is the reversed polynomial 0xEDB88320.
_SHIFT8 = "list_reduce([xor({c}, {b}), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))"
_BYTES = "list_transform(string_split(doc_id::VARCHAR, ''), lambda s: ascii(s)::BIGINT)"
CRC32 = f"xor(list_reduce({_BYTES}, lambda c, b: {_SHIFT8.format(c='c', b='b')}, 4294967295::BIGINT), 4294967295)"

def _leaf_field(name: str) -> str:
    text = f"{name}::VARCHAR"
    return f"CASE WHEN {name} IS NULL THEN '-' ELSE strlen({text}) || ':' || {text} END"


ORACLES: dict[str, str] = {
    "op3_jaccard_join": r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN []
           WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
           ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) END AS s
  FROM words),
shingles AS (SELECT doc_id, len(s) AS n, hash(x) AS x FROM (SELECT doc_id, s, unnest(s) AS x FROM sets)),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c, any_value(a.n) AS na, any_value(b.n) AS nb
  FROM shingles a JOIN shingles b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM common WHERE 100 * c >= 85 * (na + nb - c)),
both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (SELECT a, b FROM both_ways UNION SELECT r.a, e.b FROM reach r JOIN both_ways e ON r.b = e.a)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, least(s.doc_id, coalesce(r.m, s.doc_id)) AS component_id
FROM sets s LEFT JOIN (SELECT a, min(b) AS m FROM reach GROUP BY a) r ON r.a = s.doc_id
""",
    "op12_merkle_manifest": f"""
WITH RECURSIVE fields AS (
  SELECT doc_id, lang, source, text, n_chars, n_chars + CASE WHEN {CRC32} % 7 = 0 THEN 1 ELSE 0 END AS n_altered FROM documents),
base AS (
  SELECT doc_id, lang, sha256(head || number || tail) AS leaf, sha256(head || altered || tail) AS altered
  FROM (SELECT doc_id, lang, concat(@fields) AS head, @number AS number, @altered AS altered, @text AS tail FROM fields)),
leaves AS (
  SELECT *, dense_rank() OVER (ORDER BY encode(lang) NULLS FIRST) - 1 AS tree,
         row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n FROM base),
lang_nodes(tree, level, pos, digest, n) AS (
  SELECT tree, 0, pos, leaf, n FROM leaves
  UNION ALL
  SELECT tree, level + 1, pos // 2, sha256(string_agg(digest, '' ORDER BY pos)), (n + 1) // 2
  FROM lang_nodes WHERE n > 1 GROUP BY tree, level, pos // 2, n),
subroots AS (SELECT tree, max(level) AS height, arg_max(digest, level) AS subroot FROM lang_nodes GROUP BY tree),
top_nodes(level, pos, digest, n) AS (
  SELECT 0, tree, subroot, (SELECT count(*) FROM subroots) FROM subroots
  UNION ALL
  SELECT level + 1, pos // 2, sha256(string_agg(digest, '' ORDER BY pos)), (n + 1) // 2
  FROM top_nodes WHERE n > 1 GROUP BY level, pos // 2, n),
top AS (SELECT max(level) AS height, arg_max(digest, level) AS root FROM top_nodes),
climb(doc_id, tree, step, pos, folded, siblings) AS (
  SELECT l.doc_id, l.tree, 0, l.pos, l.altered, '' FROM leaves l
  UNION ALL
  SELECT c.doc_id, c.tree, c.step + 1,
         CASE WHEN c.step + 1 = s.height THEN c.tree ELSE c.pos // 2 END,
         sha256(CASE WHEN c.pos % 2 = 1 THEN coalesce(a.digest, b.digest, '') || c.folded ELSE c.folded || coalesce(a.digest, b.digest, '') END),
         c.siblings || coalesce(a.digest, b.digest, '')
  FROM (SELECT c.doc_id, c.tree, c.step, c.folded, c.siblings, c.pos FROM climb c) c
  JOIN subroots s ON s.tree = c.tree CROSS JOIN top
  LEFT JOIN lang_nodes a ON c.step < s.height AND a.tree = c.tree AND a.level = c.step AND a.pos = xor(c.pos, 1)
  LEFT JOIN top_nodes b ON c.step >= s.height AND b.level = c.step - s.height AND b.pos = xor(c.pos, 1)
  WHERE c.step < s.height + top.height)
SELECT l.doc_id, l.leaf, s.subroot, top.root, sha256(c.siblings) AS proof_sha256, c.folded AS folded_root, c.folded = top.root AS verified
FROM leaves l JOIN subroots s ON s.tree = l.tree CROSS JOIN top
JOIN climb c ON c.doc_id = l.doc_id AND c.step = s.height + top.height
""".replace("@fields", ", ".join(_leaf_field(c) for c in ("doc_id", "source", "lang")))
    .replace("@number", _leaf_field("n_chars"))
    .replace("@altered", _leaf_field("n_altered"))
    .replace("@text", _leaf_field("text")),
    "op13_line_filters": r"""
WITH lines AS (
  SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS place FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)),
keyed AS (
  SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
common AS (SELECT key FROM keyed WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(c.key) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE c.key IS NULL), '')) AS kept_sha256
FROM keyed LEFT JOIN common c ON keyed.key = c.key GROUP BY doc_id
""",
}
