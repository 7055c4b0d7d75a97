"""DuckDB SQL for the tree-shaped results: the Merkle manifest and the conversation trie."""

from __future__ import annotations

# CRC-32 of a decimal number's text, byte by byte through the table of the reflected polynomial.
CRC_TABLE = """
  SELECT list(v ORDER BY i) AS steps FROM (
    SELECT i, list_reduce([0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[],
      lambda c, x: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i::BIGINT) AS v
    FROM range(256) AS r(i))"""


def crc32(number: str, steps: str = "steps") -> str:
    letters = f"list_transform(string_split({number}::VARCHAR, ''), lambda ch: ascii(ch)::BIGINT)"
    return (
        f"xor(list_reduce({letters}, "
        f"lambda a, b: xor(a >> 8, {steps}[(xor(a, b) & 255) + 1]), 4294967295::BIGINT), 4294967295)"
    )


def _field(value: str) -> str:
    return f"coalesce(strlen({value}::VARCHAR)::VARCHAR || ':' || {value}::VARCHAR, '-')"


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEVELS = 7  # 16 ** 7 leaves a tree


def _forest(name: str) -> str:
    """CTEs over ``{name}(tree, pos, size, h)``: levels, runs and roots."""
    tall = " + ".join(f"(size > {16**k})::INT" for k in range(LEVELS))
    out = [f"{name}_0 AS MATERIALIZED (SELECT tree, {tall} AS tall, pos AS nth, h FROM {name})"]
    for k in range(LEVELS):
        out.append(
            f"{name}_run{k} AS MATERIALIZED (SELECT tree, tall, nth // 16 AS nth, list(h ORDER BY nth) AS hs "
            f"FROM {name}_{k} WHERE tall > {k} GROUP BY ALL)"
        )
        out.append(
            f"{name}_{k + 1} AS MATERIALIZED (SELECT tree, tall, nth, sha256(array_to_string(hs, '')) AS h "
            f"FROM {name}_run{k})"
        )
    roots = " UNION ALL ".join(
        f"SELECT tree, h FROM {name}_{k} WHERE tall = {k}" for k in range(LEVELS + 1)
    )
    out.append(f"{name}_roots AS MATERIALIZED ({roots})")
    return ",\n".join(out)


def _way(name: str, source: str, start: str, tree: str, pos: str) -> str:
    """CTEs that lead ``start`` and the siblings met so far up the trees of ``name``."""
    out, at = [], source
    for k in range(LEVELS):
        place = f"(({pos} // {16**k}) % 16)"
        left, right = f"r.hs[1:{place}]", f"r.hs[{place} + 2:]"
        out.append(
            f"{name}_way{k} AS MATERIALIZED (SELECT w.* REPLACE ("
            f"CASE WHEN r.hs IS NULL THEN {start} ELSE sha256(array_to_string({left}, '') || {start} || "
            f"array_to_string({right}, '')) END AS {start}, "
            f"siblings || coalesce(array_to_string({left} || {right}, ''), '') AS siblings) "
            f"FROM {at} w LEFT JOIN {name}_run{k} r ON r.tree = w.{tree} AND r.nth = w.{pos} // {16 ** (k + 1)})"
        )
        at = f"{name}_way{k}"
    return ",\n".join(out)


_LEAF = "sha256(" + " || ".join(map(_field, ("doc_id", "source", "lang", "n_chars", "text"))) + ")"
_TAMPERED = _LEAF.replace(_field("text"), _field(f"translate(text, '{UPPER}', '{LOWER}')"))

MERKLE = f"""
WITH crc AS ({CRC_TABLE}),
hashed AS MATERIALIZED (
  SELECT doc_id, coalesce('=' || source, '-') AS tree, {_LEAF} AS h,
    CASE WHEN {crc32("doc_id")} % 5 = 0 THEN {_TAMPERED} ELSE {_LEAF} END AS folded
  FROM documents, crc),
a AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, h) - 1 AS pos,
    count(*) OVER (PARTITION BY tree) AS size FROM hashed),
{_forest("a")},
b AS MATERIALIZED (
  SELECT '' AS tree, tree AS name, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS size, h
  FROM a_roots),
{_forest("b")},
start AS (
  SELECT a.doc_id, a.tree, a.h AS leaf, a.folded, a.pos, '' AS siblings, b.h AS subroot,
    b.pos AS top_pos, '' AS top_tree
  FROM a JOIN b ON a.tree = b.name),
{_way("a", "start", "folded", "tree", "pos")},
{_way("b", f"a_way{LEVELS - 1}", "folded", "top_tree", "top_pos")}
SELECT doc_id, leaf, subroot, h AS root, sha256(siblings) AS proof_sha256, folded AS folded_root,
  folded = h AS verified
FROM b_way{LEVELS - 1}, b_roots"""

TRIE = f"""
WITH crc AS ({CRC_TABLE}),
own AS MATERIALIZED (
  SELECT conv_id, list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}}
    ORDER BY turn NULLS FIRST, role, text) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
drawn AS (SELECT own.*, {crc32("conv_id")} % 6 AS h FROM own, crc),
rebuilt AS MATERIALIZED (
  SELECT d.conv_id, coalesce(b.turns[1:d.h], []) || d.turns[d.h + 1:] AS turns
  FROM drawn d LEFT JOIN own b ON b.conv_id = d.conv_id - d.conv_id % 100),
marked AS (
  SELECT conv_id, turns, list_transform(turns, lambda t: sha256(
    length(t.role)::VARCHAR || ':' || t.role || t.text)) AS marks FROM rebuilt),
placed AS MATERIALIZED (
  SELECT conv_id, unnest(range(0, len(turns) + 1)) AS depth, turns, marks FROM marked),
members AS MATERIALIZED (
  SELECT conv_id, depth, sha256(array_to_string(marks[1:depth], '')) AS node,
    CASE WHEN depth > 0 THEN sha256(array_to_string(marks[1:depth - 1], '')) END AS parent,
    CASE WHEN depth > 0 THEN length(turns[depth].text) ELSE 0 END AS tokens,
    len(turns) = depth AS ends,
    CASE WHEN depth > 0 THEN list_transform(range(0, depth + 1),
      lambda k: sha256(array_to_string(marks[1:k], ''))) ELSE [sha256('')] END AS way
  FROM placed),
nodes AS MATERIALIZED (
  SELECT node, depth, any_value(parent) AS parent, any_value(tokens) AS tokens, any_value(way) AS way,
    min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ends), ''))
      AS ends_sha256
  FROM members GROUP BY node, depth),
children AS (SELECT parent AS node, count(*) AS n FROM nodes WHERE parent IS NOT NULL GROUP BY parent),
sums AS (
  SELECT above AS node, sum((n_convs - 1) * tokens)::BIGINT AS saved_tokens,
    count(*) FILTER (WHERE childless) AS n_leaves
  FROM (SELECT unnest(way) AS above, n_convs, tokens, c.n IS NULL AS childless
        FROM nodes LEFT JOIN children c USING (node))
  GROUP BY above)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n, 0) AS n_children,
  s.n_leaves, s.saved_tokens, n.ends_sha256
FROM nodes n LEFT JOIN nodes p ON n.parent = p.node LEFT JOIN children c ON c.node = n.node
JOIN sums s ON s.node = n.node"""


def joined(shingle: int, percent: int, more: str) -> str:
    """Components of documents whose shingle sets have a Jaccard similarity of ``percent``."""
    return rf"""
WITH RECURSIVE docs AS MATERIALIZED (
  SELECT doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
  FROM documents),
grams AS MATERIALIZED (
  SELECT DISTINCT doc_id, gram FROM (
    SELECT doc_id, unnest(list_transform(range(1, greatest(len(words) - {shingle - 2}, 2)),
      lambda p: array_to_string(words[p:p + {shingle - 1}], ' '))) AS gram
    FROM docs WHERE len(words) > 0)),
sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
links AS MATERIALIZED (
  SELECT x.doc_id AS a, y.doc_id AS b
  FROM grams x JOIN grams y ON x.gram = y.gram AND x.doc_id <> y.doc_id
  JOIN sizes s ON s.doc_id = x.doc_id JOIN sizes t ON t.doc_id = y.doc_id
  GROUP BY x.doc_id, y.doc_id, s.n, t.n
  HAVING 100 * count(*) >= {percent} * (s.n + t.n - count(*))),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM docs
  UNION
  SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other)
SELECT d.doc_id, coalesce(any_value(n), 0) AS n_shingles, min(other) AS component_id{more}
FROM docs d LEFT JOIN sizes s ON s.doc_id = d.doc_id JOIN reach r ON r.doc_id = d.doc_id
GROUP BY d.doc_id"""
