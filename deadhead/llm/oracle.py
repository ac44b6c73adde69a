"""DuckDB statements for the registered queries that SQL can express."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _lowered(column: str) -> str:
    return f"translate(coalesce({column}, ''), '{_UPPER}', '{_LOWER}')"


_GRAM_WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_SPACED_WORDS = r"[^\x20\x09-\x0D]+"


def _written(column: str) -> str:
    text = f"CAST({column} AS VARCHAR)"
    return f"CASE WHEN {column} IS NULL THEN '-' ELSE CAST(strlen({text}) AS VARCHAR) || ':' || {text} END"


def _climbed(name: str, tree: str, first: str, levels: int) -> str:
    """CTEs name0, name1, ...: nodes (tree, pos, n, h) of each level; a tree that is down to one node stays as it is."""
    found = [f"{name}0 AS ({first})"]
    for k in range(levels):
        below = f"{name}{k}"
        found.append(
            f"""{name}{k + 1} AS (
  SELECT {tree}, pos // 8 AS pos, CASE WHEN n > 1 THEN (n + 7) // 8 ELSE n END AS n,
         CASE WHEN n > 1 THEN sha256(string_agg(h, '' ORDER BY pos)) ELSE any_value(h) END AS h
  FROM {below} GROUP BY {tree}, pos // 8, n
)"""
        )
    return ",\n".join(found)


def _siblings(name: str, tree: str, levels: int, at: str) -> tuple[str, str, str]:
    """Columns with the siblings left and right of a place at each level, as left0, right0, ..., and the joins for them."""
    ctes, columns, joins = [], [], []
    for k in range(levels):
        own = f"{name}s{k}"
        ctes.append(
            f"""{own} AS (
  SELECT {tree}, pos, coalesce(string_agg(h, '') OVER (PARTITION BY {tree}, pos // 8 ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
         coalesce(string_agg(h, '') OVER (PARTITION BY {tree}, pos // 8 ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r, n
  FROM {name}{k}
)"""
        )
        columns.append(f"{own}.l AS {name}l{k}, {own}.r AS {name}r{k}, {own}.n AS {name}n{k}")
        joins.append(f"JOIN {own} ON {own}.{tree} = d.{tree} AND {own}.pos = {at} // {8**k}")
    return ",\n".join(ctes), ", ".join(columns), "\n".join(joins)


def _merkle(levels: int = 7, upper: int = 3) -> str:
    """Trees of up to 8^levels leaves and 8^upper groups; a NULL id and a NULL group come first."""
    lower_ctes, lower_columns, lower_joins = _siblings("w", "tree", levels, "d.pos")
    upper_ctes, upper_columns, upper_joins = _siblings("u", "one", upper, "d.tree")
    steps = [("w", k) for k in range(levels)] + [("u", k) for k in range(upper)]
    proof = " || ".join(f"CASE WHEN {a}n{k} > 1 THEN {a}l{k} || {a}r{k} ELSE '' END" for a, k in steps)
    folds, last = [], "f0"
    for k, (a, level) in enumerate(steps):
        folds.append(f"f{k + 1} AS (SELECT *, CASE WHEN {a}n{level} > 1 THEN sha256({a}l{level} || g{k} || {a}r{level}) ELSE g{k} END AS g{k + 1} FROM f{k})")
        last = f"f{k + 1}"
    leaf = " || ".join(_written(c) for c in ("doc_id", "source", "lang", "n_chars", "text"))
    lowered = leaf.replace(_written("text"), _written(f"translate(text, '{_UPPER}', '{_LOWER}')"))
    # crc32 of the id's decimal text: eight steps for each character, which the first of them brings in
    state = "xor(acc, CASE WHEN i % 8 = 0 THEN ascii(substr(id, CAST(i // 8 + 1 AS INTEGER), 1)) ELSE 0 END)"
    crc = f"xor(list_reduce(list_concat([4294967295::BIGINT], range(8 * len(id))), lambda acc, i: xor(({state}) >> 1, (({state}) & 1) * 3988292384::BIGINT)), 4294967295::BIGINT)"
    return f"""
WITH rows AS (
  SELECT row_number() OVER () AS row, doc_id, CAST(doc_id AS VARCHAR) AS id, lang, sha256({leaf}) AS leaf, sha256({lowered}) AS lowered FROM documents
), d AS (
  SELECT *, 1 AS one, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree,
         row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf, row) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n,
         CASE WHEN id IS NOT NULL AND {crc} % 3 = 0 THEN lowered ELSE leaf END AS g0
  FROM rows
), {_climbed("w", "tree", "SELECT tree, pos, n, leaf AS h FROM d", levels)},
{_climbed("u", "one", f"SELECT 1 AS one, tree AS pos, count(*) OVER () AS n, h FROM w{levels}", upper)},
{lower_ctes},
{upper_ctes},
f0 AS (
  SELECT d.doc_id, d.leaf, d.g0, w{levels}.h AS subroot, u{upper}.h AS root, {lower_columns}, {upper_columns}
  FROM d JOIN w{levels} ON w{levels}.tree = d.tree JOIN u{upper} ON TRUE
{lower_joins}
{upper_joins}
), {", ".join(folds)}
SELECT doc_id, leaf, subroot, root, sha256({proof}) AS proof_sha256, g{len(steps)} AS folded_root, g{len(steps)} = root AS verified FROM {last}
"""


SQL: dict[str, str] = {
    "op1_decontaminate": f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_lowered("text")}, '{_GRAM_WORDS}') AS w FROM documents
), b AS (
  SELECT item_id, regexp_extract_all({_lowered("text")}, '{_GRAM_WORDS}') AS w FROM benchmark
), grams AS (
  SELECT DISTINCT item_id, array_to_string(w[i:i + 9], ' ') AS g, least(10, len(w)) AS n
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)
), sizes AS (
  SELECT DISTINCT n FROM grams
), windows AS (
  SELECT r, i, n, array_to_string(w[i:i + n - 1], ' ') AS g
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)
), hits AS (
  SELECT DISTINCT r, i, n, item_id FROM windows JOIN grams USING (g, n)
), hit_words AS (
  SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hits) GROUP BY r
), hit_items AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM hits WHERE item_id IS NOT NULL) GROUP BY r
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit_words USING (r) LEFT JOIN hit_items USING (r)
""",
    "op2_substrings": f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '{_SPACED_WORDS}') AS w FROM documents
), windows AS (
  SELECT r, i, array_to_string(w[i:i + 34], ' ') AS g
  FROM (SELECT r, w, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) >= 35)
), repeated AS (
  SELECT g FROM windows GROUP BY g HAVING count(*) > 1
), gone AS (
  SELECT DISTINCT r, p FROM (SELECT r, unnest(range(i, i + 35)) AS p FROM windows JOIN repeated USING (g))
), words AS (
  SELECT r, unnest(range(1, len(w) + 1)) AS p, unnest(w) AS word FROM d
), kept AS (
  SELECT r, string_agg(word, ' ' ORDER BY p) AS kept, count(*) AS n FROM words ANTI JOIN gone USING (r, p) GROUP BY r
)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
""",
    "op9_jaccard": f"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_lowered("text")}, '{_SPACED_WORDS}') AS w FROM documents
), shingles AS (
  SELECT DISTINCT r, array_to_string(w[i:i + 2], ' ') AS s
  FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM d WHERE len(w) > 0)
), sizes AS (
  SELECT r, count(*) AS n FROM shingles GROUP BY r
), links AS (
  SELECT a.r AS x, b.r AS y
  FROM shingles a JOIN shingles b USING (s) JOIN sizes m ON m.r = a.r JOIN sizes n ON n.r = b.r
  WHERE a.r <> b.r
  GROUP BY a.r, b.r, m.n, n.n HAVING 100 * count(*) >= 90 * (m.n + n.n - count(*))
), reach(r, x) AS (
  SELECT r, r FROM d UNION SELECT reach.r, links.y FROM reach JOIN links ON links.x = reach.x
)
SELECT any_value(d.doc_id) AS doc_id, coalesce(any_value(sizes.n), 0) AS n_shingles, min(other.doc_id) AS component_id
FROM d LEFT JOIN sizes USING (r) JOIN reach USING (r) JOIN d other ON other.r = reach.x
GROUP BY d.r
""",
    "op12_merkle": _merkle(),
}
