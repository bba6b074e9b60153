"""DuckDB SQL that the operators' results must equal, where SQL can express them."""

from __future__ import annotations

#: CRC-32 of a decimal number, by the bitwise definition. The reflected polynomial and the start.
_CRC32 = """xor(4294967295, list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(string_split({x}, ''), lambda ch: ascii(ch)::BIGINT)),
    lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[],
        lambda s, i: CASE WHEN s & 1 = 1 THEN xor(s >> 1, 3988292384) ELSE s >> 1 END)))"""


def crc32(number: str) -> str:
    return _CRC32.format(x=f"CAST({number} AS VARCHAR)")


def _field(value: str) -> str:
    text = f"CAST({value} AS VARCHAR)"
    return f"coalesce(strlen({text}) || ':' || {text}, '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_field(v) for v in ("doc_id", "source", "lang", "n_chars", text)) + ")"


def _tree(name: str, leaves: str) -> str:
    """Common tables of trees of 16: levels, siblings, roots, and each leaf's path, from ``leaves`` (tree, place, n, digest)."""
    within = "OVER (PARTITION BY l, tree, place // 16 ORDER BY place ROWS BETWEEN"
    return f"""
    {name}_levels AS (
        SELECT 0 AS l, tree, place, n, digest FROM {leaves}
        UNION ALL
        SELECT l + 1, tree, place // 16, any_value((n + 15) // 16), sha256(string_agg(digest, '' ORDER BY place))
        FROM {name}_levels WHERE n > 1 GROUP BY l, tree, place // 16),
    {name}_siblings AS (
        SELECT l, tree, place, n,
               coalesce(string_agg(digest, '') {within} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS a,
               coalesce(string_agg(digest, '') {within} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS b
        FROM {name}_levels),
    {name}_roots AS (SELECT tree, digest FROM {name}_levels WHERE n = 1),
    {name}_paths AS (
        SELECT c.tree, c.place, coalesce(list({{'a': s.a, 'b': s.b}} ORDER BY s.l) FILTER (s.l IS NOT NULL), []) AS path
        FROM {leaves} c LEFT JOIN {name}_siblings s
          ON s.tree = c.tree AND s.n > 1 AND s.place = c.place // CAST(pow(16, s.l) AS BIGINT)
        GROUP BY ALL)"""


MERKLE = f"""
WITH RECURSIVE given AS (
        SELECT doc_id, source, {_leaf("text")} AS leaf,
               CASE WHEN {crc32("doc_id")} % 5 = 0
                    THEN {_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS told
        FROM documents),
    placed AS (
        SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) AS tree, leaf AS digest,
               row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
               count(*) OVER (PARTITION BY source) AS n
        FROM given),
    {_tree("source", "placed")},
    trunk AS (SELECT 0 AS tree, tree - 1 AS place, count(*) OVER () AS n, digest FROM source_roots),
    {_tree("trunk", "trunk")},
    proved AS (
        SELECT p.*, r.digest AS subroot, t.digest AS root, list_concat(s.path, u.path) AS path
        FROM placed p JOIN source_roots r USING (tree) JOIN source_paths s ON s.tree = p.tree AND s.place = p.place
        JOIN trunk_paths u ON u.place = p.tree - 1 CROSS JOIN trunk_roots t),
    folded AS (
        SELECT *, list_reduce(
            list_prepend({{'a': '', 'b': '', 'x': coalesce(told, leaf)}},
                         list_transform(path, lambda s: {{'a': s.a, 'b': s.b, 'x': ''}})),
            lambda c, s: {{'a': '', 'b': '', 'x': sha256(s.a || c.x || s.b)}}).x AS folded_root
        FROM proved)
SELECT doc_id, leaf, subroot, root, sha256(list_aggregate(list_prepend('', list_transform(path, lambda s: s.a || s.b)),
       'string_agg', '')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM folded
"""

TRIE = f"""
WITH own AS (
        SELECT conv_id AS c, coalesce(role, '') AS r, coalesce(text, '') AS x,
               row_number() OVER (PARTITION BY conv_id
                                  ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS place
        FROM conversations WHERE conv_id IS NOT NULL),
    convs AS (SELECT c, c - c % 5 AS base, {crc32("c")} % 9 AS h FROM (SELECT DISTINCT c FROM own)),
    turns AS (
        SELECT v.c, 0 AS part, o.place, o.r, o.x FROM convs v JOIN own o ON o.c = v.base AND o.place < v.h
        UNION ALL
        SELECT v.c, 1, o.place, o.r, o.x FROM convs v JOIN own o ON o.c = v.c AND o.place >= v.h),
    built AS (
        SELECT v.c, coalesce(list({{'r': t.r, 'x': t.x}} ORDER BY t.part, t.place) FILTER (t.place IS NOT NULL), []) AS s
        FROM convs v LEFT JOIN turns t USING (c) GROUP BY v.c),
    steps AS (SELECT c, s, unnest(range(0, len(s) + 1)) AS d FROM built),
    nodes AS (
        SELECT s[1:d] AS k, d, min(c) AS conv_id, count(*) AS n_convs,
               sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (len(s) = d), '')) AS ends_sha256
        FROM steps GROUP BY ALL),
    below AS (SELECT k[1:d - 1] AS k, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY ALL),
    told AS (
        SELECT n.*, coalesce(b.n_children, 0) AS n_children,
               CASE WHEN d = 0 THEN 0 ELSE (n_convs - 1) * strlen(n.k[d].x) END AS own
        FROM nodes n LEFT JOIN below b ON b.k = n.k),
    upward AS (SELECT k, d, unnest(range(0, d + 1)) AS j, n_children, own FROM told),
    sums AS (
        SELECT k[1:j] AS k, CAST(count(*) FILTER (n_children = 0) AS BIGINT) AS n_leaves, CAST(sum(own) AS BIGINT) AS saved_tokens
        FROM upward GROUP BY ALL)
SELECT n.conv_id, n.d AS depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, s.n_leaves, s.saved_tokens, n.ends_sha256
FROM told n JOIN sums s ON s.k = n.k LEFT JOIN nodes p ON n.d > 0 AND p.k = n.k[1:n.d - 1]
"""

NEAR_COPIES = r"""
WITH RECURSIVE worded AS (
        SELECT row_number() OVER () AS id, doc_id, regexp_extract_all(
                   translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
        FROM documents),
    sets AS (
        SELECT id, doc_id, CASE WHEN coalesce(len(w), 0) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
               ELSE list_sort(list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')))) END AS s
        FROM worded),
    distinct_sets AS (SELECT row_number() OVER () AS k, s, len(s) AS n, min(doc_id) AS least FROM sets WHERE len(s) > 0 GROUP BY s),
    parts AS (SELECT k, n, unnest(s) AS h FROM distinct_sets),
    links AS (
        SELECT a.k AS a, b.k AS b FROM parts a JOIN parts b ON a.h = b.h AND a.k <> b.k
        GROUP BY a.k, b.k, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
    reach AS (
        SELECT a, b FROM links
        UNION
        SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
    classes AS (
        SELECT d.s, least(d.least, min(o.least)) AS component_id
        FROM distinct_sets d LEFT JOIN reach r ON r.a = d.k LEFT JOIN distinct_sets o ON o.k = r.b GROUP BY d.s, d.least)
SELECT s.doc_id, len(s.s) AS n_shingles, coalesce(c.component_id, s.doc_id) AS component_id,
       s.doc_id = coalesce(c.component_id, s.doc_id) AS kept
FROM sets s LEFT JOIN classes c ON c.s = s.s
"""
