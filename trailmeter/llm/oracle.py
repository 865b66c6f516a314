"""The expected results of the queries that SQL can state (DuckDB)."""

#: A list of 256 remainders, by the rule of CRC-32 (reflected polynomial 3988292384).
_CRC = """crc AS (
    SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)),
        lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)) AS steps
)"""

TRIE = f"""
WITH {_CRC},
own AS (
    SELECT conv_id AS c, coalesce(role, '') AS r, coalesce(text, '') AS x, row_number() OVER (
        PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS k
    FROM conversations WHERE conv_id IS NOT NULL
),
convs AS (
    SELECT c, c - c % 100 AS base, xor(list_reduce(
        list_prepend(4294967295::BIGINT, list_transform(string_split(c::VARCHAR, ''), lambda s: ascii(s)::BIGINT)),
        lambda a, b: xor(a >> 8, steps[(xor(a, b) & 255) + 1])), 4294967295) % 6 AS h
    FROM (SELECT DISTINCT c FROM own), crc
),
parts AS (
    SELECT v.c, 0 AS side, o.k, o.r, o.x FROM convs v JOIN own o ON o.c = v.base AND o.k < v.h
    UNION ALL
    SELECT v.c, 1, o.k, o.r, o.x FROM convs v JOIN own o ON o.c = v.c AND o.k >= v.h
),
lists AS (
    SELECT v.c, coalesce(l.turns, []) AS turns FROM convs v LEFT JOIN (
        SELECT c, list({{'r': r, 'x': x}} ORDER BY side, k) AS turns FROM parts GROUP BY c) l ON l.c = v.c
),
prefixes AS (SELECT c, turns, unnest(range(0, len(turns) + 1)) AS d FROM lists),
nodes AS (
    SELECT d, turns[1:d] AS key, min(c) AS first, count(*) AS n,
        string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE len(turns) = d) AS ends,
        CASE WHEN d = 0 THEN 0 ELSE (count(*) - 1) * length(any_value(turns[d].x)) END AS saved
    FROM prefixes GROUP BY d, turns[1:d]
),
children AS (SELECT key[1:d - 1] AS key, d - 1 AS d, count(*) AS n FROM nodes WHERE d > 0 GROUP BY 1, 2),
shaped AS (
    SELECT n.*, coalesce(c.n, 0) AS n_children FROM nodes n LEFT JOIN children c ON c.d = n.d AND c.key = n.key
),
above AS (SELECT key, unnest(range(0, d + 1)) AS d, saved, n_children FROM shaped),
below AS (
    SELECT d, key[1:d] AS key, sum(saved) AS saved, count(*) FILTER (WHERE n_children = 0) AS leaves
    FROM above GROUP BY 1, 2
)
SELECT s.first AS conv_id, s.d AS depth, p.first AS parent_conv_id, s.n AS n_convs, s.n_children,
    b.leaves AS n_leaves, b.saved::BIGINT AS saved_tokens, sha256(coalesce(s.ends, '')) AS ends_sha256
FROM shaped s JOIN below b ON b.d = s.d AND b.key = s.key
LEFT JOIN nodes p ON p.d = s.d - 1 AND p.key = s.key[1:s.d - 1]
"""



def jaccard(width: int) -> str:
    """doc_id, n_shingles and component_id of documents linked at 0.8 by shingles of width words."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    return f"""
WITH RECURSIVE worded AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), '{letters.upper()}', '{letters}'), '[^\\x20\\x09-\\x0D]+') AS w
    FROM documents
),
sets AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {width} THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(range(1, len(w) - {width - 2}),
            lambda i: array_to_string(w[i:i + {width - 1}], ' '))) END AS s
    FROM worded
),
tokens AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
links AS (
    SELECT a.doc_id AS a, b.doc_id AS b FROM tokens a JOIN tokens b ON b.x = a.x AND a.doc_id <> b.doc_id
    GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
),
reached(doc_id, other) AS (
    SELECT doc_id, doc_id FROM sets UNION SELECT r.doc_id, l.b FROM reached r JOIN links l ON l.a = r.other
)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, r.component_id
FROM sets s JOIN (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id) r ON r.doc_id = s.doc_id
"""


ORACLE: dict[str, str] = {
    "op1_near_dedup": f"SELECT *, doc_id = component_id AS kept FROM ({jaccard(4)})",
    "op11_prefix_trie": TRIE,
    "op12_signature_join": jaccard(5),
}
