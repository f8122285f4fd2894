"""DuckDB SQL of the queries that SQL can express on whole tables."""

from __future__ import annotations

RANKED_SEARCH = r"""
WITH doc AS (
    SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS found FROM documents
), sized AS (SELECT row, doc_id, found, len(found) AS n FROM doc WHERE len(found) > 0),
totals AS (SELECT count(*) AS docs, sum(n)::BIGINT AS len FROM sized),
tf AS (
    SELECT row, term, count(*) AS tf
    FROM (SELECT row, translate(unnest(found), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM sized)
    GROUP BY row, term
), weight AS (
    SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM tf, totals GROUP BY term, docs
), item AS (
    SELECT item_id, translate(unnest(regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term
    FROM benchmark
), asked AS (SELECT item_id, term, count(*) AS times FROM item GROUP BY item_id, term),
scored AS (
    SELECT item_id, row, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * docs) // len))))::BIGINT AS score
    FROM asked JOIN weight USING (term) JOIN tf USING (term) JOIN sized USING (row), totals
    GROUP BY item_id, row
), ranked AS (
    SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank, doc_id, score
    FROM scored JOIN sized USING (row) WHERE score > 0
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 20
"""

# the ancestors of a node are the nodes on the path of its smallest member, so no recursion is needed; CRC-32 bit by bit
PREFIX_TRIE = r"""
WITH numbered AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place
    FROM conversations WHERE conv_id IS NOT NULL
), own AS (SELECT conv_id, count(*) AS n_own FROM numbered GROUP BY conv_id),
hashed AS (
    SELECT conv_id, conv_id - conv_id % 20 AS base, n_own,
        xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
            lambda state, c: list_reduce(list_prepend(xor(state, c), range(8)),
                lambda v, k: CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384::BIGINT) ELSE v // 2 END)), 4294967295::BIGINT) % 4 AS h
    FROM own
), plan AS (SELECT hashed.conv_id, base, h, least(h, coalesce(b.n_own, 0)) AS n_head FROM hashed LEFT JOIN own b ON b.conv_id = base),
turns AS (
    SELECT plan.conv_id, place AS depth, role, text FROM plan JOIN numbered ON numbered.conv_id = base WHERE place <= h
    UNION ALL SELECT plan.conv_id, place - h + n_head, role, text FROM plan JOIN numbered USING (conv_id) WHERE place > h
), paths AS (
    SELECT conv_id, depth, text, list(sha256(sha256(role) || text)) OVER (PARTITION BY conv_id ORDER BY depth) AS path FROM turns
    UNION ALL SELECT conv_id, 0, '', [] FROM own
), labelled AS (
    SELECT conv_id, depth, text, path, min(conv_id) OVER (PARTITION BY path) AS label, max(depth) OVER (PARTITION BY conv_id) AS n_turns FROM paths
), nodes AS (
    SELECT label, depth, count(*) AS n_convs, max(len(regexp_extract_all(text, '[^ 	-
]+'))) AS tokens,
        sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (depth = n_turns), '')) AS ends_sha256
    FROM labelled GROUP BY label, depth
), named AS (
    SELECT nodes.*, up.label AS parent FROM nodes LEFT JOIN labelled up ON up.conv_id = nodes.label AND up.depth = nodes.depth - 1
), children AS (SELECT parent AS label, depth - 1 AS depth, count(*) AS n FROM named WHERE depth > 0 GROUP BY parent, depth),
family AS (SELECT named.*, coalesce(children.n, 0) AS n_children FROM named LEFT JOIN children USING (label, depth)),
subtree AS (
    SELECT up.label, up.depth, sum((n_children = 0)::BIGINT) AS n_leaves, sum((n_convs - 1) * tokens) AS saved_tokens
    FROM family JOIN labelled up ON up.conv_id = family.label AND up.depth <= family.depth GROUP BY up.label, up.depth
)
SELECT label AS conv_id, depth::BIGINT AS depth, parent AS parent_conv_id, n_convs, n_children, n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens, ends_sha256
FROM family JOIN subtree USING (label, depth)
"""


def oracle_sql() -> dict[str, str]:
    return {"op11_prefix_trie": PREFIX_TRIE, "op13_ranked_search": RANKED_SEARCH}
