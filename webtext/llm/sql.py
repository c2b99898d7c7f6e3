"""SQL of the queries that SQL can express, for an engine with ``regexp_extract_all``."""

_HASHES = ", ".join(
    f"('0x' || substr(sha256('1:' || doc_id::VARCHAR), {8 * g + 1}, 8))::BIGINT AS h{g + 1}" for g in range(4)
)

OP13 = f"""
WITH hashed AS (
    SELECT doc_id, coalesce(text, '') AS text, {_HASHES},
           regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS units
    FROM documents
), cuts AS (
    SELECT *, len(units)::BIGINT AS n,
           least(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS first,
           greatest(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS second,
           CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90
                THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
    FROM hashed
), parts AS (
    SELECT *, array_to_string(units[1:first], '') AS p, array_to_string(units[first + 1:second], '') AS m,
           array_to_string(units[second + 1:], '') AS s
    FROM cuts
)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN length(p)::BIGINT END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m)::BIGINT END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
              ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
"""

# crc32 of a decimal number: eight shifts a byte, by a fold over its characters.
_STEP = "CASE WHEN {0} & 1 = 1 THEN xor({0} >> 1, 3988292384) ELSE {0} >> 1 END"


def _crc32(text: str) -> str:
    inner = "list_reduce(list_prepend(xor(a, x), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda acc, i: " + _STEP.format("acc") + ")"
    codes = f"list_transform(string_split({text}, ''), lambda c: ascii(c)::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), lambda a, x: {inner}), 4294967295)"


OP12 = f"""
WITH turns AS (
    SELECT conv_id, sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS digest,
           len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS words,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''),
               sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) - 1 AS pos
    FROM conversations WHERE conv_id IS NOT NULL
), own AS (
    SELECT conv_id, list({{'d': digest, 'w': words}} ORDER BY pos) AS ts FROM turns GROUP BY conv_id
), heads AS (
    SELECT *, {_crc32("conv_id::VARCHAR")} % 4 AS h FROM own
), rebuilt AS (
    SELECT heads.conv_id, list_concat(coalesce(b.ts, [])[1:h], heads.ts[h + 1:]) AS ts
    FROM heads LEFT JOIN own b ON b.conv_id = heads.conv_id - heads.conv_id % 20
), prefixes AS (
    SELECT conv_id, len(ts) AS whole, unnest(range(0, len(ts) + 1)) AS depth, ts FROM rebuilt
), keyed AS (
    SELECT conv_id, whole, depth, sha256(array_to_string(list_transform(ts[1:depth], lambda t: t.d), '')) AS key,
           CASE WHEN depth > 0 THEN sha256(array_to_string(list_transform(ts[1:depth - 1], lambda t: t.d), '')) END AS parent,
           CASE WHEN depth > 0 THEN ts[depth].w ELSE 0 END AS words
    FROM prefixes
), nodes AS (
    SELECT key, any_value(parent) AS parent, any_value(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
           any_value(words) AS words,
           sha256(coalesce(string_agg(CASE WHEN depth = whole THEN conv_id::VARCHAR END, ',' ORDER BY conv_id), '')) AS ends_sha256
    FROM keyed GROUP BY key
), children AS (
    SELECT parent AS key, count(*) AS n_children FROM nodes WHERE parent IS NOT NULL GROUP BY parent
), below AS (
    SELECT k.key, sum(CASE WHEN c.n_children IS NULL THEN 1 ELSE 0 END)::BIGINT AS n_leaves,
           sum((n.n_convs - 1) * n.words)::BIGINT AS saved_tokens
    FROM nodes n JOIN keyed k ON k.conv_id = n.conv_id AND k.depth <= n.depth LEFT JOIN children c ON c.key = n.key
    GROUP BY k.key
)
SELECT n.conv_id, n.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs::BIGINT AS n_convs,
       coalesce(c.n_children, 0)::BIGINT AS n_children, b.n_leaves, b.saved_tokens, n.ends_sha256
FROM nodes n JOIN below b USING (key) LEFT JOIN children c USING (key) LEFT JOIN nodes p ON p.key = n.parent
"""

OP11 = """
WITH RECURSIVE v AS (
    SELECT vec_id, label, embedding::DOUBLE[] AS x FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0
      AND len(list_filter(embedding, lambda e: e <> 0)) > 0
), links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND len(a.x) = len(b.x) AND a.vec_id <> b.vec_id
    WHERE list_cosine_similarity(a.x, b.x) >= 0.98
), reach(vec_id, other) AS (
    SELECT vec_id, vec_id FROM embeddings
    UNION
    SELECT r.vec_id, l.b FROM reach r JOIN links l ON l.a = r.other
)
SELECT e.vec_id, coalesce(n.n, 0)::BIGINT AS n_links, c.component_id, e.vec_id = c.component_id AS kept
FROM embeddings e
JOIN (SELECT vec_id, min(other) AS component_id FROM reach GROUP BY vec_id) c USING (vec_id)
LEFT JOIN (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a) n USING (vec_id)
"""


_ASCII_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP7 = f"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all({_ASCII_LOWER}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), sets AS (
    SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
           ELSE list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' ')) END) AS s
    FROM words
), items AS (
    SELECT doc_id, len(s) AS n, unnest(s) AS sh FROM sets
), links AS (
    SELECT a.doc_id AS a, b.doc_id AS b FROM items a JOIN items b ON a.sh = b.sh AND a.doc_id <> b.doc_id
    GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))
), reach(doc_id, other) AS (
    SELECT doc_id, doc_id FROM documents
    UNION
    SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other
)
SELECT doc_id, len(s)::BIGINT AS n_shingles, c.component_id, coalesce(n.n, 0)::BIGINT AS n_links
FROM sets JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) c USING (doc_id)
LEFT JOIN (SELECT a AS doc_id, count(*) AS n FROM links GROUP BY a) n USING (doc_id)
"""
