"""SQL that gives the rows of a query on the same tables."""

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"[^\x20\x09-\x0D]+"

ORACLES = {
    "op1_ngram_jaccard_join": rf"""
WITH RECURSIVE worded AS (
    SELECT doc_id, coalesce(regexp_extract_all({_LOWER}, '{_WORDS}'), []) AS w FROM documents
), shingle AS (
    SELECT DISTINCT doc_id, unnest(CASE
        WHEN len(w) = 0 THEN []
        WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s
    FROM worded
), sized AS (
    SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id
), pair AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k
    FROM shingle a JOIN shingle b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL
), link AS (
    SELECT a, b FROM pair JOIN sized x ON x.doc_id = a JOIN sized y ON y.doc_id = b
    WHERE 100 * k >= 80 * (x.n + y.n - k)
), both_ways AS (
    SELECT a, b FROM link UNION ALL SELECT b, a FROM link
), reach AS (
    SELECT doc_id AS a, doc_id AS b FROM documents
    UNION SELECT r.a, l.b FROM reach r JOIN both_ways l ON l.a = r.b
)
SELECT d.doc_id, coalesce(max(n), 0) AS n_shingles, min(r.b) AS component_id,
    (SELECT count(*) FROM both_ways l WHERE l.a = d.doc_id) AS n_links
FROM documents d LEFT JOIN sized USING (doc_id) JOIN reach r ON r.a = d.doc_id
GROUP BY d.doc_id
""",
    "op4_line_dedup": rf"""
WITH part AS (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS pos
    FROM documents WHERE text IS NOT NULL
), worded AS (
    SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS i
    FROM (SELECT *, len(regexp_extract_all(line, '{_WORDS}')) AS w FROM part) WHERE w > 0
), summed AS (
    SELECT *, sum(w) OVER (PARTITION BY doc_id ORDER BY i) AS total FROM worded
), enough AS (
    SELECT a.doc_id, a.i AS first, b.i AS last FROM summed a
    JOIN summed b ON a.doc_id = b.doc_id AND b.i >= a.i AND b.total - a.total + a.w >= 50
), cut AS (
    SELECT doc_id, first, min(last) AS last FROM enough GROUP BY ALL
    UNION SELECT doc_id, max(first), last FROM enough GROUP BY ALL
), content AS (
    SELECT c.doc_id, c.first, c.last, string_agg(s.line, chr(10) ORDER BY s.i) AS run
    FROM cut c JOIN summed s ON s.doc_id = c.doc_id AND s.i BETWEEN c.first AND c.last GROUP BY ALL
), later AS (
    SELECT doc_id, first, last FROM content
    QUALIFY row_number() OVER (PARTITION BY run ORDER BY doc_id, first) > 1
), gone AS (
    SELECT DISTINCT s.doc_id, s.pos FROM later l JOIN summed s ON s.doc_id = l.doc_id AND s.i BETWEEN l.first AND l.last
), kept AS (
    SELECT doc_id, string_agg(line, chr(10) ORDER BY pos) AS text FROM part ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id
), counted AS (
    SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id
)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text, coalesce(c.n, 0) AS n_removed_lines
FROM documents d LEFT JOIN kept k USING (doc_id) LEFT JOIN counted c USING (doc_id)
""",
    "op13_conversation_trie": r"""
WITH own AS (
    SELECT conv_id, list({'r': coalesce(role, ''), 't': coalesce(text, '')} ORDER BY turn NULLS FIRST, role, text) AS s
    FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), headed AS (
    -- crc32 of the decimal id, bit by bit
    SELECT conv_id, s, CAST(xor(list_reduce(list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(ord(c) AS BIGINT)),
        lambda acc, b: list_reduce([xor(acc, b), 0, 0, 0, 0, 0, 0, 0, 0],
            lambda x, y: xor(x >> 1, CAST(3988292384 AS BIGINT) * (x & 1))), CAST(4294967295 AS BIGINT)), CAST(4294967295 AS BIGINT)) AS BIGINT) % 6 AS h
    FROM own
), rebuilt AS (
    SELECT c.conv_id, list_concat(coalesce(b.s[1:c.h], []), c.s[c.h + 1:]) AS s
    FROM headed c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 100
), prefix AS (
    SELECT conv_id, s[1:d] AS p, d, d = len(s) AS ends FROM (SELECT conv_id, s, unnest(range(len(s) + 1)) AS d FROM rebuilt)
), node AS (
    SELECT p, any_value(d) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
        coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '') AS ids
    FROM prefix GROUP BY p
), grown AS (
    SELECT n.*, q.conv_id AS parent_conv_id, (SELECT count(*) FROM node c WHERE c.depth = n.depth + 1 AND c.p[1:n.depth] = n.p) AS n_children
    FROM node n LEFT JOIN node q ON n.depth > 0 AND q.depth = n.depth - 1 AND q.p = n.p[1:n.depth - 1]
)
SELECT a.conv_id, a.depth, a.parent_conv_id, a.n_convs, a.n_children,
    count(*) FILTER (u.n_children = 0) AS n_leaves,
    CAST(sum((u.n_convs - 1) * CASE WHEN u.depth = 0 THEN 0 ELSE length(u.p[u.depth].t) END) AS BIGINT) AS saved_tokens,
    sha256(any_value(a.ids)) AS ends_sha256
FROM grown a JOIN grown u ON u.depth >= a.depth AND u.p[1:a.depth] = a.p
GROUP BY a.p, a.conv_id, a.depth, a.parent_conv_id, a.n_convs, a.n_children
""",
}
