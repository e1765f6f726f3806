"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

_LINES = """
    SELECT doc_id, row_number() OVER () AS r, string_split(coalesce(text, ''), chr(10)) AS ls
    FROM {docs}
"""

_SHARED = """
cut AS ({lines}),
line AS (
    SELECT doc_id, r, unnest(ls) AS line, unnest(range(1, len(ls) + 1)) AS i FROM cut
),
keyed AS (
    SELECT *, translate(
        trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
    FROM line
),
shared AS (
    SELECT k FROM keyed WHERE length(k) >= 1 GROUP BY k HAVING count(DISTINCT r) >= 10
),
kept AS (
    SELECT r, any_value(doc_id) AS doc_id, count(*) AS n_lines, count(s.k) AS n_dropped,
        coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE s.k IS NULL), '') AS text
    FROM keyed LEFT JOIN shared s ON keyed.k = s.k
    GROUP BY r
)"""


def shared_lines(docs: str) -> str:
    """CTEs up to ``kept``: r, doc_id, n_lines, n_dropped and text of each row."""
    return _SHARED.format(lines=_LINES.format(docs=docs))


_COMPONENTS = """
reach AS (
    SELECT id, id AS r FROM node
    UNION
    SELECT reach.id, link.v FROM reach JOIN link ON reach.r = link.u
),
component AS (SELECT id, min(r) AS component_id FROM reach GROUP BY id)"""

_NGRAMS = f"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w
    FROM documents
),
gram AS (
    SELECT DISTINCT doc_id, array_to_string(w[i : i + 2], ' ') AS g
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 2))) AS i FROM words WHERE len(w) > 0)
),
size AS (SELECT doc_id, count(*) AS n FROM gram GROUP BY doc_id),
common AS (
    SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c
    FROM gram a JOIN gram b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id
),
link AS (
    SELECT u, v FROM common JOIN size s ON u = s.doc_id JOIN size t ON v = t.doc_id
    WHERE 100 * c >= 90 * (s.n + t.n - c)
),
node AS (SELECT DISTINCT doc_id AS id FROM documents),
{_COMPONENTS}
SELECT d.doc_id, coalesce(size.n, 0) AS n_shingles, component_id
FROM documents d JOIN component ON d.doc_id = id LEFT JOIN size ON d.doc_id = size.doc_id"""

_VECTORS = f"""
WITH RECURSIVE vector AS (
    SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
    WHERE label IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
        AND len([x FOR x IN embedding IF x <> 0]) > 0
),
link AS (
    SELECT a.vec_id AS u, b.vec_id AS v FROM vector a JOIN vector b
    ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
    AND list_cosine_similarity(a.e, b.e) >= 0.98
),
degree AS (SELECT u, count(*) AS n FROM link GROUP BY u),
node AS (SELECT vec_id AS id FROM embeddings),
{_COMPONENTS}
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN component ON vec_id = id LEFT JOIN degree ON vec_id = u"""

_QUOTES = r"""
WITH RECURSIVE message AS (
    SELECT row_number() OVER () AS r, conv_id, turn, role,
        md5(concat_ws(chr(31), coalesce('v' || conv_id, 'n'), coalesce('v' || turn, 'n'),
                      coalesce('v' || role, 'n'), coalesce('v' || text, 'n'))) AS mid,
        regexp_split_to_array(coalesce(text, ''), '\r?\n') AS ls
    FROM conversations
),
cut AS (
    SELECT r, conv_id, turn, mid, unnest(ls) AS l, unnest(range(1, len(ls) + 1)) AS i FROM message
),
marked AS (SELECT *, regexp_extract(l, '^(?:[ \t]*>)+') AS marks FROM cut),
line AS (
    SELECT r, conv_id, turn, mid, i, length(regexp_replace(marks, '[^>]', '', 'g')) AS level,
        substr(l, length(marks) + 1) AS body,
        lower(trim(regexp_replace(substr(l, length(marks) + 1), '[\s\x00-\x03]+', ' ', 'g'))) AS norm
    FROM marked
),
own AS (
    SELECT r, trim(coalesce(string_agg(body, chr(10) ORDER BY i) FILTER (
            WHERE level = 0 AND NOT (regexp_matches(norm, '(wrote|writes|said):$') AND following > level)
        ), ''), ' ' || chr(9) || chr(10) || chr(13)) AS text
    FROM (SELECT *, coalesce(lead(level) OVER (PARTITION BY r ORDER BY i), 0) AS following FROM line)
    GROUP BY r
),
started AS (
    SELECT *, coalesce(lag(norm) OVER w = '' OR lag(level) OVER w <> level, true)::INTEGER AS s
    FROM line WINDOW w AS (PARTITION BY r ORDER BY i)
),
passage AS (
    SELECT r, conv_id, turn, mid, p, any_value(level) AS level, string_agg(norm, ' ' ORDER BY i) AS t
    FROM (SELECT *, sum(s) OVER (PARTITION BY r ORDER BY i) AS p FROM started)
    WHERE norm <> '' GROUP BY r, conv_id, turn, mid, p
),
sentence AS (
    SELECT r, conv_id, turn, mid, level,
        unnest(string_split(regexp_replace(t, '([.!?]) ', '\1' || chr(2), 'g'), chr(2))) AS norm
    FROM passage
),
amount AS (SELECT r, count(*) AS n_quoted FROM sentence WHERE level > 0 AND norm <> '' GROUP BY r),
known AS (
    SELECT conv_id, turn, mid, level, norm FROM sentence
    WHERE norm <> '' AND conv_id IS NOT NULL AND turn IS NOT NULL
),
wrote AS (
    SELECT conv_id, turn, norm FROM known WHERE level = 0
    UNION SELECT conv_id, turn, norm FROM line
    WHERE level = 0 AND norm <> '' AND conv_id IS NOT NULL AND turn IS NOT NULL
),
quoted AS (
    SELECT conv_id, turn, mid, level, norm, count(*) AS n FROM known WHERE level > 0 GROUP BY ALL
),
found AS (
    SELECT q.conv_id, q.turn, q.mid, q.level, q.norm, q.n, max(w.turn) AS origin
    FROM quoted q JOIN wrote w ON w.conv_id = q.conv_id AND w.norm = q.norm AND w.turn < q.turn
    GROUP BY ALL
),
votes AS (SELECT conv_id, turn, mid, origin, level, sum(n) AS n FROM found GROUP BY ALL),
link AS (
    SELECT conv_id, turn, mid, sum(n) AS n_linked,
        list(origin ORDER BY level, n DESC, origin DESC)[1] AS reply_to
    FROM votes GROUP BY ALL
),
up AS (SELECT conv_id, turn, max(reply_to) AS origin FROM link GROUP BY ALL),
chain AS (
    SELECT conv_id, turn, origin AS thread, 1 AS depth FROM up
    UNION ALL
    SELECT chain.conv_id, chain.turn, up.origin, chain.depth + 1
    FROM chain JOIN up ON up.conv_id = chain.conv_id AND up.turn = chain.thread
),
root AS (SELECT conv_id, turn, arg_max(thread, depth) AS thread, max(depth) AS depth FROM chain GROUP BY ALL)
SELECT m.conv_id, m.turn, m.role, own.text, reply_to, coalesce(thread, m.turn) AS thread,
    CAST(coalesce(depth, 0) AS INTEGER) AS depth, CAST(coalesce(n_quoted, 0) AS INTEGER) AS n_quoted,
    CAST(coalesce(n_linked, 0) AS BIGINT) AS n_linked,
    '<|' || coalesce(m.role, 'unknown') || '|>' || chr(10) || own.text || chr(10) AS formatted,
    row_number() OVER (
        PARTITION BY m.conv_id ORDER BY coalesce(thread, m.turn) NULLS LAST, coalesce(depth, 0),
        m.turn NULLS LAST, m.role NULLS FIRST, m.mid
    ) - 1 AS position
FROM message m JOIN own USING (r) LEFT JOIN amount USING (r) LEFT JOIN link ON link.mid = m.mid
LEFT JOIN root ON root.conv_id = m.conv_id AND root.turn = m.turn"""

_TRIE = r"""
WITH message AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, turn FROM conversations
    WHERE conv_id IS NOT NULL
),
said AS (
    SELECT conv_id, md5(length(role) || ':' || role || text) AS s,
        len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS w,
        row_number() OVER (
            PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(length(role) || ':' || role || text)
        ) AS i
    FROM message
),
own AS (
    -- CRC-32 of the decimal id, byte by byte and bit by bit
    SELECT conv_id, conv_id - conv_id % 20 AS base, max(i) AS n, xor(4294967295, list_reduce(
        list_prepend(4294967295::BIGINT, [ascii(x)::BIGINT FOR x IN string_split(conv_id::VARCHAR, '')]),
        lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[],
                                 lambda y, z: xor(y >> 1, 3988292384 * (y & 1))))) % 4 AS h
    FROM said GROUP BY conv_id
),
base AS (
    SELECT own.conv_id, i AS d, s, w FROM own JOIN said ON said.conv_id = own.base WHERE i <= h
),
rebuilt AS (
    SELECT * FROM base
    UNION ALL
    SELECT own.conv_id, i - h + (SELECT count(*) FROM base WHERE base.conv_id = own.conv_id), s, w
    FROM own JOIN said ON said.conv_id = own.conv_id WHERE i > h
),
prefix AS (
    SELECT conv_id, d, w, string_agg(s, '') OVER (PARTITION BY conv_id ORDER BY d) AS k FROM rebuilt
    UNION ALL SELECT conv_id, 0, 0, '' FROM own
),
ended AS (SELECT conv_id, max(d) AS d, max(k) AS k FROM prefix GROUP BY conv_id),
node AS (
    SELECT k, any_value(d) AS d, any_value(w) AS w, min(conv_id) AS conv_id, count(*) AS n,
        substr(k, 1, length(k) - 32) AS up
    FROM prefix GROUP BY k
),
child AS (SELECT up AS k, count(*) AS n FROM node WHERE d > 0 GROUP BY up),
below AS (
    SELECT u.k, sum((v.n - 1) * v.w) AS saved, count(*) FILTER (WHERE child.k IS NULL) AS leaves
    FROM node u JOIN node v ON starts_with(v.k, u.k) LEFT JOIN child ON child.k = v.k GROUP BY u.k
),
closing AS (SELECT k, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ids FROM ended GROUP BY k)
SELECT node.conv_id, node.d AS depth, CASE WHEN node.d > 0 THEN parent.conv_id END AS parent_conv_id,
    node.n AS n_convs, coalesce(child.n, 0) AS n_children, leaves AS n_leaves, saved::BIGINT AS saved_tokens,
    sha256(coalesce(ids, '')) AS ends_sha256
FROM node JOIN node parent ON parent.k = node.up JOIN below ON below.k = node.k
LEFT JOIN child ON child.k = node.k LEFT JOIN closing ON closing.k = node.k"""

_TOP = """
WITH vector AS (
    SELECT row_number() OVER () AS r, vec_id, [floor(1024 * x::DOUBLE)::BIGINT FOR x IN embedding] AS e
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
        AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
),
part AS (SELECT r, vec_id, len(e) AS n, unnest(e) AS x, unnest(range(len(e))) AS i FROM vector),
scored AS (
    SELECT a.r, a.vec_id AS query_id, b.vec_id, b.r AS c, sum(a.x * b.x)::BIGINT AS score
    FROM part a JOIN part b ON a.i = b.i AND a.n = b.n AND a.r <> b.r
    WHERE a.vec_id % 100 = 0 GROUP BY ALL
),
ranked AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id, c)::INTEGER AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10"""

_DIVERGENCE = r"""
WITH document AS (
    SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
        regexp_extract_all(translate(coalesce(text, ''),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ts
    FROM documents
),
word AS (SELECT r, lang, source, unnest(ts) AS term FROM document),
kept AS (SELECT lang, term, count(*) AS n FROM word GROUP BY ALL HAVING count(DISTINCT r) >= 10),
cell AS (SELECT lang, source, term, count(*) AS n FROM word SEMI JOIN kept USING (lang, term) GROUP BY ALL),
size AS (SELECT lang, sum(n) AS n, count(*) AS v FROM kept GROUP BY lang),
grp AS (SELECT DISTINCT lang, source FROM document),
total AS (SELECT lang, source, sum(n) AS n FROM cell GROUP BY ALL),
dense AS (
    SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
        1 + 1000000000::HUGEINT * (coalesce(c.n, 0) + 2) // (coalesce(t.n, 0) + 2 * s.v) AS p,
        1 + 1000000000::HUGEINT * (k.n + 2) // (s.n + 2 * s.v) AS q
    FROM grp g JOIN kept k USING (lang) JOIN size s USING (lang)
    LEFT JOIN total t ON t.lang = g.lang AND t.source = g.source
    LEFT JOIN cell c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
),
priced AS (
    SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
    FROM dense a JOIN dense b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
),
found AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(p.value, 0)::BIGINT AS value
    FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN priced p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
    UNION ALL
    SELECT lang, source, 'term', term, ((p - q) * (p - q) // (p + q))::BIGINT FROM dense WHERE n > 0 AND p > q
),
ranked AS (
    SELECT *, row_number() OVER (
        PARTITION BY lang, source, part ORDER BY value DESC, encode(item)
    )::INTEGER AS rank FROM found
)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 10"""

ORACLE_SQL: dict[str, str] = {
    "op9_quote_linking": _QUOTES,
    "op11_prefix_trie": _TRIE,
    "op12_topk": _TOP,
    "op13_divergence": _DIVERGENCE,
    "op4_ngram_join": _NGRAMS,
    "op7_near_vectors": _VECTORS,
    "op5_line_dedup": f"WITH {shared_lines('documents')} "
    "SELECT doc_id, n_lines, n_dropped, sha256(text) AS kept_sha256 FROM kept",
}
