"""DuckDB SQL for the queries of this subpackage that SQL can express over whole tables."""

LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP5 = f"""
WITH numbered AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
lines AS (
    SELECT r, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS place FROM numbered
),
keyed AS (
    SELECT *, {LOWER.format("trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")} AS key FROM lines
),
frequent AS (SELECT key FROM keyed WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT r) >= 10)
SELECT doc_id, count(*) AS n_lines, count(f.key) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE f.key IS NULL), '')) AS kept_sha256
FROM keyed LEFT JOIN frequent f ON keyed.key = f.key
GROUP BY r, doc_id
"""

OP7 = """
WITH sound AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
    FROM sound q JOIN sound c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0
),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""


def _field(value: str) -> str:
    return f"coalesce(octet_length(encode({value}::VARCHAR)) || ':' || {value}::VARCHAR, '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_field(v) for v in ("doc_id", "source", "lang", "n_chars", text)) + ")"


#: Nodes by (tree, level, number): a tree per source, then the tree of their roots.
OP12 = f"""
WITH RECURSIVE checksums AS (
    -- CRC-32 of the decimal id, a byte at a time by the table's eight shifts.
    SELECT id, 0 AS done, 4294967295::UBIGINT AS crc
    FROM (SELECT DISTINCT doc_id AS id FROM documents WHERE doc_id IS NOT NULL)
    UNION ALL
    SELECT id, done + 1,
        list_reduce([xor(crc, ascii(substr(id::VARCHAR, done + 1, 1))::UBIGINT), 0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[],
            lambda c, _: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END)
    FROM checksums WHERE done < length(id::VARCHAR)
),
even AS (SELECT id FROM checksums WHERE done = length(id::VARCHAR) AND xor(crc, 4294967295::UBIGINT) % 2 = 0),
leaves AS (
    SELECT doc_id, source, {_leaf("text")} AS leaf,
        CASE WHEN doc_id IN (SELECT id FROM even) THEN {_leaf("replace(text, chr(10), '')")} END AS changed
    FROM documents
),
placed AS (
    SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
        dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree
    FROM leaves
),
nodes AS (
    SELECT tree, 0 AS level, place, leaf AS digest, count(*) OVER (PARTITION BY tree) AS width FROM placed
    UNION ALL
    SELECT tree, level + 1, place // 3, sha256(string_agg(digest, '' ORDER BY place)), (max(width) + 2) // 3
    FROM nodes WHERE width > 1 GROUP BY tree, level, place // 3
),
subroots AS (SELECT tree, digest FROM nodes WHERE width = 1),
upper AS (
    SELECT 0 AS level, tree AS place, digest, count(*) OVER () AS width FROM subroots
    UNION ALL
    SELECT level + 1, place // 3, sha256(string_agg(digest, '' ORDER BY place)), (max(width) + 2) // 3
    FROM upper WHERE width > 1 GROUP BY level, place // 3
),
root AS (SELECT digest FROM upper WHERE width = 1),
around AS (
    SELECT false AS top, tree, level, place, width,
        coalesce(string_agg(digest, '') OVER (run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS left_ones,
        coalesce(string_agg(digest, '') OVER (run ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS right_ones
    FROM nodes WINDOW run AS (PARTITION BY tree, level, place // 3 ORDER BY place)
    UNION ALL
    SELECT true, -1, level, place, width,
        coalesce(string_agg(digest, '') OVER (run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), ''),
        coalesce(string_agg(digest, '') OVER (run ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '')
    FROM upper WINDOW run AS (PARTITION BY level, place // 3 ORDER BY place)
),
-- Each row climbs: its digest, the digest folded from the changed leaf, the siblings met so far.
path AS (
    SELECT doc_id, tree, place AS leaf_place, place, 0 AS level, false AS top, coalesce(changed, leaf) AS folded, '' AS siblings FROM placed
    UNION ALL
    SELECT p.doc_id, p.tree, p.leaf_place, CASE WHEN s.width > 1 THEN p.place // 3 ELSE p.tree END,
        CASE WHEN s.width > 1 THEN p.level + 1 ELSE 0 END, p.top OR s.width = 1,
        CASE WHEN s.width > 1 THEN sha256(s.left_ones || p.folded || s.right_ones) ELSE p.folded END,
        CASE WHEN s.width > 1 THEN p.siblings || s.left_ones || s.right_ones ELSE p.siblings END
    FROM path p JOIN around s ON s.top = p.top AND s.level = p.level AND s.place = p.place AND (p.top OR s.tree = p.tree)
    WHERE NOT (p.top AND s.width = 1)
),
ended AS (
    SELECT * FROM path WHERE top AND level = (SELECT max(level) FROM upper)
)
SELECT placed.doc_id, placed.leaf, subroots.digest AS subroot, root.digest AS root,
    sha256(ended.siblings) AS proof_sha256, ended.folded AS folded_root, ended.folded = root.digest AS verified
FROM placed JOIN subroots USING (tree) JOIN ended ON ended.tree = placed.tree AND ended.leaf_place = placed.place, root
"""

OP13 = f"""
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({LOWER.format("coalesce(text, '')")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents
),
items AS (
    SELECT item_id, regexp_extract_all({LOWER.format("coalesce(text, '')")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark
),
spots AS (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM items WHERE len(w) > 0),
windows AS (SELECT DISTINCT item_id, least(len(w), 10) AS size, array_to_string(w[i : i + 9], ' ') AS spelled FROM spots),
sizes AS (SELECT DISTINCT size FROM windows),
places AS (SELECT r, size, unnest(range(1, len(w) - size + 2)) AS i FROM docs, sizes WHERE len(w) >= size),
found AS (
    SELECT r, i, p.size, item_id FROM places p JOIN docs USING (r)
    JOIN windows ON windows.size = p.size AND windows.spelled = array_to_string(w[i : i + p.size - 1], ' ')
),
hits AS (SELECT r, count(DISTINCT k) AS n FROM (SELECT r, unnest(range(i, i + size)) AS k FROM found) GROUP BY r),
named AS (SELECT r, count(*) AS n, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT r, item_id::VARCHAR AS item_id FROM found) WHERE item_id IS NOT NULL GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(hits.n, 0) AS n_hit, coalesce(named.n, 0) AS n_items,
    sha256(coalesce(named.ids, '')) AS items_sha256, coalesce(hits.n, 0) > 0 AS contaminated
FROM docs LEFT JOIN hits USING (r) LEFT JOIN named USING (r)
"""

QUERIES = {
    "op5_line_dedup": OP5,
    "op7_exact_topk": OP7,
    "op12_merkle_manifest": OP12,
    "op13_decontamination": OP13,
}
