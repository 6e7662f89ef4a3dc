"""DuckDB statement of the Merkle manifest: runs by grouping, proofs by joining all levels, folding by recursion."""

from __future__ import annotations

from dockplan.llm.merkle import ARITY, FIELDS, TAMPER


def crc32_sql(text: str) -> str:
    """Unsigned CRC-32 (reflected polynomial 3988292384) of the UTF-8 text: each byte is taken in, then eight bits shifted out."""
    byte = f"('0x' || substr(hex(encode({text})), 2 * i::BIGINT + 1, 2))::BIGINT"
    bits = f"flatten(list_transform(range(length(hex(encode({text}))) // 2), lambda i: [{byte}, 0, 0, 0, 0, 0, 0, 0]))"
    step = "xor(xor(a, b) >> 1, 3988292384 * (xor(a, b) & 1))"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {bits}), lambda a, b: {step}), 4294967295)"


def _hash(text: str) -> str:
    parts = [text if c == "text" else c for c in FIELDS]
    each = [f"COALESCE(strlen({p}::VARCHAR) || ':' || {p}::VARCHAR, '-')" for p in parts]
    return f"sha256({' || '.join(each)})"


def _levels(name: str, start: str) -> str:
    """Nodes of all levels (tree, level, idx, n, digest) above the nodes of ``start`` (tree, idx, n, digest)."""
    return f"""{name} AS (
    SELECT tree, 0 AS level, idx, n, digest FROM {start}
    UNION ALL
    SELECT tree, level + 1, idx // {ARITY}, (n + {ARITY - 1}) // {ARITY}, sha256(string_agg(digest, '' ORDER BY idx))
    FROM {name} WHERE n > 1 GROUP BY tree, level, idx // {ARITY}, n)"""


MERKLE = f"""
WITH RECURSIVE
recs AS (SELECT row_number() OVER () AS rid, doc_id, source, {_hash('text')} AS leaf,
    {_hash("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS changed,
    {crc32_sql("COALESCE(doc_id::VARCHAR, '')")} % {TAMPER} = 0 AS tampered FROM documents),
placed AS (SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree,
    row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx,
    count(*) OVER (PARTITION BY source) AS n FROM recs),
leaves AS (SELECT tree, idx, n, leaf AS digest FROM placed),
{_levels('nodes', 'leaves')},
subroots AS (SELECT tree, level AS height, digest FROM nodes WHERE n = 1),
forest AS (SELECT 0 AS tree, tree AS idx, count(*) OVER () AS n, digest FROM subroots),
{_levels('crown', 'forest')},
-- Every digest beside the way up from a leaf, numbered by level through both trees.
ways AS (
    SELECT p.rid, s.level, s.idx < p.idx // ({ARITY}**s.level)::BIGINT AS first, s.idx AS place, s.digest
    FROM placed p JOIN nodes s ON s.tree = p.tree AND s.n > 1
        AND s.idx // {ARITY} = (p.idx // ({ARITY}**s.level)::BIGINT) // {ARITY} AND s.idx <> p.idx // ({ARITY}**s.level)::BIGINT
    UNION ALL
    SELECT p.rid, t.height + s.level, s.idx < p.tree // ({ARITY}**s.level)::BIGINT, s.idx, s.digest
    FROM placed p JOIN subroots t ON t.tree = p.tree JOIN crown s ON s.n > 1
        AND s.idx // {ARITY} = (p.tree // ({ARITY}**s.level)::BIGINT) // {ARITY} AND s.idx <> p.tree // ({ARITY}**s.level)::BIGINT),
proofs AS (SELECT rid, sha256(string_agg(digest, '' ORDER BY level, place)) AS proof FROM ways GROUP BY rid),
sides AS (SELECT rid, level, COALESCE(string_agg(digest, '' ORDER BY place) FILTER (first), '') AS before,
    COALESCE(string_agg(digest, '' ORDER BY place) FILTER (NOT first), '') AS after FROM ways GROUP BY rid, level),
heights AS (SELECT p.rid, t.height + (SELECT max(level) FROM crown) AS height, t.digest AS subroot FROM placed p JOIN subroots t USING (tree)),
folded AS (
    SELECT rid, 0 AS level, CASE WHEN tampered THEN changed ELSE leaf END AS digest FROM recs
    UNION ALL
    SELECT f.rid, f.level + 1, sha256(COALESCE(s.before, '') || f.digest || COALESCE(s.after, ''))
    FROM folded f JOIN heights h ON h.rid = f.rid AND f.level < h.height LEFT JOIN sides s ON s.rid = f.rid AND s.level = f.level)
SELECT r.doc_id, r.leaf, h.subroot, c.digest AS root, COALESCE(p.proof, sha256('')) AS proof_sha256, f.digest AS folded_root,
    f.digest = c.digest AS verified
FROM recs r JOIN heights h USING (rid) JOIN folded f ON f.rid = r.rid AND f.level = h.height
JOIN (SELECT digest FROM crown WHERE n = 1) c ON true LEFT JOIN proofs p ON p.rid = r.rid
"""
