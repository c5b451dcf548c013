"""SQL counterparts of the queries that SQL can express over whole tables."""

from __future__ import annotations

_USABLE = """
    v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings),
    g AS (SELECT * FROM v WHERE e IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0)"""

# The audit compares with brute force, as this does, so it finds no link missing.
EMBEDDING_NEARDUP = f"""
    WITH RECURSIVE {_USABLE},
    n AS (SELECT vec_id, label, e, sqrt(list_inner_product(e, e)) AS norm FROM g WHERE label IS NOT NULL AND list_inner_product(e, e) > 0),
    p AS (SELECT a.vec_id AS a, b.vec_id AS b FROM n a JOIN n b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
          WHERE list_inner_product(a.e, b.e) / (a.norm * b.norm) >= 0.93),
    r(a, b) AS (SELECT vec_id, vec_id FROM v UNION SELECT r.a, p.b FROM r JOIN p ON p.a = r.b),
    c AS (SELECT a AS vec_id, min(b) AS component_id FROM r GROUP BY a),
    l AS (SELECT a AS vec_id, count(*) AS n_links FROM p GROUP BY a)
    SELECT vec_id, coalesce(n_links, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept, 1.0::DOUBLE AS recall
    FROM c LEFT JOIN l USING (vec_id)"""


def _assigned(name: str, books: str) -> str:
    apart = " + ".join(f"(p.c[{k}] - b.c[{k}]) * (p.c[{k}] - b.c[{k}])" for k in range(1, 5))
    return f"""
    {name} AS (SELECT vec_id, label, part, any_value(c) AS c, arg_min(entry, d * 64 + entry) AS entry, min(d) AS d
        FROM (SELECT p.vec_id, p.label, p.part, p.c, b.entry, {apart} AS d FROM parts p JOIN {books} b ON b.part = p.part) GROUP BY vec_id, label, part)"""


def _improved(name: str, books: str, assigned: str) -> str:
    means = ", ".join(f"floor(sum(c[{k}])::DOUBLE / count(*))::BIGINT" for k in range(1, 5))
    return f"""
    {name} AS (SELECT b.part, b.entry, coalesce(m.c, b.c) AS c FROM {books} b
        LEFT JOIN (SELECT part, entry, [{means}] AS c FROM {assigned} GROUP BY part, entry) m ON m.part = b.part AND m.entry = b.entry)"""


# For vectors of 64 components, as the table's are: parts of four.
VECTOR_CODES = f"""
    WITH {_USABLE},
    w AS (SELECT vec_id, label, list_transform(e, lambda x: floor(256 * x)::BIGINT) AS w FROM g),
    parts AS (SELECT vec_id, label, i AS part, w[i * 4 + 1 : i * 4 + 4] AS c FROM w, range(16) t(i)),
    b0 AS (SELECT part, entry, c FROM (SELECT part, c, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry FROM parts) WHERE entry < 64),
    {_assigned('a0', 'b0')}, {_improved('b1', 'b0', 'a0')}, {_assigned('a1', 'b1')}, {_improved('b2', 'b1', 'a1')}, {_assigned('a2', 'b2')},
    s AS (SELECT vec_id, label, string_agg(printf('%02x', entry::INT), '' ORDER BY part) AS code, sum(d)::BIGINT AS error FROM a2 GROUP BY vec_id, label),
    h AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM b2)
    SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 FROM s, h"""
