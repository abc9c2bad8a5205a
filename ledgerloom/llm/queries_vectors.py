"""Query of the vector operator."""

from __future__ import annotations

from ledgerloom.llm.columns import table
from ledgerloom.llm.registry import query
from ledgerloom.llm.vectors import link_vectors


@query(
    "op11_embedding_links",
    """WITH RECURSIVE v AS MATERIALIZED (SELECT row_number() OVER () AS n, vec_id, label, embedding::double[] AS e FROM embeddings),
    good AS (SELECT * FROM v WHERE label IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND list_max(list_transform(e, lambda x: abs(x))) > 0),
    p AS MATERIALIZED (SELECT a.n AS x, b.n AS y FROM good a JOIN good b ON a.label = b.label AND len(a.e) = len(b.e) AND a.n <> b.n
      WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
    reach AS (SELECT n, n AS m FROM v UNION SELECT reach.n, p.y FROM reach JOIN p ON reach.m = p.x),
    c AS (SELECT r.n, min(v.vec_id) AS component_id FROM reach r JOIN v ON r.m = v.n GROUP BY r.n),
    k AS (SELECT x AS n, count(*) AS n_links FROM p GROUP BY x)
    SELECT vec_id, coalesce(n_links, 0)::bigint AS n_links, component_id, coalesce(vec_id = component_id, component_id IS NULL) AS kept
    FROM v JOIN c USING (n) LEFT JOIN k USING (n)""",
)
def _(spark, sf_dir):
    return link_vectors(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))
