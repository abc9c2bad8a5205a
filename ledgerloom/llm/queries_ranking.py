"""Query of the ranked search."""

from __future__ import annotations

from ledgerloom.llm.columns import table
from ledgerloom.llm.ranking import rank
from ledgerloom.llm.registry import query


@query(
    "op12_ranked_search",
    r"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents),
    s AS (SELECT count(*) FILTER (len(ts) > 0) AS nn, sum(len(ts))::bigint AS l FROM d),
    tf AS (SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(ts) AS t FROM d) GROUP BY r, t),
    q AS (SELECT DISTINCT item_id, text, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark),
    w AS (SELECT t, floor(1000 * ln((2 * any_value(nn) + 2)::double / (2 * count(*) + 1)))::bigint AS w FROM tf, s WHERE t IN (SELECT t FROM q) GROUP BY t),
    i AS (SELECT r, doc_id, t, (1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * len(ts) * nn) // l)) AS x FROM tf JOIN d USING (r), s WHERE t IN (SELECT t FROM q)),
    f AS (SELECT item_id, text, doc_id, r, sum(w * x)::bigint AS score FROM q JOIN w USING (t) JOIN i USING (t) GROUP BY ALL HAVING score > 0),
    k AS (SELECT *, row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM f)
    SELECT item_id, rank::int AS rank, doc_id, score FROM k WHERE rank <= 50""",
)
def _(spark, sf_dir):
    return rank(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
