"""Queries of the operators built from DataFrame functions only, with their SQL where it can express them."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.llm.columns import table
from ledgerloom.llm.mixing import mix
from ledgerloom.llm.registry import query
from ledgerloom.llm.rules import judge_texts
from ledgerloom.llm.shards import grid, place
from ledgerloom.llm.urls import judge, rule_table

RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
SHARDS = 40


@query("op1_mixing", None)
def _(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return mix(docs)[0].drop("text")


@query(
    "op2_url_filters",
    r"""WITH rules(rule, verdict, rh, rp) AS (VALUES ('net/', 'block', 'net', '/'), ('example.net/en/', 'allow', 'example.net', '/en/'),
      ('example.com/de/', 'block', 'example.com', '/de/'), ('org/fr/', 'allow', 'org', '/fr/')),
    cut AS (SELECT row_number() OVER () AS n, page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
      FROM pages),
    parts AS (SELECT n, page_id, translate(regexp_extract(coalesce(rest, ''), '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
      regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
    best AS (SELECT n, max({'l': length(rule), 'rule': rule, 'verdict': r.verdict}) AS b FROM parts JOIN rules r
      ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY n)
    SELECT page_id, host, path, b.rule AS rule, coalesce(b.verdict, 'allow') AS verdict FROM parts LEFT JOIN best USING (n)""",
)
def _(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return judge(pages, rule_table(spark, RULES)).select("page_id", "host", "path", "rule", "verdict")


@query(
    "op3_quality_rules",
    r"""WITH d AS (SELECT row_number() OVER () AS n, doc_id, coalesce(text, '') AS t FROM documents),
    w AS (SELECT n, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
      list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
    g AS (SELECT n, unnest(range(1, len(ws) - 3)) AS i, ws FROM w WHERE len(ws) >= 5),
    k AS (SELECT n, i, ws[i:i + 4] AS five FROM g),
    r AS (SELECT n, i FROM (SELECT n, i, count(*) OVER (PARTITION BY n, five) AS c FROM k) WHERE c > 1),
    p AS (SELECT n, count(DISTINCT q) AS reps FROM (SELECT n, unnest(range(i, i + 5)) AS q FROM r) GROUP BY n),
    m AS (SELECT doc_id, len(ws) AS n_words, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::bigint AS word_chars,
      coalesce(list_sum(list_transform(ws, lambda x: strlen(x))), 0)::bigint AS word_bytes,
      length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, len(ls) - len(list_distinct(ls)) AS n_dup_lines,
      coalesce(reps, 0) AS n_repeat_words, len(ls) AS n_lines,
      len(list_filter(ls, lambda x: ends_with(x, '...') OR ends_with(x, '…'))) AS n_ellipsis,
      len(list_filter(ws, lambda x: translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') IN (
        'the', 'of', 'and', 'to', 'a', 'in', 'is', 'that', 'it', 'for', 'was', 'on', 'with', 'as', 'are', 'be', 'this', 'by', 'from', 'at',
        'der', 'die', 'und', 'den', 'von', 'zu', 'das', 'mit', 'sich', 'des', 'auf', 'für', 'ist', 'im', 'dem', 'nicht', 'ein', 'eine',
        'de', 'la', 'le', 'et', 'les', 'en', 'un', 'du', 'une', 'que', 'est', 'pour', 'qui', 'dans', 'par', 'sur', 'au', 'pas', 'avec',
        'el', 'y', 'los', 'del', 'se', 'las', 'por', 'para', 'con', 'no', 'una', 'su', 'al', 'es'))) AS n_stop
      FROM w LEFT JOIN p USING (n)),
    f AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
      NOT base_failed AND (word_bytes > 1.5 * word_chars OR (word_chars >= 3 * n_words AND word_chars <= 10 * n_words))
      AND n_symbols::double / n_words <= 0.1::double AND (n_words < 100 OR n_stop::double / n_words >= 0.005::double)
      AND n_dup_lines::double / n_lines <= 0.5::double AND n_ellipsis::double / n_lines <= 0.3::double AS kept FROM f""",
)
def _(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return judge_texts(docs).drop("text")


@query("op9_sharding", None)
def _(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return place(docs, grid(SHARDS))
