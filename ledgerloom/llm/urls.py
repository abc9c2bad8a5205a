"""URL filters: host-suffix and path-prefix expressions looked up by short hash.

Every url is expanded into all combinations of a suffix of its host and a leading part of its path that ends with a
slash. Expressions meet the rules in an equi-join on eight hex digits of their SHA-256; the full digest and the rule's
own path then confirm the hit, and the longest confirmed rule decides.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm.columns import lower_ascii
from ledgerloom.runtime import literal_rows, lookup_side

PREFIX_DIGITS = 8


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null or a url without ``://``."""
    rest = F.when(F.locate("://", url) > 0, F.substring(url, F.locate("://", url) + 3, F.length(url)))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    return lower_ascii(host), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_table(spark: SparkSession, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """Rules as (verdict, host and path), for example ``("block", "example.com/de/")``."""
    schema = T.StructType([T.StructField("verdict", T.StringType()), T.StructField("rule", T.StringType())])
    return literal_rows(spark, rules, schema)


def _short(digest: Column) -> Column:
    return F.substring(digest, 1, PREFIX_DIGITS)


def _prepared(rules: DataFrame) -> DataFrame:
    """Rule with host, path and the digest of its expression: host and path up to the last slash."""
    host = lower_ascii(F.substring_index("rule", "/", 1))
    path = F.substring(F.col("rule"), F.length(F.substring_index("rule", "/", 1)) + 1, F.length("rule"))
    base = F.regexp_extract(path, r"^.*/", 0)
    digest = F.sha2(F.concat(host, base), 256)
    return rules.where(F.col("rule").isNotNull()).select(
        F.col("rule").alias("_rule"),
        F.col("verdict").alias("_verdict"),
        host.alias("_rule_host"),
        path.alias("_rule_path"),
        (F.length(base) - F.length(F.replace(base, F.lit("/"), F.lit("")))).alias("_depth"),
        digest.alias("_rule_digest"),
        _short(digest).alias("_short"),
    )


def _expressions(host: Column, path: Column, labels: int, depth: int) -> Column:
    """All expressions no deeper than the deepest rule; deeper ones can meet none."""
    parts = F.split(host, r"\.")
    first = F.greatest(F.lit(1), F.size(parts) - labels + 1)
    hosts = F.transform(
        F.sequence(first, F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), ".")
    )
    steps = F.split(path, "/")
    ends = F.least(F.lit(depth), F.size(steps) - 1)
    bases = F.when(
        ends >= 1,
        F.transform(F.sequence(F.lit(1), ends), lambda i: F.concat(F.array_join(F.slice(steps, F.lit(1), i), "/"), F.lit("/"))),
    ).otherwise(F.array().cast("array<string>"))
    bases = F.concat(F.array(F.lit("")), bases)
    return F.flatten(F.transform(hosts, lambda h: F.transform(bases, lambda b: F.concat(h, b))))


def judge(pages: DataFrame, rules: DataFrame, url_col: str = "url", default: str = "allow") -> DataFrame:
    """``pages`` with ``host, path, rule, verdict``; input columns of these names are replaced.

    A rule fits its host and all subdomains if the url's path starts with the rule's path. The longest fitting rule
    decides, then the one with the longer host, then block before allow. A url without a fitting rule gets a null rule
    and ``default``. Null urls, urls without ``://`` and empty hosts meet no rule unless one has an empty host. Rules
    may be many: they are broadcast only when measured small. Every distinct url is judged once, so a hot url costs one
    lookup.
    """
    prepared = _prepared(rules)
    bounds = prepared.agg(
        F.max(F.size(F.split("_rule_host", r"\."))).alias("labels"), F.max("_depth").alias("depth")
    ).first()
    url = F.col(url_col)
    host, path = host_and_path(url)
    own = ("host", "path", "rule", "verdict", "_key")
    rows = pages.select(*[F.col(c) for c in pages.columns if c not in own], url.alias("_key"))
    key_host, key_path = host_and_path(F.col("_key"))
    asked = pages.select(url.alias("_key")).where(F.col("_key").isNotNull()).distinct()
    expressions = _expressions(key_host, key_path, bounds["labels"] or 1, bounds["depth"] or 0)
    asked = asked.select("_key", key_path.alias("_path"), F.explode(F.array_distinct(expressions)).alias("_expression"))
    digest = F.sha2("_expression", 256)
    asked = asked.select("_key", "_path", digest.alias("_digest"), _short(digest).alias("_short"))
    hits = asked.join(lookup_side(prepared, once=False), "_short").where(
        (F.col("_digest") == F.col("_rule_digest")) & F.col("_path").startswith(F.col("_rule_path"))
    )
    rank = F.struct(
        F.length("_rule").alias("a"),
        F.length("_rule_host").alias("b"),
        (F.col("_verdict") == "block").alias("c"),
        F.col("_rule").alias("rule"),
        F.col("_verdict").alias("verdict"),
    )
    best = hits.groupBy("_key").agg(F.max(rank).alias("_best"))
    host, path = host_and_path(F.col("_key"))
    return rows.join(best, "_key", "left").select(
        *[c for c in rows.columns if c != "_key"],
        host.alias("host"),
        path.alias("path"),
        F.col("_best.rule").alias("rule"),
        F.coalesce("_best.verdict", F.lit(default)).alias("verdict"),
    )
