"""Mixing sources to target weights by iterative proportional fitting.

Tokens are counted per source, language and topic. Raking finds one factor per source, language and topic so that the
weighted tokens meet all three marginals. A document is then sampled with a probability proportional to the product of
its three factors, scaled to a token budget.

Languages and topics are short lists, so a source is one row with a dense vector of at most ``MAX_CELLS`` token counts.
A raking round is one aggregation over the sources, however many there are; only the language-by-topic sums come
back to the driver.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.columns import uniform, words
from ledgerloom.runtime import durable, lookup_side

MAX_CELLS = 1024
OTHER = "other"


@dataclass(frozen=True)
class Targets:
    """Target shares by name; a name outside the lists counts as ``other``.

    Where shares are None they are the observed token shares raised to ``temperature`` and normalised: below 1, small
    groups gain. ``temperature`` always sets the sources. ``budget`` is the share of all tokens to sample.
    """

    langs: Mapping[str, float | None]
    topics: Mapping[str, float | None]
    temperature: float = 0.9
    budget: float = 0.85


# Production targets.
TARGETS = Targets(
    langs={"en": None, "de": None, "fr": None, "es": None},
    topics={"tabular": None, "note": None, "article": None, "book": None},
)


@dataclass(frozen=True)
class Fit:
    """Factors of languages and topics, the sampling rate, and how far the raked margins are from the targets."""

    lang: tuple[float, ...]
    topic: tuple[float, ...]
    rate: float
    rounds: int
    residual: float


def topic_by_form(text: Column) -> Column:
    """A topic for corpora without one: tables by their column bars, other texts by length."""
    size = F.length(F.coalesce(text, F.lit("")))
    bars = F.length(F.replace(text, F.lit(" | "), F.lit("   "))) - F.length(F.replace(text, F.lit(" | "), F.lit("")))
    return (
        F.when(bars * 20 > size, "tabular").when(size < 600, "note").when(size < 6000, "article").otherwise("book")
    )


def _named(value: Column, names: Sequence[str]) -> Column:
    """Position of the name in the list; everything else, null included, has the last position."""
    position = F.lit(len(names))
    for i, name in enumerate(names):
        position = F.when(value == name, i).otherwise(position)
    return position


def _shares(observed: Sequence[float], names: Sequence[str], wanted: Mapping[str, float | None], temperature: float) -> list[float]:
    """Target shares of the names and of ``other``; groups without tokens get none and the rest is scaled up."""
    total = sum(observed) or 1.0
    shares = []
    for name, seen in zip((*names, OTHER), observed):
        share = wanted.get(name)
        if share is None:
            share = (seen / total) ** temperature if seen else 0.0
        shares.append(share if seen else 0.0)
    whole = sum(shares) or 1.0
    return [s / whole for s in shares]


def _dot(vector: Column, factors: Sequence[float]) -> Column:
    weights = F.array(*[F.lit(float(x)) for x in factors])
    return F.aggregate(F.zip_with(vector, weights, lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)


def mix(
    docs: DataFrame,
    targets: Targets = TARGETS,
    topic: Column | None = None,
    seed: int = 20,
    tolerance: float = 1e-6,
    max_rounds: int = 40,
    id_col: str = "doc_id",
) -> tuple[DataFrame, Fit]:
    """Every row of ``docs`` with ``tokens, topic, weight, probability, selected``; input columns of these names go.

    ``weight`` is the raked factor, ``probability`` its calibrated chance (at most 1) and ``selected`` the draw, hashed
    from ``doc_id``: repeated rows share their fate and a retry changes nothing. Null sources are one source, null
    text has no tokens and is drawn like its group. Probabilities capped at 1 give their surplus to the others until
    the budget is met. Margins that no factors can meet (empty combinations) leave a residual, given in ``Fit``.
    """
    own = ("tokens", "topic", "weight", "probability", "selected")
    langs, topics = list(targets.langs), list(targets.topics)
    width = len(topics) + 1
    cells = (len(langs) + 1) * width
    if cells > MAX_CELLS:
        raise ValueError(f"{cells} language and topic cells, at most {MAX_CELLS} are supported")
    topic = topic_by_form(F.col("text")) if topic is None else topic
    rest = [c for c in docs.columns if c not in own and not c.startswith("_")]
    rows = docs.select(
        *rest,
        F.size(words(F.col("text"))).cast("long").alias("tokens"),
        topic.alias("topic"),
        F.coalesce(F.col("source"), F.lit("")).alias("_source"),
    ).withColumn("_cell", _named(F.col("lang"), langs) * width + _named(F.col("topic"), topics))
    counted = rows.groupBy("_source", "_cell").agg(F.sum("tokens").cast("double").alias("n"))
    counted = counted.groupBy("_source").agg(F.map_from_entries(F.collect_list(F.struct("_cell", "n"))).alias("cells"))
    dense = F.transform(F.sequence(F.lit(0), F.lit(cells - 1)), lambda i: F.coalesce(F.try_element_at("cells", i), F.lit(0.0)))
    counted = durable(
        counted.select("_source", dense.alias("cells")).withColumn(
            "tokens", F.aggregate("cells", F.lit(0.0), lambda acc, x: acc + x)
        )
    )
    total, norm = counted.agg(
        F.coalesce(F.sum("tokens"), F.lit(0.0)), F.coalesce(F.sum(F.pow("tokens", F.lit(targets.temperature))), F.lit(0.0))
    ).first()
    goal = F.when(F.col("tokens") > 0, F.pow("tokens", F.lit(targets.temperature)) / (norm or 1.0) * total).otherwise(0.0)

    def cell_factors(lang: Sequence[float], by_topic: Sequence[float]) -> list[float]:
        return [x * y for x in lang for y in by_topic]

    def source_factor(factors: Sequence[float]) -> Column:
        return goal / F.nullif(_dot(F.col("cells"), factors), F.lit(0.0))

    def sums(weight: Column) -> list[float]:
        row = counted.agg(*[F.coalesce(F.sum(weight * F.get("cells", F.lit(i))), F.lit(0.0)) for i in range(cells)]).first()
        return [float(x) for x in row]

    seen = sums(F.lit(1.0))
    lang_goal = _shares([sum(seen[i * width : (i + 1) * width]) for i in range(len(langs) + 1)], langs, targets.langs, targets.temperature)
    topic_goal = _shares([sum(seen[j::width]) for j in range(width)], topics, targets.topics, targets.temperature)
    lang, by_topic = [1.0] * (len(langs) + 1), [1.0] * width
    rounds, residual = 0, 0.0
    while total and rounds < max_rounds:
        rounds += 1
        # Tokens per language and topic after the sources are set; then languages and topics are set on them.
        base = sums(F.coalesce(source_factor(cell_factors(lang, by_topic)), F.lit(0.0)))
        weighted = [x * y for x, y in zip(base, cell_factors(lang, by_topic))]
        residual = max(
            [abs(sum(weighted[i * width : (i + 1) * width]) / total - g) for i, g in enumerate(lang_goal)]
            + [abs(sum(weighted[j::width]) / total - g) for j, g in enumerate(topic_goal)]
        )
        if residual < tolerance:
            break
        for i, g in enumerate(lang_goal):
            mass = sum(base[i * width + j] * by_topic[j] for j in range(width))
            lang[i] = g * total / mass if mass else 0.0
        for j, g in enumerate(topic_goal):
            mass = sum(base[i * width + j] * lang[i] for i in range(len(lang)))
            by_topic[j] = g * total / mass if mass else 0.0
    factors = F.array(*[F.lit(x) for x in cell_factors(lang, by_topic)])
    scale = F.coalesce(source_factor(cell_factors(lang, by_topic)), F.lit(0.0))
    fitted = durable(
        counted.select(
            F.col("_source").alias("_fitted"), "cells", F.transform(factors, lambda x: x * scale).alias("weights")
        )
    )
    # The rate that meets the budget when no probability may pass 1.
    rate, wanted = 0.0, targets.budget * total
    parts = fitted.select(F.inline(F.arrays_zip("cells", "weights")))
    for _ in range(max_rounds if total else 0):
        full = F.col("weights") * rate >= 1.0
        capped, free = parts.agg(
            F.coalesce(F.sum(F.when(full, F.col("cells"))), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~full, F.col("cells") * F.col("weights"))), F.lit(0.0)),
        ).first()
        found = (wanted - capped) / free if free > 0 else rate
        if abs(found - rate) <= 1e-12 * max(rate, 1e-12):
            break
        rate = found
    weight = F.coalesce(F.get("weights", F.col("_cell")), F.lit(0.0))
    mixed = (
        rows.join(lookup_side(fitted.drop("cells"), once=False), F.col("_source") == F.col("_fitted"), "left")
        .withColumn("weight", weight)
        .withColumn("probability", F.least(F.lit(1.0), F.col("weight") * rate))
        .withColumn("selected", uniform(F.lit(seed), F.col(id_col)) <= F.col("probability"))
    )
    return mixed.select(*rest, *own), Fit(tuple(lang), tuple(by_topic), rate, rounds, residual)


def sample_mix(docs: DataFrame, targets: Targets = TARGETS) -> DataFrame:
    """The sampled rows of ``docs`` with their own columns, whatever their names."""
    rows = docs.select("doc_id", "text", "lang", "source", F.struct(*docs.columns).alias("row"))
    return mix(rows, targets)[0].where("selected").select("row.*")
