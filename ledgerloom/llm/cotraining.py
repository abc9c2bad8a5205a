"""Quality classifier by co-training two views.

One view reads the text (symbols, capitals, repetition, word shapes), the other the page's metadata (source, language,
length, lines). Each view is a naive Bayes classifier over binned features, so fitting it is one aggregation of counts
over all documents, and only the counts per feature and bin reach the driver. In every round each view labels the
unlabelled documents it is confident about for the other view. At the end both views are calibrated on the labelled
documents and their log-odds are added.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.columns import UPPER, words
from ledgerloom.runtime import durable, lookup_side

ROUNDS = 3
# A view labels a document for the other at this calibrated probability or more (or one minus it, or less).
CONFIDENT = 0.98
# Documents are kept from this probability of good quality on: only clear junk goes.
KEEP_FROM = 0.1
SOURCE_BINS = 64
CALIBRATION_BINS = 40
SYMBOLS = "#*$%&|<>"


def _bin(value: Column, edges: Sequence[float]) -> Column:
    """Number of edges at or below the value; null has a bin of its own."""
    found = F.lit(0)
    for e in edges:
        found += (value >= e).cast("int")
    return F.coalesce(found, F.lit(len(edges) + 1))


def _share(part: Column, whole: Column) -> Column:
    return F.coalesce(part / F.nullif(whole.cast("double"), F.lit(0.0)), F.lit(0.0))


def features(docs: DataFrame, text_col: str = "text") -> tuple[DataFrame, dict[str, range]]:
    """``docs`` with an array ``_bins`` of binned features, and the places of each view in it.

    The array comes out of a generator, so conditions on scores are tested after it and do not repeat its work.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    without = lambda chars: F.length(text) - F.length(F.translate(text, chars, ""))
    df = docs.withColumns({"_words": words(text), "_chars": F.length(text), "_lines": F.size(F.split(text, "\n"))})
    n = F.size("_words")
    repeats = F.size(F.filter("_words", lambda w, i: w == F.get("_words", i - 1)))
    # Measures are columns, so each is computed once however many edges its bins have.
    df = df.withColumns(
        {
            "_n": n,
            "_symbols": _share(without(SYMBOLS), F.col("_chars")),
            "_upper": _share(without(UPPER), F.col("_chars")),
            "_marks": _share(without("!?"), n),
            "_digits": _share(without("0123456789"), F.col("_chars")),
            "_repeats": _share(repeats, n),
            "_varied": _share(F.size(F.array_distinct("_words")), n),
            "_word": _share(F.col("_chars"), n),
            "_line": _share(F.col("_chars"), F.col("_lines")),
        }
    )
    text_view = [
        _bin(F.col("_symbols"), (0.0005, 0.005, 0.02, 0.05, 0.1)),
        _bin(F.col("_upper"), (0.01, 0.05, 0.1, 0.2, 0.4)),
        _bin(F.col("_marks"), (0.001, 0.02, 0.1, 0.3, 0.7)),
        _bin(F.col("_digits"), (0.001, 0.02, 0.1, 0.3)),
        _bin(F.col("_repeats"), (0.002, 0.02, 0.1, 0.3, 0.6)),
        _bin(F.col("_n"), (30, 300, 3000)) * 6 + _bin(F.col("_varied"), (0.15, 0.3, 0.45, 0.6, 0.8)),
        _bin(F.col("_word"), (3, 4, 5, 6, 7, 9, 12, 20)),
    ]
    page_view = [
        F.pmod(F.xxhash64(F.coalesce("source", F.lit(""))), F.lit(SOURCE_BINS)).cast("int"),
        F.pmod(F.xxhash64(F.coalesce("lang", F.lit(""))), F.lit(SOURCE_BINS)).cast("int"),
        _bin(F.coalesce("n_chars", F.lit(0)), (50, 100, 250, 500, 1000, 2000, 4000, 8000, 16000)),
        _bin(F.col("_lines"), (2, 4, 8, 16, 32, 64, 128)),
        _bin(F.col("_line"), (20, 50, 100, 200, 400, 800)),
    ]
    bins = F.array(*text_view, *page_view)
    rows = df.select(*docs.columns, F.explode(F.array(bins)).alias("_bins"))
    return rows, {"text": range(len(text_view)), "page": range(len(text_view), len(text_view) + len(page_view))}


@dataclass(frozen=True)
class View:
    """Log-likelihood ratios by place and bin, the prior, and the calibration ``slope * score + shift``."""

    ratios: Mapping[int, Mapping[int, float]]
    prior: float
    slope: float = 1.0
    shift: float = 0.0

    def score(self) -> Column:
        total = F.lit(self.prior)
        for place, table in sorted(self.ratios.items()):
            by_bin = F.array(*[F.lit(float(table.get(b, 0.0))) for b in range(max(table, default=0) + 1)])
            total += F.coalesce(F.get(by_bin, F.get("_bins", F.lit(place))), F.lit(0.0))
        return total

    def log_odds(self) -> Column:
        return self.slope * self.score() + self.shift


def _fit(rows: DataFrame, places: Sequence[int], label: Column) -> View:
    """Counts every bin of every feature by label, over all rows that have one."""
    counted = (
        rows.select(label.alias("label"), F.posexplode("_bins").alias("place", "bin"))
        .where(F.col("label").isNotNull() & F.col("place").between(places[0], places[-1]))
        .groupBy("place", "bin")
        .agg(F.sum("label").alias("good"), F.sum(1 - F.col("label")).alias("bad"))
        .collect()
    )
    ratios: dict[int, dict[int, float]] = {p: {} for p in places}
    prior = 0.0
    for place in places:
        own = [r for r in counted if r["place"] == place]
        good, bad = sum(r["good"] for r in own), sum(r["bad"] for r in own)
        prior = math.log((good + 1) / (bad + 1))
        for r in own:
            ratios[place][r["bin"]] = math.log((r["good"] + 1) / (good + len(own))) - math.log((r["bad"] + 1) / (bad + len(own)))
    return View(ratios, prior)


def _calibrated(rows: DataFrame, view: View) -> View:
    """Fits the logistic link from score to label on labelled rows, from counts and sums per score bin."""
    step = F.floor(F.greatest(F.lit(-20.0), F.least(F.lit(19.999), view.score())) * (CALIBRATION_BINS / 40)).cast("int")
    bins = (
        rows.where(F.col("_label").isNotNull())
        .groupBy(step.alias("bin"))
        .agg(F.avg(view.score()).alias("x"), F.count("*").alias("n"), F.sum("_label").alias("good"))
        .collect()
    )
    if not bins:
        return view
    slope, shift = 1.0, 0.0
    for _ in range(50):
        # Newton steps with a weak pull of the slope towards 1.
        g0 = g1 = h00 = h01 = 0.0
        h11, g1 = 1.0, -(slope - 1.0)
        for b in bins:
            p = 1 / (1 + math.exp(-max(-500.0, min(500.0, slope * b["x"] + shift))))
            d, w = b["good"] - b["n"] * p, b["n"] * p * (1 - p)
            g0, g1 = g0 + d, g1 + d * b["x"]
            h00, h01, h11 = h00 + w, h01 + w * b["x"], h11 + w * b["x"] * b["x"]
        h00 += 1e-3
        det = h00 * h11 - h01 * h01
        if abs(det) < 1e-12:
            break
        move0, move1 = (h11 * g0 - h01 * g1) / det, (h00 * g1 - h01 * g0) / det
        size = max(1.0, abs(move0), abs(move1))
        shift, slope = shift + move0 / size, slope + move1 / size
        if abs(move0) + abs(move1) < 1e-9:
            break
    return View(view.ratios, view.prior, max(slope, 0.0), shift)


@dataclass(frozen=True)
class Model:
    text: View
    page: View
    prior: float

    def log_odds(self) -> Column:
        """Both calibrated views hold the prior; it counts once."""
        return self.text.log_odds() + self.page.log_odds() - self.prior


def co_train(rows: DataFrame, views: Mapping[str, Sequence[int]], rounds: int = ROUNDS, confident: float = CONFIDENT) -> Model:
    """Fits both views on ``rows``, whose ``_label`` is 0, 1 or null. Without both labels everything is good."""
    good, bad = rows.agg(
        F.coalesce(F.sum("_label"), F.lit(0)), F.coalesce(F.sum(1 - F.col("_label")), F.lit(0))
    ).first()
    if not good or not bad:
        flat = View({}, 5.0 if not bad else -5.0)
        return Model(flat, flat, flat.prior)
    limit = math.log(confident / (1 - confident))
    fitted = {v: _calibrated(rows, _fit(rows, places, F.col("_label"))) for v, places in views.items()}
    for _ in range(rounds):
        taught = {}
        for view, teacher in (("text", "page"), ("page", "text")):
            odds = fitted[teacher].log_odds()
            pseudo = F.when(odds >= limit, 1).when(odds <= -limit, 0)
            taught[view] = _calibrated(rows, _fit(rows, views[view], F.coalesce(F.col("_label"), pseudo)))
        fitted = taught
    return Model(fitted["text"], fitted["page"], math.log(good / bad))


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", keep_from: float = KEEP_FROM) -> DataFrame:
    """Every row of ``docs`` with ``quality_text, quality_page, quality`` (probabilities) and ``kept``; input columns of
    these names are replaced.

    ``labels`` has ``doc_id, quality`` (0 or 1); of several labels the lowest counts, other values and null ids are no
    labels. Rows whose label is unknown take part through the views' confident guesses. Null or empty text has the
    bins of a text without words; missing metadata has bins of its own. All rows are counted and scored, equal rows
    alike; an empty table gives no rows.
    """
    own = ("quality_text", "quality_page", "quality", "kept")
    rest = [c for c in docs.columns if c not in own and not c.startswith("_")]
    known = (
        labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1))
        .groupBy(F.col("doc_id").alias("_id"))
        .agg(F.min("quality").cast("int").alias("_label"))
    )
    rows, views = features(docs.select(*rest))
    slim = rows.select(F.col(id_col).alias("_doc"), "_bins")
    slim = durable(slim.join(lookup_side(known), F.col("_doc") == F.col("_id"), "left").drop("_doc", "_id"))
    model = co_train(slim, views)
    return rows.select(
        *rest,
        _probability(model.text.log_odds()).alias("quality_text"),
        _probability(model.page.log_odds()).alias("quality_page"),
        _probability(model.log_odds()).alias("quality"),
    ).withColumn("kept", F.col("quality") >= keep_from)


def _probability(odds: Column) -> Column:
    return 1 / (1 + F.exp(-odds))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the classifier keeps, with their own columns, whatever their names."""
    rows = docs.select("doc_id", "text", "lang", "source", "n_chars", F.struct(*docs.columns).alias("row"))
    return classify(rows, labels).where("kept").select("row.*")
