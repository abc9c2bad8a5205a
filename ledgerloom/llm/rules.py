"""Quality rules: a table of thresholds compiled into one projection.

All measures are built-in functions over the words and lines of a text; a rule is a measure, a bound and the least
number of words from which it applies.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.columns import WORD_GAPS, lower_ascii, words

# Characters counted as symbols (fixed value).
SYMBOLS = "#*$%&|<>"
WINDOW = 5

# Frequent function words by language (fixed values).
STOP_WORDS: Mapping[str, tuple[str, ...]] = {
    "en": ("the", "of", "and", "to", "a", "in", "is", "that", "it", "for", "was", "on", "with", "as", "are", "be", "this", "by", "from", "at"),
    "de": ("der", "die", "und", "in", "den", "von", "zu", "das", "mit", "sich", "des", "auf", "für", "ist", "im", "dem", "nicht", "ein", "eine"),
    "fr": ("de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "est", "pour", "qui", "dans", "par", "sur", "au", "pas", "avec"),
    "es": ("de", "la", "que", "el", "en", "y", "a", "los", "del", "se", "las", "por", "un", "para", "con", "no", "una", "su", "al", "es"),
}


@dataclass(frozen=True)
class Threshold:
    """Keeps texts whose ``measure`` lies within the bounds; texts of fewer than ``from_words`` words pass, and those
    with more than ``most_bytes`` UTF-8 bytes per word character, whose script the bounds do not fit."""

    measure: str
    least: float | None = None
    most: float | None = None
    from_words: int = 0
    most_bytes: float | None = None


# Production thresholds: those customary for web text, but half the lines may repeat, as short good texts have few lines.
# Scripts beyond Latin need not part words by blanks.
THRESHOLDS = (
    Threshold("mean_word_chars", least=3.0, most=10.0, most_bytes=1.5),
    Threshold("symbols_per_word", most=0.1),
    Threshold("stop_share", least=0.005, from_words=100),
    Threshold("dup_line_share", most=0.5),
    Threshold("ellipsis_line_share", most=0.3),
)


def _measures(docs: DataFrame, text: Column) -> DataFrame:
    """Adds the counts as columns ``_...``, to a table that has none. Arrays read more than once are columns, so they are built once."""
    gap_free = F.translate(text, WORD_GAPS, "")
    df = docs.withColumns(
        {
            "_text": F.coalesce(text, F.lit("")),
            "_words": words(text),
            "_word_chars": F.length(F.coalesce(gap_free, F.lit(""))).cast("long"),
            "_word_bytes": F.octet_length(F.coalesce(gap_free, F.lit(""))).cast("long"),
        }
    )
    has_word = lambda line: F.length(F.translate(line, WORD_GAPS, "")) > 0
    df = df.withColumns(
        {
            "_n_words": F.size("_words").cast("long"),
            "_n_symbols": (F.length("_text") - F.length(F.translate("_text", SYMBOLS, ""))).cast("long"),
            "_lines": F.filter(F.split("_text", "\n"), has_word),
            "_hashes": F.transform("_words", lambda w: F.xxhash64(w)),
            "_n_stop": F.size(
                F.filter("_words", lambda w: lower_ascii(w).isin(sorted({x for l in STOP_WORDS.values() for x in l})))
            ),
        }
    ).drop("_text")
    at = lambda i, k: F.get("_hashes", i + k)
    windows = F.transform(
        F.sequence(F.lit(0), F.size("_hashes") - WINDOW), lambda i: F.xxhash64(*[at(i, k) for k in range(WINDOW)])
    )
    df = df.withColumns(
        {
            "_windows": F.when(F.col("_n_words") >= WINDOW, windows),
            "_n_lines": F.size("_lines").cast("long"),
            "_n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "_n_ellipsis": F.size(F.filter("_lines", lambda x: x.endswith("...") | x.endswith("…"))),
        }
    ).drop("_words", "_hashes", "_lines")
    # Windows sorted by hash, only where some window occurs twice; equal neighbours are the repeated ones.
    placed = F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    repeats = F.size("_windows") > F.size(F.array_distinct("_windows"))
    df = df.withColumn("_sorted", F.when(repeats, F.sort_array(placed))).drop("_windows")
    near = lambda x, i: F.coalesce(F.get("_sorted", i)["h"] == x["h"], F.lit(False))
    starts = F.transform(F.filter("_sorted", lambda x, i: near(x, i - 1) | near(x, i + 1)), lambda x: x["i"])
    covered = F.aggregate(
        F.sort_array(starts),
        F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).cast("long").alias("n")),
        lambda acc, i: F.struct(
            i.alias("last"), (acc["n"] + F.least(F.lit(WINDOW), i - acc["last"])).cast("long").alias("n")
        ),
        lambda acc: acc["n"],
    )
    return df.withColumn("_n_repeat", F.coalesce(covered, F.lit(0).cast("long"))).drop("_sorted")


_RATIOS = {
    "mean_word_chars": ("_word_chars", "_n_words"),
    "symbols_per_word": ("_n_symbols", "_n_words"),
    "stop_share": ("_n_stop", "_n_words"),
    "dup_line_share": ("_n_dup_lines", "_n_lines"),
    "ellipsis_line_share": ("_n_ellipsis", "_n_lines"),
    "n_words": ("_n_words", None),
}


def _verdict(thresholds: Sequence[Threshold]) -> Column:
    """True where every threshold holds; a ratio without denominator holds."""
    kept = F.lit(True)
    for t in thresholds:
        above, below = _RATIOS[t.measure]
        value = F.col(above).cast("double")
        if below:
            value = value / F.nullif(F.col(below), F.lit(0).cast("long"))
        held = F.lit(True)
        if t.least is not None:
            held &= value >= t.least
        if t.most is not None:
            held &= value <= t.most
        held = F.coalesce(held, F.lit(True)) | (F.col("_n_words") < t.from_words)
        if t.most_bytes is not None:
            held |= F.col("_word_bytes") > t.most_bytes * F.col("_word_chars")
        kept &= held
    return kept


def judge_texts(docs: DataFrame, thresholds: Sequence[Threshold] = THRESHOLDS, text_col: str = "text") -> DataFrame:
    """``docs`` with ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept``.

    Input columns of these names are replaced, all others stay. Null text has no words and fails the base rule. A text
    fails the base rule with fewer than ten words, or if more than a fifth of its words lie in five-word windows found
    twice or more. A value on a bound is kept. Everything is computed within the row, over the whole text: no shuffle,
    memory in proportion to the longest text, and repeated rows get equal verdicts. An empty table stays empty.
    """
    own = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    rest = [c for c in docs.columns if c not in own]
    # The input row travels as one value, so its column names meet none of the measures'.
    carried = F.struct(*[F.col(c) for c in rest]) if rest else F.lit(None)
    rows = docs.select(carried.alias("_row"), F.col(text_col).alias("_source"))
    df = _measures(rows, F.col("_source"))
    failed = (F.col("_n_words") < 10) | (100 * F.col("_n_repeat") > 20 * F.col("_n_words"))
    return df.select(
        *[F.col("_row")[c].alias(c) for c in rest],
        F.col("_n_words").alias("n_words"),
        F.col("_word_chars").alias("word_chars"),
        F.col("_n_symbols").alias("n_symbols"),
        F.col("_n_dup_lines").alias("n_dup_lines"),
        F.col("_n_repeat").alias("n_repeat_words"),
        failed.alias("base_failed"),
        (~failed & _verdict(thresholds)).alias("kept"),
    )
