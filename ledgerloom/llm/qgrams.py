"""Benchmark decontamination by the q-gram lemma.

Texts are compared as lower-cased letters and digits with single blanks between. A passage of ``m`` characters found
with at most ``e`` edits shares ``m - q + 1 - q * e`` q-grams with its place in the document, and all of them lie on
diagonals no more than ``e`` apart. Shared q-grams are counted in overlapping bands of diagonals; only regions that
reach the bound are verified, by edit distance within the band.

Passages too short for edits are searched exactly: at word borders if they hold some words, and otherwise as a whole
document. The benchmark is indexed in blocks of bounded size; every block meets all documents.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.workers import arrow_map
from ledgerloom.runtime import lookup_side

Q = 10
EDIT_RATE = 0.08
# Shorter passages are searched without edits, at word borders.
LEAST_CHARS = 32
# With fewer characters or words a passage is found only where it is the whole document.
SHORT_CHARS, SHORT_WORDS = 12, 3
# Characters of one index block, and of the documents scanned at once.
INDEX_CHARS = 2_000_000
SCAN_CHARS = 1_000_000
_TABLE_BITS = 22
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
FOUND = "item_id bigint, start int, end int, edits int, length int"


@cache
def _alnum() -> np.ndarray:
    return np.array([chr(i).isalnum() for i in range(0x110000)])


def normalised(texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, lower-cased, each run of other characters as one blank, each text closed by a line
    feed; and where each text ends, its line feed included."""
    lower = [(t or "").lower() for t in texts]
    codes = _codes("\n".join(lower) + "\n") if lower else np.empty(0, np.uint32)
    close = np.cumsum([len(t) + 1 for t in lower], dtype=np.int64) - 1
    word = _alnum()[codes]
    keep = word.copy()
    keep[1:] |= word[:-1]
    keep[close] = True
    out = np.where(word, codes, 32).astype(np.uint32)
    out[close] = 10
    return out[keep], np.cumsum(keep)[close] if lower else close


def _text(codes: np.ndarray) -> str:
    return codes.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")


def normalise(text: str | None) -> str:
    return _text(normalised([text])[0]).strip()


def edit_budget(chars: int, q: int = Q, rate: float = EDIT_RATE) -> int:
    """Edits allowed for a passage, few enough that at least one q-gram must survive."""
    return min(int(chars * rate), (chars - q) // q)


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def gram_hashes(codes: np.ndarray, q: int = Q) -> np.ndarray:
    """A 64-bit hash of the q-gram at each position."""
    n = len(codes) - q + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    wide = codes.astype(np.uint64)
    total = wide[:n].copy()
    for k in range(1, q):
        total *= _BASE
        total += wide[k : k + n]
    total ^= total >> np.uint64(29)
    total *= np.uint64(0xBF58476D1CE4E5B9)
    return total


@dataclass(frozen=True)
class ShortIndex:
    """Passages searched exactly: ``phrases`` at word borders, by the hash of their first characters; ``whole`` as whole
    documents, by their text."""

    phrases: dict[int, tuple[tuple[int | None, str], ...]]
    whole: dict[str, tuple[int | None, ...]]


@dataclass(frozen=True)
class Index:
    """Q-grams of benchmark passages: sorted hashes with the (passage, position) pairs of each."""

    ids: tuple[int | None, ...]
    texts: tuple[str, ...]
    short: ShortIndex
    budgets: np.ndarray
    bounds: np.ndarray
    hashes: np.ndarray
    starts: np.ndarray
    passage: np.ndarray
    position: np.ndarray
    present: np.ndarray
    reach: int


def _short_index(items: Sequence[tuple[int | None, str]]) -> ShortIndex:
    phrases: dict[int, list[tuple[int | None, str]]] = {}
    whole: dict[str, list[int | None]] = {}
    for i, t in items:
        if len(t) < SHORT_CHARS or t.count(" ") + 1 < SHORT_WORDS:
            whole.setdefault(t, []).append(i)
        else:
            phrases.setdefault(int(gram_hashes(_codes(t[:SHORT_CHARS]), SHORT_CHARS)[0]), []).append((i, t))
    return ShortIndex({h: tuple(x) for h, x in phrases.items()}, {t: tuple(x) for t, x in whole.items()})


def build_index(items: Sequence[tuple[int | None, str | None]]) -> Index | None:
    """Index of the passages that hold a letter or digit, or None."""
    named = [(i, t) for i, t in ((i, normalise(t)) for i, t in items) if t]
    texts = [(i, t) for i, t in named if len(t) >= LEAST_CHARS]
    if not named:
        return None
    grams = [gram_hashes(_codes(t)) for _, t in texts]
    every = np.concatenate([*grams, np.empty(0, np.uint64)])
    passage = np.repeat(np.arange(len(texts)), [len(g) for g in grams])
    position = np.concatenate([*(np.arange(len(g)) for g in grams), np.empty(0, np.int64)])
    order = np.argsort(every, kind="stable")
    hashes, first = np.unique(every[order], return_index=True)
    present = np.zeros(1 << _TABLE_BITS, bool)
    present[(hashes >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)] = True
    budgets = np.array([edit_budget(len(t)) for _, t in texts], np.int64)
    bounds = np.array([len(t) - Q + 1 - Q * e for (_, t), e in zip(texts, budgets)], np.int64)
    return Index(
        tuple(i for i, _ in texts), tuple(t for _, t in texts), _short_index([x for x in named if len(x[1]) < LEAST_CHARS]),
        budgets, bounds, hashes, np.append(first, len(every)), passage[order], position[order], present,
        max((len(t) + 2 * e + 2 for (_, t), e in zip(texts, budgets.tolist())), default=0),
    )


def banded_distance(item: str, region: str, low: int, high: int) -> tuple[int, int, int]:
    """Least edits turning ``item`` into some part of ``region``, over diagonals ``low..high`` (region minus item
    position), with the part's start and end."""
    a, b = _codes(item), _codes(region)
    width, far = high - low + 1, len(a) + len(b) + 1
    # Column k of row i is region position i + low + k; costs carry their start column in the low digits.
    scale = np.int64(1 << 32)
    columns = np.arange(width, dtype=np.int64)
    place = columns + low
    inside = (place >= 0) & (place <= len(b))
    row = np.where(inside, np.clip(place, 0, None), far * scale)
    for i in range(1, len(a) + 1):
        place = columns + (i + low)
        inside = (place >= 0) & (place <= len(b))
        letter = np.clip(place - 1, 0, max(len(b) - 1, 0))
        differs = (b[letter] != a[i - 1]) if len(b) else np.ones(width, bool)
        best = np.where(place >= 1, row + differs * scale, far * scale)
        best[:-1] = np.minimum(best[:-1], row[1:] + scale)
        best = np.where(inside, best, far * scale)
        best = np.minimum.accumulate(best - columns * scale) + columns * scale
        row = np.where(inside, best, far * scale)
    k = int(np.argmin(row))
    return int(row[k] // scale), int(row[k] % scale), int(len(a) + low + k)


def _zones(hit: np.ndarray, reach: int, least: int) -> np.ndarray:
    """Hits within some stretch of ``reach`` positions that holds at least ``least`` hits."""
    if len(hit) < least:
        return hit[:0]
    near = np.searchsorted(hit, hit + reach, "right") - np.arange(len(hit))
    opens = near >= least
    change = np.zeros(len(hit) + 1, np.int64)
    np.add.at(change, np.flatnonzero(opens), 1)
    np.add.at(change, np.flatnonzero(opens) + near[opens], -1)
    return hit[np.cumsum(change[:-1]) > 0]


def find_passages(texts: Sequence[str | None], index: Index) -> list[tuple[int, int | None, int, int, int, int]]:
    """(text number, item id, start, end, edits, item length) of every region within the edit budget.

    Starts and ends count characters of the normalised text. Overlapping regions of one passage are one, the closest.
    """
    codes, ends = normalised(texts)
    return (_find_long(texts, codes, ends, index) if index.texts else []) + _find_short(codes, ends, index.short)


def _find_short(codes: np.ndarray, ends: np.ndarray, short: ShortIndex) -> list[tuple[int, int | None, int, int, int, int]]:
    """Exact places of the passages of a short index; overlapping places of one passage count from left to right."""
    out: list[tuple[int, int | None, int, int, int, int]] = []
    if short.whole:
        starts = np.concatenate([[0], ends[:-1]])
        for n in np.flatnonzero(ends - starts <= LEAST_CHARS + 1).tolist():
            text = _text(codes[starts[n] : ends[n]]).strip()
            at = len(text)
            out += [(n, i, 0, at, 0, at) for i in short.whole.get(text, ())]
    if short.phrases:
        hashes = gram_hashes(codes, SHORT_CHARS)
        gap = (codes == 32) | (codes == 10)
        opens = ~gap[: len(hashes)]
        opens[1:] &= gap[: len(hashes) - 1] if len(hashes) else True
        known = np.array(sorted(short.phrases), np.uint64)
        place = np.flatnonzero(opens)
        slot = np.minimum(np.searchsorted(known, hashes[place]), len(known) - 1)
        last: dict[tuple[int | None, str], int] = {}
        for at in place[known[slot] == hashes[place]].tolist():
            for i, item in short.phrases[int(hashes[at])]:
                end = at + len(item)
                # Texts end with a line feed, which no passage holds, so a place cannot run into the next text.
                if end < len(codes) and gap[end] and at >= last.get((i, item), 0) and _text(codes[at:end]) == item:
                    n = int(np.searchsorted(ends, at, "right"))
                    offset = int(ends[n - 1]) if n else 0
                    out.append((n, i, at - offset, end - offset, 0, len(item)))
                    last[i, item] = end
    return sorted(out, key=lambda f: (f[0], f[1] is None, f[1] or 0, f[2]))


def _find_long(texts: Sequence[str | None], codes: np.ndarray, ends: np.ndarray, index: Index) -> list[tuple[int, int | None, int, int, int, int]]:
    """Places of passages with an edit budget, by counting shared q-grams."""
    hashes = gram_hashes(codes)
    maybe = np.flatnonzero(index.present[(hashes >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)])
    maybe = _zones(maybe, index.reach, int(index.bounds.min()))
    if not len(maybe):
        return []
    slot = np.searchsorted(index.hashes, hashes[maybe])
    slot[slot == len(index.hashes)] = 0
    true = index.hashes[slot] == hashes[maybe]
    hit = _zones(maybe[true], index.reach, int(index.bounds.min()))
    slot = np.searchsorted(index.hashes, hashes[hit])
    counts = index.starts[slot + 1] - index.starts[slot]
    total = int(counts.sum())
    if not total:
        return []
    offsets = np.arange(total) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(index.starts[slot], counts)
    passage = index.passage[offsets]
    diagonal = np.repeat(hit, counts) - index.position[offsets] + index.reach
    step = index.budgets[passage] + 1
    band = diagonal // step
    # A band covers two steps, so each hit counts for its own step's band and the one before.
    wide = np.int64(len(codes) + 2 * index.reach + 4)
    key = np.concatenate([passage * wide + band, passage * wide + np.maximum(band - 1, 0)])
    keys, shared = np.unique(key, return_counts=True)
    passage, band = keys // wide, keys % wide
    enough = shared >= index.bounds[passage]
    found: dict[tuple[int, int], list[tuple[int, int, int]]] = {}
    for p, k in zip(passage[enough].tolist(), band[enough].tolist()):
        item, budget = index.texts[p], int(index.budgets[p])
        low = k * (budget + 1) - index.reach
        begin, stop = max(low, 0), min(low + 2 * budget + 2 + len(item), len(codes))
        # The band may touch a neighbour text; the text of its middle is the one meant.
        for n in {int(np.searchsorted(ends, x, "right")) for x in (begin, (begin + stop) // 2, stop - 1)}:
            if n >= len(texts):
                continue
            offset = int(ends[n - 1]) if n else 0
            region_at = max(begin - offset, 0)
            region = _text(codes[offset + region_at : min(max(stop, offset), int(ends[n]) - 1)])
            exact = region.find(item)
            if exact >= 0:
                edits, start, end = 0, exact, exact + len(item)
            elif len(region) + budget < len(item):
                continue
            else:
                shift = low - offset - region_at
                edits, start, end = banded_distance(item, region, shift, shift + 2 * budget + 1)
            if edits <= budget:
                found.setdefault((n, p), []).append((region_at + start, region_at + end, edits))
    out = []
    for (n, p), spans in sorted(found.items()):
        spans.sort(key=lambda s: (s[2], s[0]))
        taken: list[tuple[int, int, int]] = []
        for s in spans:
            if all(s[1] <= t[0] or s[0] >= t[1] for t in taken):
                taken.append(s)
        out += [(n, index.ids[p], *s, len(index.texts[p])) for s in sorted(taken)]
    return out


def _scan(shared):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in batches:
            lengths = np.array(pc.fill_null(pc.utf8_length(batch.column("_text")), 0))
            piece = np.cumsum(lengths) // SCAN_CHARS
            cuts = [0, *(np.flatnonzero(np.diff(piece)) + 1).tolist(), batch.num_rows]
            for start, stop in zip(cuts, cuts[1:]):
                part = batch.slice(start, stop - start)
                found = find_passages(part.column("_text").to_pylist(), index)
                if found:
                    rows = pa.array([f[0] for f in found], pa.int64())
                    columns = [pa.array(c, t) for c, t in zip(list(zip(*found))[1:], [pa.int64(), *[pa.int32()] * 4])]
                    keys = part.drop_columns(["_text"]).take(rows)
                    names = [*keys.schema.names, "item_id", "start", "end", "edits", "length"]
                    yield pa.RecordBatch.from_arrays([*keys.columns, *columns], names=names)

    return scan


def find_leaks(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per benchmark passage found in a document: ``key``, ``item_id, start, end, edits, length``.

    Documents are scanned whole, whatever their length; positions count characters of the normalised text. Null and
    empty texts hold nothing. Passages of under ``LEAST_CHARS`` normalised characters are found without edits, at word
    borders; those of under ``SHORT_CHARS`` or ``SHORT_WORDS`` words only where they are a whole document; those without
    a letter or digit, or null, nowhere. A passage of null id gives rows of null ``item_id``. Repeated documents and
    repeated passages each give their own rows; places of one passage that overlap are one, the closest and then the
    first. Only ``key`` of the other document columns is returned.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), F.col("text").alias("text"))
    chars = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    blocks = -(-chars // INDEX_CHARS) or 1
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    rows = docs.select(F.col(key).alias("_key"), F.col(text_col).alias("_text"))
    kind = rows.schema["_key"].dataType.simpleString()
    found = None
    for b in range(blocks):
        index = build_index([tuple(r) for r in items.where(block == b).orderBy("item_id", "text").collect()])
        if index is None:
            continue
        part = arrow_map(rows, _scan(spark.sparkContext.broadcast(index)), f"_key {kind}, {FOUND}")
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = rows.where(F.lit(False)).select("_key", *[F.lit(0).cast(k.split()[1]).alias(k.split()[0]) for k in FOUND.split(", ")])
    return found.withColumnRenamed("_key", key)


def drop_texts(docs: DataFrame, texts: DataFrame, key: str, text_col: str = "text") -> DataFrame:
    """``docs`` without rows whose text has its SHA-256 in ``texts[key]``; columns and other rows stay as they are."""
    bad = lookup_side(texts.select(F.col(key).alias("_bad")).distinct())
    return docs.join(bad, F.sha2(F.coalesce(text_col, F.lit("")), 256) == F.col("_bad"), "left_anti")


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` without the documents that hold a benchmark passage. Null ids and repeated rows are judged by text."""
    keyed = docs.select(F.sha2(F.coalesce(text_col, F.lit("")), 256).alias("_sha"), F.col(text_col).alias("text"))
    return drop_texts(docs, find_leaks(keyed, benchmark, "_sha"), "_sha", text_col)
