"""Ranked lexical search: top documents of many items, by buckets of vector length.

A document is a vector of impacts over the items' terms, and an item's score is an inner product with its term weights.
Vectors are sorted by length and dealt to ranges of length. The longest of all documents are scored first and give each
item a score that its last place must reach. Then, bucket by bucket in falling length, an item skips a bucket whose
greatest length cannot reach that score (Cauchy-Schwarz); within a bucket the coordinates of the item's heaviest
terms are multiplied out, and the rest is bounded by the lengths that are left and by the bucket's greatest impact of
each light term; only survivors are scored in full, in 64-bit integers. Every document is scored or ruled out by a bound; nothing is sampled or capped.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.columns import lower_ascii
from ledgerloom.llm.shingles import STRETCH, mix, powers, stretches
from ledgerloom.llm.workers import arrow_map
from ledgerloom.runtime import durable

# Terms are the runs of all characters but these (fixed value).
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
# Item terms that travel to the tasks at once; further items take a further scan of the documents.
CHUNK_TERMS = 400_000
# Documents of a bucket, and heaviest terms of an item that bound its scores.
BUCKET, FOCUS = 512, 24
# Share of the documents, the longest, that are scored first, and their least number.
FIRST, FIRST_ROWS = 0.02, 1000
# Candidate scores that a task holds before it keeps the best of each item.
_HELD = 100_000
# Coordinates looked up at once when survivors are scored.
_LOOKUP = 4_000_000
_STEP = np.uint64(0x9FB21C651E98DF25)
_IN_TERM = np.ones(256, bool)
_IN_TERM[[*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = False


def spans(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First and last byte position of every term in the texts joined by zero bytes, its hash, and the joined bytes."""
    data = np.frombuffer(b"\0".join(raw) + b"\0", np.uint8)
    edge = np.flatnonzero(np.diff(_IN_TERM[data], prepend=False, append=False))
    first, last = edge[0::2], edge[1::2]
    up, down = powers(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:-1], out=total[1:])
    hashes = mix((total[last] - total[first]) * down[first] + (last - first).astype(np.uint64) * _STEP)
    return first, last, hashes, data


class Vocabulary:
    """Terms by number, found by hash and confirmed byte by byte."""

    def __init__(self, terms: list[bytes]):
        self.terms = terms
        hashes = spans(terms)[2] if terms else np.empty(0, np.uint64)
        self.order = np.argsort(hashes, kind="stable")
        self.hashes = hashes[self.order]
        self.sizes = np.array([len(t) for t in terms], np.int64)
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[(hashes & np.uint64((1 << 20) - 1)).astype(np.int64)] = True
        self.bytes = np.frombuffer(b"".join(terms), np.uint8)
        self.starts = np.cumsum(self.sizes) - self.sizes

    def find(self, first: np.ndarray, last: np.ndarray, hashes: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions within ``first`` of known terms, and their numbers."""
        at = np.flatnonzero(self.maybe[(hashes & np.uint64((1 << 20) - 1)).astype(np.int64)])
        place = np.searchsorted(self.hashes, hashes[at])
        held = place < len(self.hashes)
        at, place = at[held], place[held]
        # Terms of one hash stand side by side; each is compared.
        number, where = [], []
        while len(at):
            same = self.hashes[place] == hashes[at]
            at, place = at[same], place[same]
            term = self.order[place]
            sized = self.sizes[term] == (last - first)[at]
            fits = np.zeros(len(at), bool)
            for size in np.unique(self.sizes[term[sized]]):
                rows = np.flatnonzero(sized & (self.sizes[term] == size))
                step = np.arange(size)
                for k in range(0, len(rows), 100_000):
                    some = rows[k : k + 100_000]
                    fits[some] = (data[first[at[some]][:, None] + step] == self.bytes[self.starts[term[some]][:, None] + step]).all(axis=1)
            number.append(term[fits])
            where.append(at[fits])
            more = ~fits & (place + 1 < len(self.hashes))
            at, place = at[more], place[more] + 1
        return (np.concatenate(where), np.concatenate(number)) if where else (np.empty(0, np.int64),) * 2


def _pieces(raw: bytes) -> list[bytes]:
    """A long text cut at signs between terms into pieces of about ``STRETCH`` bytes."""
    pieces, start = [], 0
    while len(raw) - start > STRETCH:
        end = start + STRETCH
        while end < len(raw) and _IN_TERM[raw[end]]:
            end += 1
        pieces.append(raw[start:end])
        start = end
    return [*pieces, raw[start:]]


def count_terms(vocabulary: Vocabulary, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Terms per text with repeats; and the (text, term, times) of known terms, sorted."""
    raw, owner = [], []
    for i, t in enumerate(texts):
        for piece in _pieces((t or "").encode("utf-8", "surrogatepass").lower()):
            raw.append(piece)
            owner.append(i)
    n = np.zeros(len(texts), np.int64)
    owner, keys = np.asarray(owner), []
    # Short texts go together, pieces of a long one by themselves.
    together = len(raw) if sum(map(len, raw)) <= 2 * STRETCH else 1
    for start in range(0, len(raw), together):
        some = raw[start : start + together]
        first, last, hashes, data = spans(some)
        text = owner[start + np.searchsorted(np.cumsum([len(r) + 1 for r in some]), first, "right")]
        n += np.bincount(text, minlength=len(texts))
        at, term = vocabulary.find(first, last, hashes, data)
        keys.append(text[at] * max(len(vocabulary.terms), 1) + term)
    keys, times = np.unique(np.concatenate(keys), return_counts=True)
    return n, keys // max(len(vocabulary.terms), 1), keys % max(len(vocabulary.terms), 1), times


def _lists(values: np.ndarray, rows: np.ndarray, n: int, kind: pa.DataType) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=n))])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, kind))


def _scanned(vocabulary):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in stretches(batch, "text"):
                n, rows, terms, times = count_terms(vocabulary.value, part.column("text").to_pylist())
                columns = [part.column("doc_id"), pa.array(n), _lists(terms, rows, len(n), pa.int32()), _lists(times, rows, len(n), pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "terms", "times"])

    return run


@dataclass
class Items:
    """Terms and weights of a chunk of items. ``first[i]:first[i + 1]`` are the terms of item ``i``."""

    numbers: np.ndarray
    first: np.ndarray
    terms: np.ndarray
    weights: np.ndarray
    n_terms: int

    def __post_init__(self):
        items = len(self.numbers)
        sizes = np.diff(self.first)
        own = np.repeat(np.arange(items), sizes)
        weight = self.weights[self.terms].astype(float)
        self.length = np.sqrt(np.bincount(own, weight, items))
        rank = np.empty(len(own), np.int64)
        order = np.lexsort((-weight, own))
        rank[order] = np.arange(len(own)) - np.repeat(self.first[:-1], sizes)
        focus = rank < FOCUS
        self.rest = np.sqrt(np.bincount(own[~focus], weight[~focus], items))
        self.light_items, self.light_terms, self.light_weights = own[~focus], self.terms[~focus], weight[~focus]
        # Items by focus term.
        by_term = np.argsort(self.terms[focus], kind="stable")
        self.focus_items = own[focus][by_term]
        counts = np.bincount(self.terms[focus], minlength=self.n_terms)
        self.focus_first = np.concatenate([[0], np.cumsum(counts)])


def _spread(starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For ranges ``starts, sizes``: the number of the range and the member, range after range."""
    own = np.repeat(np.arange(len(sizes)), sizes)
    return own, np.arange(len(own)) - np.repeat(np.cumsum(sizes) - sizes - starts, sizes)


def bucket_scores(items: Items, rows: np.ndarray, terms: np.ndarray, impacts: np.ndarray, lengths: np.ndarray, least: np.ndarray):
    """``(row, item, score)`` of all pairs of a bucket whose score can reach ``least[item]``; pairs below may be left out."""
    open_items = np.flatnonzero((items.length > 0) & (items.length * lengths.max() * (1 + 1e-9) >= least))
    if not len(open_items):
        return (np.empty(0, np.int64),) * 3
    slot = np.full(len(items.numbers), -1)
    slot[open_items] = np.arange(len(open_items))
    sizes = np.diff(items.focus_first)[terms]
    posting, member = _spread(items.focus_first[terms], sizes)
    item = slot[items.focus_items[member]]
    posting, item = posting[item >= 0], item[item >= 0]
    weight = items.weights[terms[posting]].astype(float)
    cell = rows[posting] * len(open_items) + item
    shape = (len(lengths), len(open_items))
    value = weight * impacts[posting]
    product = np.bincount(cell, value, shape[0] * shape[1]).reshape(shape)
    used = np.bincount(cell, value * impacts[posting], shape[0] * shape[1]).reshape(shape)
    left = np.sqrt(np.maximum(np.square(lengths)[:, None] - used, 0))
    highest = np.zeros(items.n_terms)
    np.maximum.at(highest, terms, impacts)
    light = np.bincount(items.light_items, items.light_weights * highest[items.light_terms], len(items.numbers))
    # What rounding may have taken from the difference is added to the bound.
    rest = np.minimum(items.rest[open_items] * (left + 1e-7 * lengths[:, None]), light[open_items])
    bound = (product + rest) * (1 + 1e-9)
    row, at = np.nonzero(bound >= np.maximum(least[open_items], 1))
    return row, open_items[at], exact_scores(items, rows, terms, impacts, row, open_items[at])


def exact_scores(items: Items, rows, terms, impacts, row, item) -> np.ndarray:
    """Scores of pairs, in integers. ``rows, terms`` are sorted and hold each coordinate once."""
    keys = rows * items.n_terms + terms
    scores = np.zeros(len(row), np.int64)
    sizes = np.diff(items.first)[item]
    part = np.cumsum(sizes) // _LOOKUP
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(row)]
    for start, stop in zip(cuts, cuts[1:]):
        if stop == start or not len(keys):
            continue
        pair, member = _spread(items.first[item[start:stop]], sizes[start:stop])
        term = items.terms[member]
        wanted = row[start:stop][pair] * items.n_terms + term
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        hit = keys[at] == wanted
        ends = np.concatenate([[0], np.cumsum(sizes[start:stop])])
        value = np.concatenate([[0], np.cumsum(np.where(hit, items.weights[term] * impacts[at], 0))])
        scores[start:stop] = value[ends[1:]] - value[ends[:-1]]
    return scores


def _best(item: np.ndarray, score: np.ndarray, doc: np.ndarray, known: np.ndarray, top: int) -> np.ndarray:
    """Positions of the ``top`` best of each item; equal scores by document id, rows without id last."""
    order = np.lexsort((doc, ~known, -score, item))
    opens = np.flatnonzero(np.diff(item[order], prepend=-1))
    place = np.arange(len(order)) - np.repeat(opens, np.diff(np.append(opens, len(order))))
    return order[place < top]


def _ranked(items_held, least_held, top: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, least = items_held.value, least_held.value.copy()
        held = [np.empty(0, np.int64)] * 3 + [np.empty(0, bool)]
        fresh: list[tuple] = []
        waiting = 0

        def keep() -> None:
            nonlocal held, fresh, waiting
            held = [np.concatenate(x) for x in zip(held, *fresh)]
            kept = _best(*held, top)
            held = [x[kept] for x in held]
            fresh, waiting = [], 0
            full = np.flatnonzero(np.bincount(held[0], minlength=len(least)) >= top)
            if len(full):
                last = np.full(len(least), np.iinfo(np.int64).max)
                np.minimum.at(last, held[0], held[1])
                least[full] = np.maximum(least[full], last[full])

        for batch in batches:
            for start in range(0, batch.num_rows, BUCKET):
                part = batch.slice(start, BUCKET)
                sizes = np.diff(part.column("terms").offsets.to_numpy())
                rows = np.repeat(np.arange(len(sizes)), sizes)
                terms, impacts = (part.column(c).flatten().to_numpy().astype(np.int64) for c in ("terms", "impacts"))
                lengths = part.column("length").to_numpy()
                row, item, score = bucket_scores(items, rows, terms, impacts, lengths, least)
                good = (score > 0) & (score >= least[item])
                ids = part.column("doc_id")
                known = np.asarray(ids.is_valid())
                doc = ids.fill_null(0).to_numpy()
                fresh.append((item[good], score[good], doc[row[good]], known[row[good]]))
                waiting += int(good.sum())
                if waiting > max(_HELD, 2 * top * len(least)) or not len(held[0]):
                    keep()
        keep()
        item, score, doc, known = held
        columns = [pa.array(items.numbers[item]), pa.array(doc, pa.int64(), mask=~known), pa.array(score)]
        yield pa.RecordBatch.from_arrays(columns, names=["item", "doc_id", "score"])

    return run


def _weighted(n_docs: int, n_terms: int, weights):
    """Impacts and the length over the items' terms of every document that has one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.diff(batch.column("terms").offsets.to_numpy())
            terms, times = (batch.column(c).flatten().to_numpy().astype(np.int64) for c in ("terms", "times"))
            size = 50 + (50 * batch.column("n").to_numpy() * n_docs) // n_terms
            impacts = (1_000_000_000 * times) // (1000 * times + 20 * np.repeat(size, sizes))
            rows = np.repeat(np.arange(len(sizes)), sizes)
            length = np.sqrt(np.bincount(rows, weights.value[terms] * np.square(impacts.astype(float)), len(sizes)))
            columns = [
                batch.column("doc_id"), pa.array(length), _lists(terms, rows, len(sizes), pa.int32()),
                _lists(impacts, rows, len(sizes), pa.int32()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "length", "terms", "impacts"])

    return run


def _top(found: DataFrame, top: int) -> DataFrame:
    place = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= top)


def _rank_chunk(docs: DataFrame, chunk: pa.Table, top: int) -> DataFrame | None:
    spark = docs.sparkSession
    terms = chunk.column("terms").combine_chunks()
    encoded = terms.flatten().dictionary_encode()
    vocabulary = Vocabulary([t.encode("utf-8", "surrogatepass") for t in encoded.dictionary.to_pylist()])
    schema = "doc_id bigint, n bigint, terms array<int>, times array<bigint>"
    stored = durable(arrow_map(docs, _scanned(spark.sparkContext.broadcast(vocabulary)), schema))
    n_docs, n_terms = stored.where("n > 0").agg(F.count("*"), F.sum("n")).first()
    if not n_docs:
        return None
    held = stored.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df")).toArrow()
    df = np.zeros(len(vocabulary.terms), np.int64)
    df[held.column("term").to_numpy()] = held.column("df").to_numpy()
    weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)
    first = terms.offsets.to_numpy().astype(np.int64)
    numbers = encoded.indices.to_numpy().astype(np.int64)
    items = Items(chunk.column("item").to_numpy(), first - first[0], numbers, weights, len(weights))
    weigh = _weighted(n_docs, n_terms, spark.sparkContext.broadcast(weights))
    vectors = arrow_map(stored.where("size(terms) > 0"), weigh, "doc_id bigint, length double, terms array<int>, impacts array<int>")
    longest_first = F.col("length").desc()
    vectors = durable(vectors.repartitionByRange(longest_first).sortWithinPartitions(longest_first))
    share = min(1.0, max(FIRST, FIRST_ROWS / n_docs))
    border = vectors.approxQuantile("length", [1 - share], 0.005)
    border = border[0] if border else 0.0
    items_held = spark.sparkContext.broadcast(items)
    found_schema = "item bigint, doc_id bigint, score bigint"

    def search(rows: DataFrame, least: np.ndarray) -> DataFrame:
        return arrow_map(rows, _ranked(items_held, spark.sparkContext.broadcast(least), top), found_schema)

    least = np.zeros(len(items.numbers), np.int64)
    early = durable(_top(search(vectors.where(F.col("length") >= border), least), top).select("item", "doc_id", "score", "rank"))
    last = early.where(F.col("rank") == top).select("item", "score").toArrow()
    at = {n: i for i, n in enumerate(items.numbers.tolist())}
    for number, score in zip(last.column("item").to_pylist(), last.column("score").to_pylist()):
        least[at[number]] = score
    return early.select("item", "doc_id", "score").unionByName(search(vectors.where(F.col("length") < border), least))


def rank(
    docs: DataFrame, items: DataFrame, top: int = 50, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``top`` documents of each item by descending score, then ascending id.

    Every row of ``docs`` is a document of its own, so a repeated row can take two places; rows of null id rank after
    those of equal score. Null and empty texts hold no terms. Item rows of equal id and text are one; rows of one id
    with different texts are ranked one by one. Items without terms, or with no document scoring above 0, have no
    rows, and so do empty tables. Texts of any length are read whole, in pieces; other columns are left out.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    asked = items.select(F.col(item_col).alias("item_id"), F.coalesce(F.col(item_text_col), F.lit("")).alias("text")).distinct()
    terms = F.array_distinct(F.regexp_extract_all(lower_ascii(F.col("text")), F.lit(TERM), F.lit(0)))
    asked = asked.select("item_id", terms.alias("terms")).where("size(terms) > 0")
    asked = durable(asked.withColumn("item", F.monotonically_increasing_id()))
    total = asked.agg(F.sum(F.size("terms"))).first()[0] or 0
    chunks = -(-total // CHUNK_TERMS)
    found = None
    for i in range(chunks):
        own = F.pmod(F.xxhash64("item"), F.lit(chunks)) == i
        chunk = asked.where(own).select("item", "terms").toArrow()
        part = _rank_chunk(docs, chunk, top) if chunk.num_rows else None
        if part is not None:
            found = part if found is None else found.unionByName(part)
    if found is None:
        found = spark.createDataFrame([], "item bigint, doc_id bigint, score bigint")
    return _top(found, top).join(asked.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")
