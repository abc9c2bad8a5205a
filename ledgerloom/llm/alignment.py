"""Alignment of the tokens of two tokenizers by interval coalescing.

Both token sequences of a text tile the same bytes. All tokens of both are sorted by start; where a start reaches the
running maximum of the ends, no token of either side crosses, and a group ends. Within a group every token is expanded
to the tokens of the other side whose byte range it overlaps; each such pair of occurrences is a link.

Texts are tokenized once. Per document the distinct id pairs and how often they are linked are stored; the corpus-wide
count of a pair (documents that hold it) is added up within tasks before it is shuffled. The counts go back to the
documents in slices of bounded size, one slice per pass over the stored pairs, so no table of pairs need fit anywhere.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.shingles import stretches
from ledgerloom.llm.workers import arrow_map
from ledgerloom.runtime import durable

# Pattern that cuts texts before the byte merges, for vocabulary files that name none (fixed value).
BYTE_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# Pair counts that travel to the tasks at once: 24 bytes each.
SLICE_PAIRS = 2_000_000
# Stored pairs that one step of a task looks up at once.
_LOOKUP = 2_000_000

ALIGNED = (
    "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups string, "
    "pairs array<bigint>, times array<int>"
)


@dataclass(frozen=True)
class Tokenizers:
    """Names of two vocabulary files that ``ship`` has added to the session's files."""

    byte_bpe: str
    pieces: str
    pattern: str = BYTE_PATTERN


def ship(spark: SparkSession, byte_bpe: str, pieces: str) -> Tokenizers:
    """Adds a byte-level merge vocabulary (JSON) and a piece model to the files every executor fetches."""
    for path in (byte_bpe, pieces):
        spark.sparkContext.addFile(path)
    return Tokenizers(byte_bpe.rsplit("/", 1)[-1], pieces.rsplit("/", 1)[-1])


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: printable Latin-1 letters stand for themselves,
    the other bytes for the letters from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class Pair:
    """Both tokenizers, loaded: ids of texts, and the bytes of every id."""

    def __init__(self, byte_bpe: str, pieces: str, pattern: str):
        with open(byte_bpe, encoding="utf-8") as file:
            model = json.load(file)["model"]
        letters = _byte_letters()
        ranks = {bytes(letters[c] for c in token): i for token, i in model["vocab"].items()}
        merged = [model["vocab"]["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
        if merged != sorted(merged):
            raise ValueError("ids of the byte vocabulary do not follow its merges")
        self.bytes_bpe = tiktoken.Encoding("bytes", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=pieces)
        self.of_a = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            self.of_a[i] = token
        self.of_b = []
        for i in range(self.pieces.get_piece_size()):
            piece = self.pieces.id_to_piece(i)
            is_byte = self.pieces.is_byte(i)
            self.of_b.append(bytes([int(piece[3:5], 16)]) if is_byte else piece.replace("▁", " ").encode())
        self.size_a = np.array([len(t) for t in self.of_a], np.int64)
        self.size_b = np.array([len(t) for t in self.of_b], np.int64)
        names = max(len(self.of_a), len(self.of_b))
        self.written = np.array([f"{i}{end}" for end in ",|;" for i in range(names)] + [str(i) for i in range(names)], object)
        self.names = names

    def encode(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        a = [self.bytes_bpe.encode_ordinary(" " + t) for t in texts]
        return a, self.pieces.encode(texts, num_threads=1)


@lru_cache(maxsize=2)
def _load(tokenizers: Tokenizers) -> Pair:
    return Pair(SparkFiles.get(tokenizers.byte_bpe), SparkFiles.get(tokenizers.pieces), tokenizers.pattern)


def _flat(lists: list[list[int]]) -> np.ndarray:
    return np.fromiter((i for x in lists for i in x), np.int64, sum(map(len, lists)))


def coalesce(size_a: np.ndarray, size_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Group of each A token, group of each B token, and the linked token numbers (A, B), for two sequences of token
    sizes, all above 0 and equal in sum."""
    end_a, end_b = np.cumsum(size_a), np.cumsum(size_b)
    start_a, start_b = end_a - size_a, end_b - size_b
    n = len(size_a)
    starts, ends = np.concatenate([start_a, start_b]), np.concatenate([end_a, end_b])
    order = np.lexsort((starts,))
    reach = np.maximum.accumulate(ends[order])
    breaks = np.zeros(len(order), np.int64)
    breaks[1:] = starts[order][1:] >= reach[:-1]
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(breaks)
    # An A token overlaps the B tokens from the first that ends after its start to the last that starts before its end.
    low = np.searchsorted(end_b, start_a, "right")
    many = np.searchsorted(start_b, end_a, "left") - low
    left = np.repeat(np.arange(n), many)
    first = np.cumsum(many) - many
    right = np.arange(len(left)) - np.repeat(first - low, many)
    return group[:n], group[n:], left, right


def _written(pair: Pair, a: np.ndarray, b: np.ndarray, group_a: np.ndarray, group_b: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Every token as text with the sign that follows it, groups in order, A before B. ``last``: last groups of texts."""
    n_groups = int(group_a[-1]) + 1
    count_a, count_b = np.bincount(group_a, minlength=n_groups), np.bincount(group_b, minlength=n_groups)
    before_b = np.cumsum(count_b) - count_b
    through_a = np.cumsum(count_a)
    at_a = np.arange(len(a)) + before_b[group_a]
    at_b = np.arange(len(b)) + through_a[group_b]
    sign = np.zeros(len(a) + len(b), np.int64)
    ids = np.empty(len(sign), np.int64)
    ids[at_a], ids[at_b] = a, b
    sign[at_a[through_a - 1]] = 1
    closing = at_b[np.cumsum(count_b) - 1]
    sign[closing] = 2
    sign[closing[last]] = 3
    return pair.written[sign * pair.names + ids]


def align_texts(pair: Pair, texts: list[str | None], digest: bool) -> dict[str, list | np.ndarray]:
    """Counts, groups as text (or its SHA-256) and distinct linked pairs of each text."""
    a, b = pair.encode([t or "" for t in texts])
    whole = np.zeros(len(texts), bool)
    for i, t in enumerate(texts):
        if t:
            raw = b" " + t.encode("utf-8", "surrogatepass")
            whole[i] = b"".join(map(pair.of_a.__getitem__, a[i])) == raw and b"".join(map(pair.of_b.__getitem__, b[i])) == raw
    kept = np.flatnonzero(whole)
    n = len(texts)
    out = {k: np.zeros(n, np.int64) for k in ("n_a", "n_b", "n_groups", "n_links")}
    out |= {"groups": [""] * n, "pairs": np.empty(0, np.int64), "times": np.empty(0, np.int32), "n_pairs": np.zeros(n, np.int64)}
    if not len(kept):
        return out
    a, b = [a[i] for i in kept], [b[i] for i in kept]
    n_a, n_b = np.array([len(x) for x in a]), np.array([len(x) for x in b])
    flat_a, flat_b = _flat(a), _flat(b)
    group_a, group_b, left, right = coalesce(pair.size_a[flat_a], pair.size_b[flat_b])
    end_a = np.cumsum(n_a)
    last = group_a[end_a - 1]
    written = _written(pair, flat_a, flat_b, group_a, group_b, last)
    ends = np.cumsum(n_a + n_b)
    for i, start, end in zip(kept.tolist(), (ends - n_a - n_b).tolist(), ends.tolist()):
        text = "".join(written[start:end])
        out["groups"][i] = hashlib.sha256(text.encode()).hexdigest() if digest else text
    doc = np.repeat(np.arange(len(kept)), n_a)[left]
    base = len(pair.of_a) * len(pair.of_b)
    keys, times = np.unique(doc * base + flat_a[left] * len(pair.of_b) + flat_b[right], return_counts=True)
    out["n_a"][kept], out["n_b"][kept] = n_a, n_b
    out["n_groups"][kept] = np.diff(last, prepend=-1)
    out["n_links"][kept] = np.bincount(doc, minlength=len(kept))
    out["n_pairs"][kept] = np.bincount(keys // base, minlength=len(kept))
    return out | {"pairs": keys % base, "times": times.astype(np.int32)}


def _lists(flat: pa.Array, sizes: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), flat)


def _aligner(tokenizers: Tokenizers, digest: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = _load(tokenizers)
        for batch in batches:
            for part in stretches(batch, "text"):
                x = align_texts(pair, part.column("text").to_pylist(), digest)
                columns = [part.column("doc_id"), *(pa.array(x[k]) for k in ("n_a", "n_b", "n_groups", "n_links"))]
                columns += [pa.array(x["groups"], pa.string()), *(_lists(pa.array(x[k]), x["n_pairs"]) for k in ("pairs", "times"))]
                names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "pairs", "times"]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def aligned(docs: DataFrame, tokenizers: Tokenizers, id_col: str = "doc_id", text_col: str = "text", digest: bool = False) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, groups, pairs, times`` of every row of ``docs``; other columns are left out.

    ``groups`` is the alignment as text, ``a1,a2|b1;a3|b2,b3`` (with ``digest`` its SHA-256); ``pairs`` are the distinct
    linked pairs as ``A id * number of B ids + B id``, ``times`` how often each is linked. A text that is null, empty or
    not given back byte by byte by both tokenizers has no tokens: zeros, an empty string and no pairs. Repeated rows
    and rows of null id are judged one by one; an empty table gives no rows. A text of any length is aligned whole, by
    one task, in memory in proportion to that text.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return arrow_map(rows, _aligner(tokenizers, digest), ALIGNED)


def _parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Parts of at most about ``_LOOKUP`` stored pairs; a row of more is a part by itself."""
    sizes = np.diff(batch.column("pairs").offsets.to_numpy())
    part = np.cumsum(sizes, dtype=np.int64) // _LOOKUP
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for start, stop in zip(cuts, cuts[1:]):
        if stop > start:
            yield batch.slice(start, stop - start)


def _held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number of documents of each pair within a part."""
    for batch in batches:
        for part in _parts(batch):
            keys, n = np.unique(part.column("pairs").flatten().to_numpy(), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n)], names=["pair", "n"])


def pair_counts(stored: DataFrame, size_b: int) -> DataFrame:
    """``pair, n, best``: documents that hold the pair linked, and whether no pair of the same A id has more."""
    counts = durable(arrow_map(stored.select("pairs"), _held, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n")))
    own = F.expr(f"pair div {size_b}")
    most = counts.groupBy(own.alias("a")).agg(F.max("n").alias("most"))
    joined = counts.withColumn("a", own).join(most, "a")
    return durable(joined.select("pair", "n", (F.col("n") == F.col("most")).alias("best")))


def _adder(slice_table):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, best = slice_table.value
        for batch in batches:
            for part in _parts(batch):
                pairs, times = (part.column(k).flatten().to_numpy() for k in ("pairs", "times"))
                sizes = np.diff(part.column("pairs").offsets.to_numpy())
                at = np.minimum(np.searchsorted(keys, pairs), max(len(keys) - 1, 0))
                found = keys[at] == pairs if len(keys) else np.zeros(len(pairs), bool)
                sums = np.zeros((2, len(pairs) + 1), np.int64)
                if len(keys):
                    np.cumsum(np.where(found, counts[at] * times, 0), out=sums[0, 1:])
                    np.cumsum(np.where(found & best[at], times, 0), out=sums[1, 1:])
                ends = np.cumsum(sizes)
                total, top = sums[:, ends] - sums[:, ends - sizes]
                kept = part.drop_columns(["pairs", "times"])
                yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(top), pa.array(total)], names=[*kept.schema.names, "n_best", "count_sum"])

    return run


def align_corpus(
    docs: DataFrame, tokenizers: Tokenizers, size_b: int, id_col: str = "doc_id", text_col: str = "text", digest: bool = False
) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, groups, n_best, count_sum`` of every row of ``docs``.

    ``count_sum`` adds, over a document's links, the number of documents that hold the same id pair linked; ``n_best``
    counts links whose pair has the highest such number of its A id, ties included. Rows are documents: repeated rows
    count each. ``size_b`` is the number of B ids. Nulls, empty and long texts as in ``aligned``.
    """
    spark = docs.sparkSession
    rows = aligned(docs, tokenizers, id_col, text_col, digest).withColumn("row", F.monotonically_increasing_id())
    stored = durable(rows)
    counts = pair_counts(stored, size_b)
    slices = max(1, -(-counts.count() // SLICE_PAIRS))
    counts = counts.withColumn("slice", F.pmod(F.xxhash64("pair"), F.lit(slices)))
    plain = [c for c in stored.columns if c not in ("pairs", "times", "row")]
    kept = [*plain, "pairs", "times"] if slices == 1 else ["row", "pairs", "times"]
    kinds = {f.name: f.dataType.simpleString() for f in stored.schema.fields}
    schema = ", ".join(f"{c} {kinds[c]}" for c in kept if c not in ("pairs", "times")) + ", n_best bigint, count_sum bigint"
    sums = None
    for i in range(slices):
        table = counts.where(F.col("slice") == i).drop("slice").orderBy("pair").toArrow()
        arrays = tuple(table.column(c).to_numpy() for c in ("pair", "n", "best"))
        part = arrow_map(stored.select(*kept), _adder(spark.sparkContext.broadcast(arrays)), schema)
        sums = part if sums is None else sums.unionByName(part)
    if slices == 1:
        return sums
    total = sums.groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    return stored.select("row", *plain).join(total, "row").drop("row")


def number_of_pieces(path: str) -> int:
    return sentencepiece.SentencePieceProcessor(model_file=path).get_piece_size()
