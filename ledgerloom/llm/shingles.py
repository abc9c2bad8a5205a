"""Word shingles of many texts at once, as hashes, and helpers to stream sorted groups through a task."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

WORDS = 5
# Texts are hashed together in stretches of about this many bytes.
STRETCH = 1_000_000
_BASE = np.uint64(0xD6E8FEB86659FD93)
_STEP = np.uint64(0xA0761D6478BD642F)
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_GAP = np.zeros(256, bool)
_GAP[[32, *range(9, 14)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
    up = np.full(n, _BASE, np.uint64)
    down = np.full(n, inverse, np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << max(21, (n - 1).bit_length())
    up, down = _powers(size)
    return up[:n], down[:n]


def shingle_sets(texts: Sequence[str | None]) -> list[np.ndarray]:
    """The distinct shingle hashes of each text, sorted. A text of one to four words has one shingle, none has none."""
    raw = [(t or "").encode("utf-8", "surrogatepass").lower() for t in texts]
    if not raw:
        return []
    data = np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)
    ends = np.cumsum([len(r) + 1 for r in raw], dtype=np.int64)
    gap = _GAP[data]
    edge = np.flatnonzero(np.diff(gap, prepend=True, append=True))
    first, last = edge[0::2], edge[1::2]
    up, down = powers(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:-1], out=total[1:])
    word = mix((total[last] - total[first]) * down[first] + (last - first).astype(np.uint64) * _STEP)
    bounds = np.searchsorted(first, np.concatenate([[0], ends]))
    five = np.zeros(max(len(word) - WORDS + 1, 0), np.uint64)
    for k in range(WORDS):
        five = five * _STEP + word[k : k + len(five)]
    five = mix(five)
    sets = []
    for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if hi - lo >= WORDS:
            sets.append(np.unique(five[lo : hi - WORDS + 1]))
        elif hi > lo:
            one = np.uint64(hi - lo)
            for w in word[lo:hi]:
                one = mix(np.array([one], np.uint64) * _STEP + w)[0]
            sets.append(np.array([one], np.uint64))
        else:
            sets.append(np.empty(0, np.uint64))
    return sets


def stretches(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """Cuts a batch so that each part holds about ``STRETCH`` bytes of the column; a row of more is a part by itself."""
    if not batch.num_rows:
        return
    size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(size, dtype=np.int64) // STRETCH
    alone = size > STRETCH
    cut = (part[1:] != part[:-1]) | alone[1:] | alone[:-1]
    cuts = [0, *(np.flatnonzero(cut) + 1).tolist(), batch.num_rows]
    for start, stop in zip(cuts, cuts[1:]):
        yield batch.slice(start, stop - start)


def runs(batches: Iterable[pa.RecordBatch], keys: Sequence[str]) -> Iterator[tuple[bool, pa.RecordBatch]]:
    """Cuts sorted batches where a key changes. Each part comes with whether it opens a new key."""
    before: tuple | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        change = np.zeros(batch.num_rows, bool)
        for key in keys:
            values = batch.column(key).to_numpy(zero_copy_only=False)
            change[1:] |= values[1:] != values[:-1]
        cuts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for start, stop in zip(cuts, cuts[1:]):
            now = tuple(batch.column(key)[start].as_py() for key in keys)
            yield now != before, batch.slice(start, stop - start)
            before = now


def groups(batches: Iterable[pa.RecordBatch], keys: Sequence[str]) -> Iterator[pa.Table]:
    """Whole groups of sorted batches, for groups of bounded size."""
    held: list[pa.RecordBatch] = []
    for opens, part in runs(batches, keys):
        if opens and held:
            yield pa.Table.from_batches(held)
            held = []
        held.append(part)
    if held:
        yield pa.Table.from_batches(held)
