"""Burrows-Wheeler transform of a short byte text, and its repeats of a fixed length by interval expansion."""

from __future__ import annotations

import numpy as np

# Closes every string of a text; no UTF-8 text holds this byte.
END = 0xFF


def suffix_order(data: np.ndarray, depth: int) -> np.ndarray:
    """Positions sorted by at least the ``depth`` bytes from each of them (prefix doubling from eight bytes)."""
    n = len(data)
    padded = np.concatenate([data, np.full(8, END, np.uint8)])
    packed = np.zeros(n, np.uint64)
    for k in range(8):
        packed = packed << np.uint64(8) | padded[k : k + n]
    order = np.argsort(packed)
    rank = _ranks(packed[order], order)
    have = 8
    while have < depth and int(rank.max(initial=0)) < n - 1:
        after = np.zeros(n, np.int64)
        after[: max(n - have, 0)] = rank[have:] + 1
        key = rank * np.int64(n + 1) + after
        order = np.argsort(key)
        rank = _ranks(key[order], order)
        have *= 2
    return order


def _ranks(in_order: np.ndarray, order: np.ndarray) -> np.ndarray:
    rank = np.empty(len(order), np.int64)
    rank[order] = np.concatenate([[0], np.cumsum(in_order[1:] != in_order[:-1])]) if len(order) else order
    return rank


def prefix_classes(data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffix order and, per rank, a class: neighbours share a class if they agree on ``length`` bytes.

    Common prefixes of neighbouring suffixes are found in increasing order. An interval holds the suffixes that begin
    with one string; prepending each byte seen in its stretch of the transform gives intervals of strings one byte
    longer. The rank after a new interval is where a common prefix of the old length ends; a border already known needs
    no further visit. Borders not found before ``length`` have common prefixes of at least that.
    """
    n = len(data)
    order = suffix_order(data, length + 8)
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    first_byte, transform, step = data[order], data[order - 1], place[order - 1]
    border = np.zeros(n + 1, bool)
    border[[0, n]] = True
    owner_of = np.empty(n, np.int32)
    low, high = np.array([0], np.int64), np.array([n], np.int64)
    for _ in range(length):
        if not len(low):
            break
        size = high - low
        total = int(size.sum())
        at = np.arange(total) + np.repeat(low - (np.cumsum(size) - size), size)
        # Strings do not reach over the end of another.
        inner = transform[at] != END
        ranks = step[at[inner]]
        if not len(ranks):
            break
        owner_of[ranks] = np.repeat(np.arange(len(low), dtype=np.int32), size)[inner]
        if len(ranks) * 8 > n:
            seen = np.zeros(n, bool)
            seen[ranks] = True
            ranks = np.flatnonzero(seen)
        else:
            ranks = np.sort(ranks)
        # Prepending one byte to one string gives neighbouring ranks.
        owner, byte = owner_of[ranks], first_byte[ranks]
        opens = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (byte[1:] != byte[:-1])]))
        first, last = ranks[opens], ranks[np.append(opens[1:], len(ranks)) - 1] + 1
        new = ~border[last]
        border[last] = True
        low, high = first[new], last[new]
    return order, np.cumsum(border[:-1])
