"""Ranked search, against a plain score of every document for every item."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from ledgerloom.llm import ranking
from ledgerloom.llm.ranking import Vocabulary, count_terms, rank

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(UPPER))


def plain(docs, items, top):
    bags = [(i, Counter(plain_terms(t))) for i, t in docs]
    sizes = [sum(b.values()) for _, b in bags]
    n, total = sum(s > 0 for s in sizes), sum(sizes)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in {(i, t or "") for i, t in items}:
        found = []
        for (doc, bag), size in zip(bags, sizes):
            score = 0
            for t in set(plain_terms(text)) & bag.keys():
                m = 100 - 50 + (50 * size * n) // total
                w = math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                score += w * ((1000000000 * bag[t]) // (1000 * bag[t] + 20 * m))
            if score > 0:
                found.append((-score, doc is None, doc or 0, doc))
        found.sort(key=lambda x: x[:3])
        out += [(item, k + 1, x[3], -x[0]) for k, x in enumerate(found[:top])]
    return sorted(out, key=str)


def tables():
    r = random.Random(11)
    words = ["".join(r.choices("abcdeé", k=r.randint(1, 4))) for _ in range(160)]
    weights = [1 / (k + 1) for k in range(len(words))]

    def text(n):
        return "".join(r.choice([w, w.upper()]) + r.choice([" ", ", ", "\n", "-", "\x00"]) for w in r.choices(words, weights, k=n))

    docs = [(i * 2, text(r.choice([3, 20, 20, 90]))) for i in range(260)]
    docs += [(k, docs[7][1]) for k in (901, 900, 903)] + [docs[9], docs[9], (None, docs[9][1]), (950, None), (951, ""), (952, " .,-")]
    docs += [(960, text(30000)), (961, "Ünïcode ÀB 12 3x 你好 naïve")]
    r.shuffle(docs)
    items = [(i, text(r.choice([1, 4, 12]))) for i in range(30)] + [(3, "zz unseen"), (5, docs[0][1]), (5, docs[0][1]), (None, words[0])]
    items += [(40, None), (41, ""), (42, "!!"), (43, "ÀB 你好 12 NAÏVE"), (44, "Àb")]
    return docs, items


@pytest.mark.parametrize("bucket, focus, first_rows, chunk, top", [(512, 8, 1000, 400_000, 50), (8, 2, 20, 60, 5), (16, 1, 60, 400_000, 20)])
def test_like_scoring_all(spark, monkeypatch, bucket, focus, first_rows, chunk, top):
    for name, value in (("BUCKET", bucket), ("FOCUS", focus), ("FIRST_ROWS", first_rows), ("CHUNK_TERMS", chunk), ("STRETCH", 20_000)):
        monkeypatch.setattr(ranking, name, value)
    docs, items = tables()
    left = spark.createDataFrame(docs, "doc_id bigint, text string").selectExpr("*", "'x' AS terms", "1 AS item", "2 AS score")
    right = spark.createDataFrame(items, "item_id bigint, text string").selectExpr("*", "'x' AS doc_id", "0 AS rank")
    out = rank(left.repartition(4), right, top)
    assert out.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted((tuple(r) for r in out.collect()), key=str) == plain(docs, items, top)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id bigint, text string")
    items = spark.createDataFrame([(1, "a")], "item_id bigint, text string")
    assert rank(docs.limit(0), items).count() == 0 and rank(docs, items.limit(0)).count() == 0
    assert rank(docs.where("doc_id = 2"), items).count() == 0
    assert [tuple(r) for r in rank(docs, items).collect()] == plain([(1, "a b"), (2, None)], [(1, "a")], 50)


def test_bounds_rule_out_documents(monkeypatch):
    """With scores to reach, whole buckets and most pairs fall before they are scored, and no pair that reaches falls."""
    monkeypatch.setattr(ranking, "FOCUS", 8)
    r = np.random.default_rng(4)
    n_terms, n_items, n_docs = 300, 40, 512
    weights = (9000 / np.arange(1, n_terms + 1) ** 0.7).astype(int)
    lists = [np.sort(r.choice(n_terms, 12, replace=False)) for _ in range(n_items)]
    items = ranking.Items(np.arange(n_items), np.arange(n_items + 1) * 12, np.concatenate(lists), weights, n_terms)
    held = r.random((n_docs, n_terms)) < 0.04
    for i, own in enumerate(lists):
        held[i, own] = True
    rows, terms = np.nonzero(held)
    impacts = r.integers(1000, 400_000, len(rows))
    lengths = np.sqrt(np.bincount(rows, weights[terms] * impacts.astype(float) ** 2, n_docs))
    pairs = np.indices((n_docs, n_items)).reshape(2, -1)
    every = ranking.exact_scores(items, rows, terms, impacts, *pairs).reshape(n_docs, n_items)
    least = every.max(axis=0)
    row, item, score = ranking.bucket_scores(items, rows, terms, impacts, lengths, least)
    assert (every[row, item] == score).all() and len(row) < every.size / 2
    reached = np.zeros(every.shape, bool)
    reached[row, item] = True
    assert (reached | (every < least)).all()
    far = np.full(n_items, int(items.length.max() * lengths.max() * 1.1))
    assert not len(ranking.bucket_scores(items, rows, terms, impacts, lengths, far)[0])


def test_known_terms_are_confirmed_by_bytes(monkeypatch):
    """Even with all hashes equal, terms are told apart."""
    vocabulary = Vocabulary([b"ab", b"cd", b"abc"])
    n, rows, terms, times = count_terms(vocabulary, ["ab cd ab x", None, "ABC abcd"])
    assert n.tolist() == [4, 0, 2]
    assert list(zip(rows.tolist(), terms.tolist(), times.tolist())) == [(0, 0, 2), (0, 1, 1), (2, 2, 1)]
    monkeypatch.setattr(ranking, "mix", lambda x: x * np.uint64(0))
    again = count_terms(Vocabulary([b"ab", b"cd", b"abc"]), ["ab cd ab x", None, "ABC abcd"])
    assert [x.tolist() for x in again] == [n.tolist(), rows.tolist(), terms.tolist(), times.tolist()]
