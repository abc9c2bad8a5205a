"""Benchmark passages in documents, against edit distances by a plain table."""

import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.llm.qgrams import LEAST_CHARS, banded_distance, build_index, decontaminate, edit_budget, find_leaks, find_passages, normalise


def plain_distance(item, text):
    """Least edits from ``item`` to any part of ``text``."""
    row = [0] * (len(text) + 1)
    for a in item:
        new = [row[0] + 1]
        for j, b in enumerate(text):
            new.append(min(row[j] + (a != b), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


def words(r, n):
    return " ".join("".join(r.choices("abcdefgh", k=r.randint(2, 8))) for _ in range(n))


def edited(r, text, edits):
    chars = list(text)
    for _ in range(edits):
        k = r.randrange(len(chars))
        kind = r.randrange(3)
        chars[k : k + 1] = [] if kind == 0 else [r.choice("xyz")] + ([chars[k]] if kind == 1 else [])
    return "".join(chars)


def test_normalise():
    assert normalise(None) == "" == normalise(" .,_ ")
    assert normalise("  The %%Ünit_one!\n2nd ") == "the ünit one 2nd"
    assert normalise("İx") == "i x"


def test_every_pair_like_a_plain_table():
    r = random.Random(3)
    items = [(i, words(r, n)) for i, n in enumerate([8, 12, 20, 40, 60])]
    texts = []
    for n in range(60):
        item = items[n % 5][1]
        middle = edited(r, item, n // 5) if n % 4 else item.upper().replace(" ", " %% ")
        texts.append(words(r, r.randint(0, 40)) + " " + middle + " " + words(r, r.randint(0, 40)))
    texts += ["", None, words(r, 5000), items[0][1] * 3]
    got = {(n, i) for n, i, *_ in find_passages(texts, build_index(items))}
    want = set()
    for n, t in enumerate(texts):
        for i, item in items:
            m = normalise(item)
            if len(m) >= LEAST_CHARS and plain_distance(m, normalise(t)) <= edit_budget(len(m)):
                want.add((n, i))
    assert got == want and len(want) > 30


def test_banded_distance_is_the_plain_one_within_the_band():
    r = random.Random(5)
    for _ in range(40):
        item = words(r, 8)
        region = edited(r, item, r.randint(0, 4))
        assert banded_distance(item, region, -6, 6)[0] == plain_distance(item, region)
    edits, start, end = banded_distance("abcdef", "xxabcdefyy", 0, 4)
    assert (edits, start, end) == (0, 2, 8)


QUESTIONS = [
    (1, "What is the capital of France?"), (2, "Who wrote it, and when?"), (3, "Yes."), (4, "forty two"), (None, "is the capital of"),
    (5, "!?"), (6, "What is the capital of France?"),
]


def plain_short(text):
    """(item, start) of exact places, by plain search over words."""
    t, out = normalise(text), []
    for i, item in QUESTIONS:
        m = normalise(item)
        if m and (len(m) < 12 or len(m.split()) < 3):
            out += [(i, 0)] if t == m else []
        elif m:
            at = 0
            while (at := t.find(m, at)) >= 0:
                if (at == 0 or t[at - 1] == " ") and t[at + len(m) : at + len(m) + 1] in ("", " "):
                    out.append((i, at))
                    at += len(m)
                else:
                    at += 1
    return out


def test_short_items_are_found_exactly():
    r = random.Random(1)
    texts = ["What is the capital of France?", "so: WHAT is -- the capital of france!", "what is the capital of Frances", "yes", "yes and no", "Yes!!"]
    texts += ["forty, two", "forty two more", None, "", "who wrote it", "and when? who wrote it, and when? who wrote it and when", "somewhat is the capital of France"]
    texts += [words(r, 3000) + " what is the capital of France " + words(r, 3000), "what is", "the capital of France"]
    longer = (9, words(r, 30))
    texts.append(longer[1] + " what is the capital of france")
    for items in (QUESTIONS, [*QUESTIONS, longer]):
        got = [(n, i, start) for n, i, start, *_ in find_passages(texts, build_index(items)) if i != 9]
        want = [(n, i, start) for n, t in enumerate(texts) for i, start in plain_short(t)]
        assert sorted(got, key=str) == sorted(want, key=str) and len(want) > 15
    assert build_index([(1, "!?"), (2, None)]) is None


@pytest.fixture
def tables(spark):
    r = random.Random(9)
    item = words(r, 30)
    other = words(r, 30)
    bench = [(1, item), (2, "short"), (3, None), (None, other), (4, item), (5, "")]
    rows = [(10, "before " + item + " after"), (11, None), (12, ""), (13, words(r, 20000) + " " + item), (14, words(r, 50)), (10, "before " + item + " after"), (None, item), (15, other), (16, "Short!")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("item_id", F.lit("mine")).withColumn("start", F.lit(0))
    return docs, spark.createDataFrame(bench, "item_id bigint, text string")


def test_leaks(spark, tables):
    docs, bench = tables
    got = sorted(((r.doc_id, r.item_id, r.edits) for r in find_leaks(docs, bench).collect()), key=repr)
    assert got == sorted([(d, i, 0) for d in (10, 10, 13, None) for i in (1, 4)] + [(15, None, 0), (16, 2, 0)], key=repr)
    kept = decontaminate(docs, bench)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [11, 12, 14]
    assert find_leaks(docs.limit(0), bench).count() == 0
    assert find_leaks(docs, bench.limit(0)).count() == 0 and decontaminate(docs, bench.limit(0)).count() == 9


def test_index_blocks_give_the_same(spark, tables, monkeypatch):
    docs, bench = tables
    whole = sorted(map(repr, find_leaks(docs, bench).collect()))
    monkeypatch.setattr("ledgerloom.llm.qgrams.INDEX_CHARS", 100)
    assert sorted(map(repr, find_leaks(docs, bench).collect())) == whole
