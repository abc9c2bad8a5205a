"""Near duplicates and repeated byte strings, against brute force."""

import hashlib
import random
import re
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerloom import runtime
from ledgerloom.llm import bwt, minhash, repeats
from ledgerloom.llm.components import components
from ledgerloom.llm.minhash import drop_near_duplicates, near_duplicates
from ledgerloom.llm.repeats import remove_repeats
from ledgerloom.llm.shingles import shingle_sets, stretches


def prose(r, n):
    return " ".join("".join(r.choices("abcdefgh", k=r.randint(2, 7))) for _ in range(n))


def varied(r, text, share):
    return " ".join(w if r.random() > share else "".join(r.choices("uvwxyz", k=4)) for w in text.split(" "))


def plain_set(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def plain_components(rows):
    sets = [(i, plain_set(t)) for i, t in rows]
    label = {i: i for i, _ in sets}

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                x, y = sorted((root(i), root(j)))
                label[y] = x
    return {i: (len(s), root(i)) for i, s in sets}


def near_rows():
    r = random.Random(4)
    base, other = prose(r, 150), prose(r, 60)
    texts = [varied(r, base, r.choice([0.0, 0.02, 0.03, 0.05, 0.08])) for _ in range(120)]
    texts += [varied(r, other, 0.02) for _ in range(30)] + [base.upper(), base.replace(" ", "\n\t"), None, "", " \t", "one", "One", "one two"]
    texts += [prose(r, 40) for _ in range(40)] + ["ÀB c d e f", "Àb c d e f", "àb c d e f", prose(r, 20000)] + ["x " * 500, "x " * 400]
    order = list(range(len(texts)))
    r.shuffle(order)
    return [(1000 + i, texts[k]) for i, k in enumerate(order)]


@pytest.mark.parametrize("block, centre", [(800, 2000), (7, 5)])
def test_components_like_all_pairs(spark, monkeypatch, block, centre):
    monkeypatch.setattr(minhash, "BLOCK_ROWS", block)
    monkeypatch.setattr(minhash, "CENTRE_ROWS", centre)
    rows = near_rows()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("kept", F.lit("mine"))
    out = near_duplicates(docs).collect()
    want = plain_components(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in out} == want and len(out) == len(rows)
    assert all(r.kept == (r.doc_id == r.component_id) for r in out)
    kept = drop_near_duplicates(docs)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {c for _, c in want.values()}


def test_blocks_are_cut_by_shingles_too(spark, monkeypatch):
    """Few members of many shingles fill a block."""
    monkeypatch.setattr(minhash, "BLOCK_SHINGLES", 300)
    rows = near_rows()
    out = near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {x["doc_id"]: (x["n_shingles"], x["component_id"]) for x in out} == plain_components(rows)


def test_few_rows_are_stored_in_few_files(spark, monkeypatch):
    """Every stored file costs its executor a process or a request, however few rows it holds."""
    folders = []
    monkeypatch.setattr(runtime, "_SCRATCH", folders)
    rows = near_rows()
    settings = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {key: spark.conf.get(key) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        out = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert {x["doc_id"]: (x["n_shingles"], x["component_id"]) for x in out} == plain_components(rows)
    files = [len(list(Path(folder).glob("part-*"))) for folder in folders]
    assert len(files) > 10 and sum(files) < 2 * 64


def test_groups_hold_sets_instead_of_texts():
    texts = ["a b c d e f " * 3, "g h i j k l", None, "m " * 400_000]
    batch = pa.RecordBatch.from_pydict({"key": [1, 1, 2, 2], "i": [0, 0, 0, 0], "j": [0, 0, 0, 0], "id": [1, 2, 3, 4], "text": texts})
    found = list(minhash._with_sets(iter([batch.slice(0, 3), batch.slice(3)]), ["key", "i", "j"]))
    assert [table.column("id").to_pylist() for table, _ in found] == [[1, 2], [3, 4]]
    assert all("text" not in table.column_names for table, _ in found)
    for (_, sets), own in zip(found, (texts[:2], texts[2:])):
        assert [s.tolist() for s in sets] == [s.tolist() for s in shingle_sets(own)]


def test_near_duplicates_edge_cases(spark):
    text = "a b c d e f g h"
    rows = [(1, text), (1, text), (None, text), (2, text), (None, "else where"), (3, None), (3, "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    out = near_duplicates(docs).collect()
    assert len(out) == 7 and {r.component_id for r in out if r.n_shingles == 4} == {1}
    assert sorted((repr(r.doc_id), r.text) for r in drop_near_duplicates(docs).collect() if r.text) == [
        ("1", text), ("1", text), ("None", "else where")
    ]
    assert near_duplicates(docs.limit(0)).count() == 0


def test_rows_without_id_and_ids_with_several_texts_are_linked(spark):
    r = random.Random(12)
    base, other, third = prose(r, 200), prose(r, 120), prose(r, 90)
    near = lambda t: varied(r, t, 0.01)
    rows = [(None, near(base)), (7, base), (None, near(base)), (5, other), (5, near(base)), (9, near(other))]
    rows += [(None, third), (None, near(third)), (None, None)] + [(20 + k, prose(r, 50)) for k in range(30)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    out = near_duplicates(docs).collect()
    texts = {F_hash: t for F_hash, t in docs.select(F.xxhash64(F.coalesce("text", F.lit(""))), "text").collect()}
    found = {(x.doc_id, texts[x.text_hash]): (x.component_id, x.kept) for x in out}
    assert len(out) == len(rows)
    for i, t in rows[:5]:
        assert found[i, t] == (5, i == 5), (i, t[:20])
    assert found[9, rows[5][1]] == (5, False)
    assert found[None, third] == found[None, rows[7][1]] == found[None, None] == (None, True)
    kept = sorted(str(x.doc_id) for x in drop_near_duplicates(docs).collect())
    assert kept == sorted(["5", "5", "None", "None", "None", *[str(20 + k) for k in range(30)]])


def test_signature_estimate_follows_similarity():
    r = random.Random(1)
    base = prose(r, 800)
    sets = shingle_sets([base] + [varied(r, base, 0.03) for _ in range(20)])
    for s in sets[1:]:
        shared = len(np.intersect1d(sets[0], s))
        similarity = shared / (len(sets[0]) + len(s) - shared)
        equal = np.mean(minhash.minima(sets[0]) == minhash.minima(s))
        assert abs(equal - similarity) < 0.2
    assert not minhash.linked(np.arange(3, dtype=np.uint64), np.arange(4, dtype=np.uint64) + np.uint64(1))
    assert minhash.linked(np.arange(3, dtype=np.uint64), np.arange(4, dtype=np.uint64))


def test_components_of_long_chains_and_empty_links(spark):
    links = spark.range(60).selectExpr("id AS a", "id + 1 AS b").union(spark.createDataFrame([(200, 190), (190, 190)], "a bigint, b bigint"))
    got = {r.id: r.component for r in components(links).collect()}
    assert got == {**{i: 0 for i in range(61)}, 190: 190, 200: 190}
    assert components(links.limit(0)).count() == 0


# Repeated strings


def plain_removal(texts):
    seen = Counter()
    for t in texts:
        seen.update(t[i : i + 200] for i in range(len(t) - 199))
    out = []
    for t in texts:
        gone = np.zeros(len(t) + 1, bool)
        for i in range(len(t) - 199):
            if seen[t[i : i + 200]] > 1:
                gone[i : i + 200] = True
        kept = bytes(b for b, g in zip(t, gone) if not g)
        spans = int(np.sum(gone[1:-1] & ~gone[:-2])) + int(len(t) > 0 and gone[0]) if len(t) > 1 else 0
        out.append((len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def repeat_texts():
    r = random.Random(8)
    passage, long = prose(r, 60), prose(r, 300)
    texts = [f"{prose(r, r.randint(0, 60))} {passage} {prose(r, r.randint(0, 60))}" for _ in range(15)]
    texts += [varied(r, long, 0.01) for _ in range(12)] + [long, long, None, "", "short", "short"]
    texts += ["a" * 199, "a" * 200, "b" * 201, "ab" * 300, "xyz" * 100 + prose(r, 50) + "xyz" * 100]
    # Exactly 199 and 200 shared bytes, and a shared string at either end.
    core = prose(r, 80)
    texts += [prose(r, 40) + "1" + core[:199] + "2" + prose(r, 40), prose(r, 40) + "3" + core[:199] + "4" + prose(r, 40)]
    texts += [prose(r, 40) + "5" + core[200:400] + "6" + prose(r, 40), prose(r, 40) + "7" + core[200:400] + "8" + prose(r, 40)]
    texts += [passage[:210] + "é" * 150, "é" * 150 + passage[-205:], prose(r, 3000)]
    return texts


def removed(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(5).withColumn("raw", F.lit(1))
    rows = remove_repeats(docs).orderBy("doc_id").collect()
    return [(r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(bytes(r.kept)).hexdigest()) for r in rows]


@pytest.mark.parametrize("setting", [{}, {"CROWD": 3}, {"BUCKET_BYTES": 2000}])
def test_removal_like_brute_force(spark, monkeypatch, setting):
    for name, value in setting.items():
        monkeypatch.setattr(repeats, name, value)
    texts = repeat_texts()
    assert removed(spark, texts) == plain_removal([(t or "").encode() for t in texts])


@pytest.mark.parametrize("piece, stretch", [(700, 1), (2_000_000, 1), (2_000_000, 1_000_000)])
def test_every_string_lies_in_one_context(monkeypatch, piece, stretch):
    monkeypatch.setattr(repeats, "PIECE", piece)
    monkeypatch.setattr("ledgerloom.llm.shingles.STRETCH", stretch)
    texts = [(t or "").encode() for t in repeat_texts()]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], names=["text", "raw"])
    found = [[] for _ in texts]
    for rows in repeats._anchored([batch]):
        for r in rows.to_pylist():
            assert r["bytes"] == len(texts[r["text"]]) and 0 <= r["before"] <= repeats.LENGTH - repeats.GRAM
            found[r["text"]] += range(r["start"], r["stop"] - repeats.LENGTH + 1)
    for t, starts in zip(texts, found):
        assert sorted(starts) == list(range(len(t) - repeats.LENGTH + 1))


def test_a_long_text_before_short_ones_is_cut_into_pieces(monkeypatch):
    # Places of up to 4096 bytes only, as a long text has more places than the position bits hold.
    monkeypatch.setattr(repeats, "PIECE", 2000)
    monkeypatch.setattr(repeats, "_POSITION_BITS", np.uint64(12))
    monkeypatch.setattr("ledgerloom.llm.shingles.STRETCH", 1000)
    r = random.Random(3)
    texts = [prose(r, n).encode() for n in (40, 4000, 90, 130, 4000, 4000, 60)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], names=["text", "raw"])
    parts = [p.column("text").to_pylist() for p in stretches(batch, "raw")]
    assert [1] in parts and [4] in parts and [5] in parts and sum(parts, []) == list(range(len(texts)))
    found = [[] for _ in texts]
    for rows in repeats._anchored([batch]):
        for row in rows.to_pylist():
            assert 0 <= row["before"] <= repeats.LENGTH - repeats.GRAM
            found[row["text"]] += range(row["start"], row["stop"] - repeats.LENGTH + 1)
    for t, starts in zip(texts, found):
        assert sorted(starts) == list(range(len(t) - repeats.LENGTH + 1))


def test_removal_edge_cases(spark):
    text = "q" * 250
    docs = spark.createDataFrame([(1, text), (1, text), (None, text), (None, "z")], "doc_id bigint, text string")
    assert [r.n_removed for r in remove_repeats(docs).orderBy(F.desc("n_bytes")).collect()] == [250, 250, 250, 0]
    assert remove_repeats(docs.limit(0)).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_prefix_classes_like_sorting(seed):
    r = random.Random(seed)
    strings = ["".join(r.choices("ab", k=r.randint(0, 60))) for _ in range(30)] + ["ab" * 40] * 2
    data = np.frombuffer(b"".join(s.encode() + b"\xff" for s in strings), np.uint8)
    for length in (1, 5, 20):
        order, classes = bwt.prefix_classes(data, length)
        raw = data.tobytes()
        starts = [raw[i : i + length] for i in order]
        whole = [len(s) == length and 0xFF not in s for s in starts]
        for k in range(1, len(order)):
            if whole[k] and whole[k - 1]:
                assert (classes[k] == classes[k - 1]) == (starts[k] == starts[k - 1])
            elif whole[k] or whole[k - 1]:
                assert classes[k] != classes[k - 1]
