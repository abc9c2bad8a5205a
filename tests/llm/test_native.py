"""Mixing, URL filters, quality rules and sharding."""

import math
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ledgerloom.llm.mixing import Targets, mix, sample_mix
from ledgerloom.llm.rules import Threshold, judge_texts
from ledgerloom.llm.shards import PIECE_ROWS, Shard, grid, grow, place, shard_of
from ledgerloom.llm.urls import judge, rule_table

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, lang, s, len(t or "")) for i, t, lang, s in rows], DOCS)


# Mixing


def corpus(spark):
    rows = []
    for i in range(600):
        source = "a" if i % 3 == 0 else f"s{i % 7}"
        rows.append((i, "w " * (20 + i % 50), ("en", "de", None)[i % 3 if i % 5 else 0], source))
    return docs_of(spark, rows)


TARGETS = Targets({"en": 0.5, "de": 0.3}, {"tabular": None, "note": 1.0}, temperature=0.5, budget=0.5)


def raked(rows, targets):
    """Plain iterative proportional fitting over single cells."""
    langs = [*targets.langs, "other"]
    cells = Counter()
    for r in rows:
        cells[r["source"], r["lang"] if r["lang"] in targets.langs else "other", r["topic"]] += r["tokens"]
    total = sum(cells.values())
    by = [Counter(), Counter(), Counter()]
    for cell, n in cells.items():
        for k in range(3):
            by[k][cell[k]] += n
    norm = sum(n**targets.temperature for n in by[0].values())
    goals = [{s: n**targets.temperature / norm for s, n in by[0].items()}]
    wanted = {g: targets.langs.get(g) for g in langs}
    wanted = {g: ((by[1][g] / total) ** targets.temperature if w is None else w) if by[1][g] else 0.0 for g, w in wanted.items()}
    goals.append({g: w / sum(wanted.values()) for g, w in wanted.items()})
    goals.append({"note": 1.0})
    weight = {c: 1.0 for c in cells}
    for _ in range(200):
        for k in range(3):
            mass = Counter()
            for c, n in cells.items():
                mass[c[k]] += n * weight[c]
            weight = {c: w * goals[k][c[k]] * total / mass[c[k]] for c, w in weight.items()}
    return weight


def test_mix_matches_plain_raking(spark):
    mixed, fit = mix(corpus(spark), TARGETS)
    rows = mixed.collect()
    assert fit.residual < 1e-5
    weight = raked(rows, TARGETS)
    for r in rows:
        lang = r["lang"] if r["lang"] in TARGETS.langs else "other"
        assert math.isclose(r["weight"], weight[r["source"], lang, r["topic"]], rel_tol=1e-4)
    expected = sum(r["tokens"] * r["probability"] for r in rows) / sum(r["tokens"] for r in rows)
    assert math.isclose(expected, 0.5, rel_tol=1e-6)
    assert abs(sum(r["selected"] for r in rows) - sum(r["probability"] for r in rows)) < 60


def test_mix_edge_cases(spark):
    rows = [(None, None, None, None), (1, "", "en", "a"), (1, "", "en", "a"), (2, "one two", "xx", "b"), (2, "one two", "xx", "b")]
    docs = docs_of(spark, rows).withColumn("tokens", F.lit("mine")).withColumn("weight", F.lit(1))
    out = mix(docs)[0].collect()
    assert len(out) == 5 and len({r["selected"] for r in out if r["doc_id"] == 2}) == 1
    kept = sample_mix(docs)
    assert kept.columns == docs.columns and all(r["tokens"] == "mine" for r in kept.collect())
    assert mix(docs.limit(0))[0].count() == 0
    with pytest.raises(ValueError):
        mix(docs, Targets({str(i): None for i in range(99)}, {str(i): None for i in range(99)}))


# URL filters

URLS = [
    ("http://a.example.net/en/x", "a.example.net", "/en/x", "example.net/en/", "allow"),
    ("http://A.EXAMPLE.net/de/x", "a.example.net", "/de/x", "net/", "block"),
    ("https://example.com/de/1?q=/fr/", "example.com", "/de/1", "example.com/de/", "block"),
    ("https://notexample.com/de/1", "notexample.com", "/de/1", None, "allow"),
    ("https://x.org/fr/#a", "x.org", "/fr/", "org/fr/", "allow"),
    ("http://net", "net", "", None, "allow"),
    ("http://net/?u=http://b", "net", "/", "net/", "block"),
    ("http://h?x=/", "h", "", None, "allow"),
    ("no scheme", "", "", None, "allow"),
    ("", "", "", None, "allow"),
    (None, "", "", None, "allow"),
    ("http://" + "a." * 500 + "net/" + "b/" * 500, "a." * 500 + "net", "/" + "b/" * 500, "net/", "block"),
]


def test_url_rules(spark):
    rules = rule_table(spark, [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")])
    pages = spark.createDataFrame([(i, u[0]) for i, u in enumerate(URLS)] * 2, "page_id bigint, url string")
    out = judge(pages, rules).collect()
    assert sorted((r.page_id, r.host, r.path, r.rule, r.verdict) for r in out) == sorted(
        ((i, *u[1:]) for i, u in enumerate(URLS) for _ in (0, 1)), key=lambda r: r[0]
    )
    assert judge(pages.limit(0), rules).count() == 0
    clash = judge(pages.withColumn("host", F.lit("mine")).withColumn("n", F.lit(1)), rules)
    assert clash.columns == ["page_id", "url", "n", "host", "path", "rule", "verdict"] and clash.where("host = 'mine'").count() == 0


def test_url_rule_inside_a_segment_and_ties(spark):
    rules = rule_table(spark, [("block", "a.b/x/yz"), ("allow", "a.b/x/"), ("allow", "q/1"), ("block", "q/1"), ("block", "plain")])
    pages = spark.createDataFrame([("u://a.b/x/yzz",), ("u://a.b/x/y",), ("u://q/12",), ("u://s.plain",)], "url string")
    got = {r.url: (r.rule, r.verdict) for r in judge(pages, rules).collect()}
    assert got == {
        "u://a.b/x/yzz": ("a.b/x/yz", "block"),
        "u://a.b/x/y": ("a.b/x/", "allow"),
        "u://q/12": ("q/1", "block"),
        "u://s.plain": ("plain", "block"),
    }
    assert judge(pages, rules.limit(0)).where("verdict = 'allow' AND rule IS NULL").count() == 4


# Quality rules

TEXTS = [
    None,
    "",
    " \t\n",
    "one",
    "the a b c d e f g h i",
    "a b c d e a b c d e the of x y z",
    "x " * 3000,
    "line one\nline one\n \n\nline two\n" * 3 + "the and of to in is",
    "wörter ünd Ähnliches der die das " * 4,
    "a#b *c $ %% the of and | <b> " * 3,
    "eins\x0bzwei\x0cdrei\rvier fünf\xa0sechs the of and to in is it",
    " ".join(f"word{i}" for i in range(20000)) + " the of",
]


def plain_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    seen = Counter(windows)
    covered = {j for i, w in enumerate(windows) if seen[w] > 1 for j in range(i, i + 5)}
    n = len(words)
    failed = n < 10 or 100 * len(covered) > 20 * n
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), failed)


def test_quality_counts(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)) * 2, "doc_id bigint, text string")
    docs = docs.withColumn("kept", F.lit("mine")).withColumn("n_words", F.lit(-1))
    out = judge_texts(docs).collect()
    assert len(out) == 2 * len(TEXTS)
    for r in out:
        counts = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
        assert counts == plain_counts(TEXTS[r.doc_id]), TEXTS[r.doc_id]
        assert not (r.kept and r.base_failed)
    assert judge_texts(docs.limit(0)).count() == 0


def test_quality_thresholds(spark):
    text = "the plain words of this text are kept by every rule of the table"
    docs = spark.createDataFrame([(text,)], "text string")
    kept = lambda *t: judge_texts(docs, t).first()["kept"]
    assert kept() and kept(Threshold("n_words", least=14, most=14)) and not kept(Threshold("n_words", most=13))
    assert kept(Threshold("n_words", most=13, from_words=15)) and not kept(Threshold("stop_share", least=0.9))
    assert kept(Threshold("mean_word_chars", least=9, most_bytes=0.5)) and not kept(Threshold("mean_word_chars", least=9, most_bytes=1.5))


def test_quality_bounds_fit_scripts_and_leave_other_columns(spark):
    texts = ["an example of twelve words that are plain, as the rules ask it", "word | word | word | word | word | word", "a b c d e f g h i j k l m n",
             "extraordinarily internationalised telecommunications " * 5, "漢字仮名交じりの文章には語の間に空白がありません " * 1 + " ".join("漢字仮名交じりの文章には語の間に空白がない" + str(i) for i in range(12)),
             "слово за словом текст идёт своим чередом и никогда не кончается сам собой"]
    docs = spark.createDataFrame([(i, t, -1, "mine") for i, t in enumerate(texts)], "doc_id bigint, text string, _n_words int, _row string")
    out = judge_texts(docs).orderBy("doc_id").collect()
    assert [r.kept for r in out] == [True, False, False, False, True, True]
    assert all((r["_n_words"], r["_row"]) == (-1, "mine") for r in out)


def test_quality_rules_against_labels(spark):
    """On the given documents junk goes and good documents stay."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    quality = {r.doc_id: r.quality for r in labels.collect()}
    rows = judge_texts(docs.select("doc_id", "text")).select("doc_id", "base_failed", "kept").collect()
    counts = Counter((quality[r.doc_id], r.kept) for r in rows if r.doc_id in quality and not r.base_failed)
    assert counts[1, False] == 0 and counts[1, True] > 250 and counts[0, True] <= 1


# Sharding


def test_place_is_whole_and_gapless(spark):
    rows = [(i, ("same", None, f"ü{i}")[i % 3]) for i in range(2000)] + [(7, "again")] * 50 + [(None, "x")] * 3
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("shard", F.lit("mine"))
    out = place(docs, grid(40)).collect()
    raw = Counter((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in rows)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in out) == raw
    for shard in range(40):
        slots = sorted(r.slot for r in out if r.shard == shard)
        assert slots == list(range(len(slots))) and 20 < len(slots) < 160
    assert len({(r.doc_id, r.shard) for r in out}) == len({r.doc_id for r in out})
    assert all(r.grown_shard in (r.shard, 40) for r in out)
    assert 20 < sum(r.grown_shard == 40 for r in out) < 90
    assert place(docs.limit(0), grid(40)).count() == 0


def test_place_numbers_pieces(spark, monkeypatch):
    monkeypatch.setattr("ledgerloom.llm.shards.PIECE_ROWS", 10)
    out = place(spark.range(1000).selectExpr("id AS doc_id", "'t' AS text"), grid(3, 2, 1)).collect()
    for shard in range(3):
        slots = sorted(r.slot for r in out if r.shard == shard)
        assert slots == list(range(len(slots)))
    assert PIECE_ROWS > 10


@pytest.mark.parametrize("run", [1, 3, 100_000])
def test_slots_of_many_equal_rows_come_in_runs(spark, monkeypatch, run):
    monkeypatch.setattr("ledgerloom.llm.shards.RUN_SLOTS", run)
    rows = [(None, "")] * 40 + [(1, "x")] * 7 + [(k, "y" * k) for k in range(2, 30)]
    out = place(spark.createDataFrame(rows, "doc_id bigint, text string"), grid(3)).collect()
    assert Counter((r.doc_id, r.size) for r in out) == Counter((i, len(t) + 16) for i, t in rows)
    for shard in {r.shard for r in out}:
        slots = sorted(r.slot for r in out if r.shard == shard)
        assert slots == list(range(len(slots)))


def test_changed_weights_move_rows_only_out_of_or_into_their_subtree(spark):
    old = grid(12, 3, 2)
    new = tuple(Shard(s.number, s.rack, s.region, 3.0 if s.number == 4 else s.weight) for s in old)
    gone = tuple(Shard(s.number, s.rack, s.region, 0.0 if s.number == 4 else s.weight) for s in old)
    rows = spark.range(3000).select(
        shard_of(old, F.col("id")).alias("a"), shard_of(new, F.col("id")).alias("b"), shard_of(gone, F.col("id")).alias("c")
    ).collect()
    side = {s.number: s.region for s in old}
    for r in rows:
        # Between regions rows move only towards the heavier one; other regions keep their rows where they are.
        assert r.a == r.b or side[r.b] == "r0"
        assert r.a == r.c or side[r.a] == "r0"
    assert sum(r.b == 4 for r in rows) > 1.5 * sum(r.a == 4 for r in rows) and not any(r.c == 4 for r in rows)
    assert grow(old)[-1] == Shard(12, "k-12", "r-12", 1.0)
    with pytest.raises(ValueError):
        shard_of((Shard(0, "k", "r", 0.0),), F.lit(1))
