"""Main-text extraction, the quality classifier, the pipeline and the registered queries."""

import random
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from ledgerloom.llm import crf
from ledgerloom.llm.catalog import REGISTRY
from ledgerloom.llm.cotraining import classify, keep_good
from ledgerloom.llm.dom import leaf_blocks
from ledgerloom.llm.extract import MARK, default_extractor, describe, extract, labelled_pages, main_text, train_extractor

# Extraction


def texts_of(page):
    return [b.text for b in leaf_blocks(page)]


@pytest.mark.parametrize(
    "page, blocks",
    [
        (None, []),
        ("", []),
        ("plain", ["plain"]),
        ("<p>a<p>b", ["a", "b"]),
        ("<p><b>a<br><p>b</p>", ["a", "b"]),
        ("<p>a <i>b</i>c\n\t d</p>e", ["a bc d", "e"]),
        ("<ul><li>a<li>b</ul>", ["a", "b"]),
        ("<table><tr><td>a<td>b<tr><td>c</table>", ["a", "b", "c"]),
        ("<script>var t=\"</p>\";</script>x<style>p{}</style>y<!-- <p>z --><title>t</title>", ["xy"]),
        ("a &amp;&lt;p&gt; &eacute;&#233;&#x41; &am &amp", ["a &<p> ééA &am &"]),
        ('<a title="x>y" href=\'>\'>link</a>', ["link"]),
        ("1 < 2 <3", ["1 < 2 <3"]),
        ("<p>a<br/>b</p><hr>c</nope>d", ["a b", "cd"]),
        ("x<script>never closed", ["x"]),
        ('x<a href="never closed', ["x"]),
        ("x<", ["x<"]),
        ("<P>A<DIV>B</P>C", ["A", "B", "C"]),
        ("&nbsp;a&nbsp; b", ["a b"]),
    ],
)
def test_leaf_blocks(page, blocks):
    assert texts_of(page) == blocks


def test_long_tag_soup_is_read_in_linear_time():
    assert len(texts_of("<p>x" * 50_000)) == 50_000
    assert texts_of("<" * 100_000 + "x") and texts_of('<a b="' * 50_000) == []


def brute_best(model, scores):
    best = None
    for bits in range(1 << len(scores)):
        labels = [bits >> i & 1 for i in range(len(scores))]
        total = model.first[labels[0]] + sum(s for s, y in zip(scores, labels) if y)
        total += sum(model.steps[a][b] for a, b in zip(labels, labels[1:]))
        if best is None or total > best[0] + 1e-12:
            best = (total, labels)
    return best[0]


def test_viterbi_finds_the_best_labels():
    r = random.Random(2)
    for _ in range(50):
        draw = lambda: r.uniform(-2, 2)
        model = crf.Model({}, ((draw(), draw()), (draw(), draw())), (draw(), draw()))
        scores = [draw() for _ in range(r.randint(1, 8))]
        labels = model.decode(scores)
        total = model.first[labels[0]] + sum(s for s, y in zip(scores, labels) if y)
        total += sum(model.steps[a][b] for a, b in zip(labels, labels[1:]))
        assert abs(total - brute_best(model, scores)) < 1e-9
    assert crf.Model({}, ((0, 0), (0, 0)), (0, 0)).decode([]) == []


def test_field_learns_from_neighbours():
    pages = [[["a"], ["x"], ["x"]], [["b"], ["x"], ["x"], ["x"]]] * 20
    model = crf.train(pages, [[1, 1, 1], [0, 0, 0, 0]] * 20)
    assert model.decode(model.scores([["a"], ["x"], ["x"]])) == [1, 1, 1]
    assert model.decode(model.scores([["b"], ["x"], ["unknown"]])) == [0, 0, 0]
    with pytest.raises(ValueError):
        crf.train([[]], [[]])


def test_held_out_pages():
    model = default_extractor()
    wrong = blocks = 0
    for page in labelled_pages(200, seed=5):
        found = leaf_blocks(page, MARK)
        labels = model.decode(model.scores(describe(found)))
        wrong += sum(int(b.marked) != y for b, y in zip(found, labels))
        blocks += len(found)
    assert wrong / blocks < 0.01


ARTICLE = "<article><h1>Title of it</h1><p>First paragraph, of some length.</p><p>Second &amp; last.</p></article>"
PAGES = [
    f"<body><nav><a href=/>Home</a></nav>{ARTICLE}<footer>&copy; us</footer></body>",
    f"<body><header><div>Site</div></header><aside><h3>Related</h3><p>Other things to read here.</p></aside>{ARTICLE}</body>",
    f"<body>{ARTICLE}<section id=comments><h3>Comments</h3><p>I liked this, thank you all.</p></section></body>",
    f'<body><div class="cookie-notice"><p>We use cookies, as all do.</p></div>{ARTICLE}<form><label>Name</label><input></form></body>',
    f'<body>{ARTICLE.replace("</h1>", "</h1><div class=ad>Buy this, now.</div>")}<script>track()</script></body>',
]


def test_extracted_articles(spark):
    text = "Title of it\nFirst paragraph, of some length.\nSecond & last."
    rows = [(i, "u", p) for i, p in enumerate(PAGES)] + [(90, None, None), (91, "u", ""), (91, "u", ""), (None, "u", "<nav>Menu</nav>")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("text", F.lit(5)).withColumn("a b", F.lit(1))
    out = extract(pages)
    assert out.columns == ["page_id", "url", "a b", "text", "n_chars"]
    for r in out.collect():
        assert r.text == (text if r.page_id is not None and r.page_id < 90 else "") and r.n_chars == len(r.text)
    assert extract(pages.limit(0)).count() == 0


def test_own_labelled_pages():
    pages = [f'<div class=q{i % 3} {MARK}="1"><p>good text {i}</p></div><div class=z><p>bad text {i}</p></div>' for i in range(30)]
    model = train_extractor(pages)
    assert main_text("<div class=q1><p>new</p></div><div class=z><p>old</p></div>", model) == "new"


# Quality


def quality_tables(spark, n=600):
    r = random.Random(6)
    rows, labels = [], []
    for i in range(n):
        words = ["".join(r.choices("aeinorst", k=r.randint(2, 8))) for _ in range(r.randint(20, 200))]
        bad = i % 6 == 0
        if bad:
            kind = i // 6 % 4
            words = [[w + "%%%" for w in words], [w.upper() + "!!" for w in words], ["same"] * len(words), [w + " |" for w in words]][kind]
        text = " ".join(words)
        rows.append((i, text, "en", f"s{i % 5}", len(text)))
        if i % 3 == 0 or i % 7 == 0:
            labels.append((i, int(not bad)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    return docs, spark.createDataFrame(labels, "doc_id bigint, quality int")


def test_classifier_on_held_out_documents(spark):
    docs, labels = quality_tables(spark)
    known = {r.doc_id for r in labels.collect()}
    out = classify(docs, labels).collect()
    held = [r for r in out if r.doc_id not in known]
    assert len(out) == 600 and len(held) > 200
    right = [r.kept == (r.doc_id % 6 != 0) for r in held]
    assert np.mean(right) > 0.98 and all(r.kept for r in held if r.doc_id % 6)
    assert all(0 <= r.quality <= 1 for r in out)


def test_classifier_edge_cases(spark):
    docs, labels = quality_tables(spark, 120)
    odd = spark.createDataFrame(
        [(None, None, None, None, None), (5, "", "xx", "", 0), (5, "", "xx", "", 0), (6, "w " * 50_000, "en", "s1", 100_000)], docs.schema
    )
    clash = docs.union(odd).withColumn("quality", F.lit("mine")).withColumn("kept", F.lit(0))
    more = labels.union(spark.createDataFrame([(None, 1), (3, None), (4, 7), (0, 1)], labels.schema))
    out = classify(clash, more)
    assert out.count() == 124 and dict(out.dtypes)["kept"] == "boolean"
    kept = keep_good(clash, more)
    assert kept.columns == clash.columns and {r.quality for r in kept.collect()} == {"mine"}
    assert classify(docs.limit(0), labels).count() == 0
    assert classify(docs, labels.limit(0)).where("kept").count() == 120
    assert classify(docs, labels.where("quality = 0")).where("kept").count() == 0


# Pipeline and queries

SF_DIR = "/root/testdata/sf0.001"
given = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="given tables are missing")


def stored(df, path):
    df.write.parquet(str(path))
    return df.sparkSession.read.parquet(str(path))


@given
def test_pipeline_stages_take_effect(spark, tmp_path):
    from tests.llm.test_copies import plain_components
    from ledgerloom.llm.qgrams import normalise

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, steps = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = steps[name] = stored(stage(spark, docs, SF_DIR), tmp_path / name)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
    ids = {name: [r.doc_id for r in df.select("doc_id").collect()] for name, df in steps.items()}
    bad = {r.doc_id for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").where("quality = 0").collect()}
    assert len(bad & set(ids["quality"])) <= 0.1 * len(bad) and len(ids["quality"]) > 150
    rows = [(r.doc_id, r.text) for r in steps["quality"].collect()]
    assert set(ids["near_duplicates"]) == {c for _, c in plain_components(rows).values()}
    items = [normalise(r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    clean = {r.doc_id for r in steps["near_duplicates"].collect() if not any(i in normalise(r.text) for i in items)}
    assert set(ids["decontamination"]) == clean
    assert set(ids["mixing"]) < clean and len(ids["mixing"]) > 0.7 * len(clean)
    assert sorted(ids["sharding"]) == sorted(ids["mixing"])
    run = corpus_pipeline.run(spark, SF_DIR)
    assert sorted(r.doc_id for r in run.collect()) == sorted(ids["sharding"])


def test_pipeline_of_an_empty_table(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(0) if Path(SF_DIR).exists() else None
    if docs is None:
        pytest.skip("given tables are missing")
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF_DIR), tmp_path / name)
        assert docs.count() == 0


@given
@pytest.mark.parametrize("name", [n for n, q in REGISTRY.items() if not q.sql])
def test_query_runs_over_whole_tables(spark, name):
    table = "pages" if name in ("op4_html_extraction", "op7_warc") else "documents"
    rows = spark.read.parquet(f"{SF_DIR}/{table}.parquet").count()
    found = entry.queries()[name](spark, SF_DIR).count()
    assert found == rows or name == "op8_decontamination" and 0 < found < rows
