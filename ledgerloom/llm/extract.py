"""Main text of HTML pages: a conditional random field over the leaf blocks of the page.

A block is described by its ancestors (tags, class and id words) and its text (length, links, punctuation, place).
The field is trained on labelled pages, by default on pages written by ``labelled_pages``, and decoded by Viterbi.
"""

from __future__ import annotations

import random
from collections import Counter
from collections.abc import Iterator, Sequence
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm import crf
from ledgerloom.llm.dom import Block, leaf_blocks
from ledgerloom.llm.shingles import stretches
from ledgerloom.llm.workers import arrow_map

# Attribute that labels blocks of training pages: 1 main text, 0 anything else.
MARK = "data-main"
TRAINING_PAGES = 1500
# A feature counts from this many training pages on.
LEAST_PAGES = 4


def _step(value: float, edges: Sequence[float]) -> int:
    return sum(value >= e for e in edges)


def describe(blocks: Sequence[Block]) -> list[list[str]]:
    """Features of each block."""
    last = max(len(blocks) - 1, 1)
    out = []
    for i, b in enumerate(blocks):
        chars = len(b.text)
        spaces = b.text.count(" ") + 1
        features = [
            *b.signs,
            *["box" + sign for sign in b.box],
            f"box:{len(b.box)}",
            f"leaf:{b.leaf}",
            f"words:{_step(spaces, (2, 4, 8, 15, 30, 60))}",
            f"links:{_step(b.linked / chars, (0.01, 0.25, 0.5, 0.9))}",
            f"place:{_step(i / last, (0.01, 0.1, 0.3, 0.7, 0.9, 0.99))}",
        ]
        if b.text[-1] in ".!?…:;\"”»":
            features.append("ends")
        if "," in b.text or ". " in b.text:
            features.append("clauses")
        if "©" in b.text:
            features.append("rights")
        if "»" in b.text or "·" in b.text:
            features.append("divided")
        out.append(features)
    return out


_SYLLABLES = "an be ca do el fi ga ho in ju ka lo mi no or pa qui re so tu un ve wa xi yo ze ä é ñ ü".split()

# Class and id words of page parts (fixed values).
_MENU = "menu nav navigation navbar topnav breadcrumb breadcrumbs main-menu site-nav links pagination pager tabs".split()
_HEADER = "header site-header masthead branding logo tagline top topbar page-header".split()
_FOOTER = "footer site-footer colophon copyright legal bottom page-footer credits".split()
_SIDE = "sidebar side aside widget related recommended popular trending rail secondary tags archive toc more".split()
_NOTICE = "notice cookie-notice cookies consent gdpr banner alert warning message newsletter subscribe paywall popup modal toast".split()
_ADVERT = "ad ads advert advertisement sponsor sponsored promo promotion adsense dfp banner-ad commercial".split()
_FORM = "form search search-form login signup contact-form subscribe-form feedback poll".split()
_COMMENT = "comment comments comment-list commentlist discussion replies reply responses disqus comment-body user-comments".split()
_SHARE = "share social sharing follow byline meta author-box post-meta tools".split()
_MAIN = "content article post entry story main text body article-body post-content entry-content story-body page-content".split()


class _Writer:
    """Writes one page; every part has its own label."""

    def __init__(self, seed: int) -> None:
        self.r = random.Random(seed)

    def word(self) -> str:
        return "".join(self.r.choices(_SYLLABLES, k=self.r.randint(1, 4)))

    def words(self, low: int, high: int) -> str:
        return " ".join(self.word() for _ in range(self.r.randint(low, high)))

    def sentence(self, low: int = 1, high: int = 18) -> str:
        text = self.words(low, high)
        if self.r.random() < 0.5:
            text = text.replace(" ", ", ", 1)
        return text[:1].upper() + text[1:] + self.r.choice("....?!")

    def prose(self, low: int = 1, high: int = 6) -> str:
        return " ".join(self.sentence() for _ in range(self.r.randint(low, high)))

    def named(self, names: Sequence[str], tag: str) -> str:
        key = self.r.choice(["class", "class", "id"])
        value = self.r.choice(names) + self.r.choice(["", "", "-" + self.word(), " " + self.word()])
        return f'<{tag} {key}="{value}"'

    def part(self, names: Sequence[str], tags: Sequence[str], inner: str, main: int = 0) -> str:
        tag = self.r.choice(tags)
        opening = self.named(names, tag) if tag in ("div", "section", "ul", "ol", "p", "span") or self.r.random() < 0.4 else f"<{tag}"
        return f'{opening} {MARK}="{main}">{inner}</{tag}>'

    def link(self) -> str:
        return f'<a href="/{self.word()}">{self.words(1, 3)}</a>'

    def menu(self) -> str:
        items = "".join(f"<li>{self.link()}</li>" for _ in range(self.r.randint(2, 9)))
        inner = self.r.choice([f"<ul>{items}</ul>", items, " | ".join(self.link() for _ in range(4))])
        return self.part(_MENU, ["nav", "nav", "div", "ul"], inner)

    def header(self) -> str:
        inner = self.r.choice([f"<h1>{self.words(1, 3)}</h1>", f"<div>{self.words(1, 4)}</div>", f"<p>{self.sentence()}</p>", self.link()])
        return self.part(_HEADER, ["header", "header", "div"], inner + self.r.choice(["", f"<p>{self.words(2, 6)}</p>", self.menu()]))

    def footer(self) -> str:
        inner = self.r.choice(
            [
                f"&copy; {self.word()}.{self.word()} &middot; {self.prose(1, 2)}",
                f"<p>&copy; 2020 {self.words(1, 4)}</p>",
                f"<p>{self.prose(1, 3)}</p>",
                "".join(f"<li>{self.link()}</li>" for _ in range(5)),
            ]
        )
        return self.part(_FOOTER, ["footer", "footer", "div"], inner)

    def side(self) -> str:
        items = "".join(f"<li>{self.link()}</li>" for _ in range(self.r.randint(2, 6)))
        inner = f"<h3>{self.words(1, 3)}</h3>" + self.r.choice([f"<ul>{items}</ul>", f"<p>{self.prose(1, 2)}</p>", f"<p>{self.prose(1, 4)}</p>" + items])
        return self.part(_SIDE, ["aside", "aside", "div", "section"], inner)

    def notice(self) -> str:
        inner = self.r.choice([self.prose(1, 2), f"<p>{self.prose(1, 3)}</p>"]) + self.r.choice(["", "<button>OK</button>", self.link()])
        return self.part(_NOTICE, ["div", "div", "section"], inner)

    def advert(self) -> str:
        inner = self.r.choice([self.prose(1, 2), f"<p>{self.prose(1, 2)}</p>", f"<span>{self.words(1, 6)}</span>", self.link()])
        return self.part(_ADVERT, ["div", "div", "aside", "section"], inner)

    def form(self) -> str:
        inner = f"<label>{self.words(1, 3)}</label><input><button>{self.word()}</button>"
        inner = self.r.choice(["", f"<p>{self.prose(1, 2)}</p>"]) + inner
        return self.part(_FORM, ["form"], inner)

    def comments(self) -> str:
        def one() -> str:
            text = self.r.choice([f"<p>{self.prose(1, 4)}</p>", self.prose(1, 3)])
            return self.r.choice([f'<div class="comment"><b>{self.word()}</b><p>{self.prose(1, 3)}</p></div>', f"<li>{text}</li>", f"<article>{text}</article>", f"<div>{text}</div>"])

        inner = self.r.choice(["", f"<h3>{self.words(1, 3)}</h3>"]) + "".join(one() for _ in range(self.r.randint(1, 5)))
        return self.part(_COMMENT, ["section", "div", "ol", "ul", "aside"], inner)

    def share(self) -> str:
        return self.part(_SHARE, ["div", "ul", "p"], self.r.choice([self.words(1, 4), " ".join(self.link() for _ in range(3))]))

    def article(self) -> str:
        # Short and long paragraphs, tables in bars and lists are all main text.
        parts = [self.r.choice([f"<h1>{self.words(2, 9)}</h1>", f"<header><h1>{self.words(2, 9)}</h1></header>", f"<h2>{self.sentence()}</h2>", ""])]
        plain = self.r.choice(["p", "p", "p", "div"])
        for _ in range(self.r.randint(1, 10)):
            kind = self.r.random()
            if kind < 0.72:
                text = self.r.choice([self.prose(1, 7), self.prose(1, 7), self.sentence(1, 2), self.words(1, 30)])
                if self.r.random() < 0.1:
                    text = text.replace(" ", " | ")
                if self.r.random() < 0.2:
                    text = text.replace(" ", " " + self.link() + " ", 1)
                parts.append(self.r.choice([f"<{plain}>{text}</{plain}>"] * 3 + [f"<{plain}><b>{text}<br><{plain}>{self.prose()}</{plain}>", f"<{plain}>{text}"]))
            elif kind < 0.8:
                level = self.r.randint(2, 4)
                parts.append(f"<h{level}>{self.words(1, 6)}</h{level}>")
            elif kind < 0.87:
                parts.append("<ul>" + "".join(f"<li>{self.r.choice([self.words(1, 5), self.sentence()])}</li>" for _ in range(3)) + "</ul>")
            elif kind < 0.91:
                parts.append(f"<blockquote>{self.r.choice(['<p>', ''])}{self.prose(1, 2)}</blockquote>")
            elif kind < 0.94:
                parts.append(f"<figure><figcaption>{self.words(2, 9)}</figcaption></figure>")
            elif kind < 0.97:
                parts.append("<table>" + "".join(f"<tr><td>{self.words(1, 3)}</td><td>{self.words(1, 2)}</td></tr>" for _ in range(3)) + "</table>")
            else:
                parts.append(f"<pre>{self.words(3, 12)}</pre>")
        for noise, chance in ((self.advert, 0.15), (self.share, 0.15), (self.side, 0.1), (self.form, 0.05), (self.notice, 0.08), (self.comments, 0.12)):
            if self.r.random() < chance:
                parts.insert(self.r.randint(1, len(parts)), noise())
        inner = "".join(parts)
        shape = self.r.random()
        if shape < 0.45:
            return f'<article {MARK}="1">{inner}</article>'
        if shape < 0.6:
            return f'<main {MARK}="1">{inner}</main>'
        if shape < 0.9:
            return self.part(_MAIN, ["div", "div", "section", "article"], inner, 1)
        return f'<div {MARK}="1">{inner}</div>'

    def page(self) -> str:
        r = self.r
        before = [p for p, c in ((self.header, 0.5), (self.menu, 0.8), (self.notice, 0.3), (self.advert, 0.5), (self.form, 0.2), (self.side, 0.15)) if r.random() < c]
        after = [p for p, c in ((self.comments, 0.4), (self.side, 0.35), (self.advert, 0.25), (self.form, 0.15), (self.share, 0.2), (self.menu, 0.2), (self.notice, 0.1)) if r.random() < c]
        r.shuffle(before)
        r.shuffle(after)
        main = self.article() if r.random() < 0.97 else ""
        if r.random() < 0.2:
            main = f'<div id="{r.choice(["wrapper", "page", "container", "site"])}">{main}</div>'
        body = "".join(p() for p in before) + main + "".join(p() for p in after) + (self.footer() if r.random() < 0.85 else "")
        return f"<!DOCTYPE html><html><head><title>{self.words(2, 8)}</title></head><body>{body}</body></html>"


def labelled_pages(count: int, seed: int = 1) -> Iterator[str]:
    """Pages in many layouts whose blocks are labelled by ``MARK``."""
    for i in range(count):
        yield _Writer(seed * 1_000_003 + i).page()


def train_extractor(pages: Sequence[str]) -> crf.Model:
    """Trains on pages labelled by ``MARK``."""
    blocks = [leaf_blocks(p, MARK) for p in pages]
    described = [describe(b) for b in blocks]
    # Names that occur on few pages tell nothing about others.
    seen = Counter(f for page in described for f in {f for block in page for f in block})
    common = [[[f for f in block if seen[f] >= LEAST_PAGES] for block in page] for page in described]
    return crf.train(common, [[int(x.marked) for x in b] for b in blocks])


@lru_cache(maxsize=1)
def default_extractor() -> crf.Model:
    return train_extractor(list(labelled_pages(TRAINING_PAGES)))


def main_text(page: str | None, model: crf.Model) -> str:
    blocks = leaf_blocks(page)
    labels = model.decode(model.scores(describe(blocks)))
    return "\n".join(b.text for b, keep in zip(blocks, labels) if keep)


def extract(pages: DataFrame, model: crf.Model | None = None, html_col: str = "html") -> DataFrame:
    """``pages`` without ``html_col``, with ``text`` and ``n_chars`` (its code points); input columns of these names go.

    Null or empty html, and pages without main text, give empty text. Equal pages give equal text, whatever stands
    beside them; an empty table gives no rows. Pages are handled one by one within their partition, whole.
    """
    model = default_extractor() if model is None else model
    rest = [c for c in pages.columns if c not in (html_col, "text", "n_chars")]
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pages.select(*rest).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in stretches(batch, "_html"):
                texts = [main_text(h, model) for h in part.column("_html").to_pylist()]
                kept = part.drop_columns(["_html"])
                yield pa.RecordBatch.from_arrays(
                    [*kept.columns, pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    names=[*rest, "text", "n_chars"],
                )

    rows = pages.select(*rest, F.col(html_col).cast("string").alias("_html"))
    return arrow_map(rows, run, f"{kinds}{', ' if kinds else ''}text string, n_chars bigint")
