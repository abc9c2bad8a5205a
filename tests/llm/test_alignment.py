"""Cross-tokenizer alignment, against a plain version that encodes with another library and compares all pairs."""

import bisect
import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from ledgerloom.llm import alignment
from ledgerloom.llm.alignment import align_corpus, aligned, coalesce, number_of_pieces, ship

BPE, PIECES = "/opt/tokenizers/byte_bpe_50k.json", "/opt/tokenizers/piece_bpe_32k.model"


def plain_tokens():
    bpe = Tokenizer.from_file(BPE)
    bpe.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    letters = {v: k for k, v in alignment._byte_letters().items()}
    back = {letter: byte for byte, letter in letters.items()}

    def encode(text):
        a = [(i, bytes(back[c] for c in bpe.id_to_token(i))) for i in bpe.encode(" " + text, add_special_tokens=False).ids]
        b = []
        for i in sp.encode(text):
            piece = sp.id_to_piece(i)
            b.append((i, bytes([int(piece[3:-1], 16)]) if sp.is_byte(i) else piece.replace("▁", " ").encode()))
        return a, b

    return encode


def plain(texts):
    """Per text: counts, groups as text, and the linked id pairs with repeats."""
    encode, out = plain_tokens(), []
    for text in texts:
        if not text:
            out.append((0, 0, 0, 0, "", []))
            continue
        a, b = encode(text)
        raw = b" " + text.encode()
        if b"".join(x for _, x in a) != raw or b"".join(x for _, x in b) != raw:
            out.append((0, 0, 0, 0, "", []))
            continue
        spans = []
        for tokens in (a, b):
            at, side = 0, []
            for i, x in tokens:
                side.append((at, at + len(x), i))
                at += len(x)
            spans.append(side)
        cuts = sorted({e for _, e, _ in spans[0]} & {e for _, e, _ in spans[1]})
        held = [([], []) for _ in cuts]
        for n, side in enumerate(spans):
            for s, _, i in side:
                held[bisect.bisect_right(cuts, s)][n].append(str(i))
        groups = ["|".join(map(",".join, x)) for x in held]
        links, j = [], 0
        for s, e, i in spans[0]:
            while spans[1][j][1] <= s:
                j += 1
            k = j
            while k < len(spans[1]) and spans[1][k][0] < e:
                links.append((i, spans[1][k][2]))
                k += 1
        out.append((len(a), len(b), len(groups), len(links), ";".join(groups), links))
    return out


def texts():
    r = random.Random(7)
    letters = "abc de fgh \n\t.,'<>|;0123"
    out = ["", None, " ", "Hello  world", "a", "<|endoftext|> and </s><s>", "▁ marks", "tab\there\n\n\nlines", "éè 你好 \U0001f600 กำ", "don't 've 12345"]
    out += ["".join(r.choice(letters) for _ in range(r.randrange(1, 200))) for _ in range(40)]
    out += ["".join(chr(r.choice([r.randrange(32, 127), r.randrange(160, 0x2FF), r.randrange(0x4E00, 0x4F00), 32])) for _ in range(60)) for _ in range(20)]
    out += ["the same words again and again"] * 7 + [" ".join(["long text of many words,"] * 4000)]
    return out


def expected(rows):
    found = plain([t for _, t in rows])
    count = Counter(p for x in found for p in set(x[5]))
    most = defaultdict(int)
    for (a, _), n in count.items():
        most[a] = max(most[a], n)
    return sorted(
        (i, *x[:5], sum(count[p] == most[p[0]] for p in x[5]), sum(count[p] for p in x[5]))
        for (i, _), x in zip(rows, found)
    )


@pytest.mark.parametrize("slice_pairs, lookup", [(2_000_000, 2_000_000), (150, 40)])
def test_like_all_pairs(spark, monkeypatch, slice_pairs, lookup):
    monkeypatch.setattr(alignment, "SLICE_PAIRS", slice_pairs)
    monkeypatch.setattr(alignment, "_LOOKUP", lookup)
    rows = list(enumerate(texts()))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "'x' AS groups", "1 AS row", "2 AS pairs")
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "n_best", "count_sum"]
    out = align_corpus(docs.repartition(3), ship(spark, BPE, PIECES), number_of_pieces(PIECES))
    assert set(out.columns) == set(names)
    assert sorted(tuple(r[n] for n in names) for r in out.collect()) == expected(rows)


def test_digest_repeats_nulls_and_empty_table(spark):
    both = ship(spark, BPE, PIECES)
    docs = spark.createDataFrame([(1, "one two"), (1, "one two"), (None, "one two")], "doc_id bigint, text string")
    out = align_corpus(docs, both, number_of_pieces(PIECES), digest=True).collect()
    assert len({(r.groups, r.n_links, r.count_sum) for r in out}) == 1 and len(out) == 3
    assert out[0].count_sum == 3 * out[0].n_links == 3 * out[0].n_best
    text = aligned(docs, both).first().groups
    assert out[0].groups == hashlib.sha256(text.encode()).hexdigest()
    assert align_corpus(docs.limit(0), both, number_of_pieces(PIECES)).count() == 0


def test_coalesce_covers_and_overlaps():
    r = np.random.default_rng(3)
    for _ in range(200):
        cuts = [np.unique(np.append(r.integers(1, 60, r.integers(1, 30)), 60)) for _ in range(2)]
        a, b = (np.diff(c, prepend=0) for c in cuts)
        group_a, group_b, left, right = coalesce(a, b)
        both = np.intersect1d(*cuts)
        assert (group_a == np.searchsorted(both, cuts[0])).all() and (group_b == np.searchsorted(both, cuts[1])).all()
        want = [(i, j) for i in range(len(a)) for j in range(len(b)) if cuts[0][i] - a[i] < cuts[1][j] and cuts[1][j] - b[j] < cuts[0][i]]
        assert list(zip(left.tolist(), right.tolist())) == want
