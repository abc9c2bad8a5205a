"""Linked vectors, against all pairs."""

import numpy as np
import pytest

from ledgerloom.llm import vectors as module
from ledgerloom.llm.vectors import link_vectors, merge, tile_links

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def plain(rows, least=0.98):
    def unit(v):
        if v is None or not v or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            return None
        x = np.array(v, np.float32).astype(float)
        x = x / np.abs(x).max()
        return x / np.sqrt((x * x).sum())

    units = [unit(v) for _, v, _ in rows]
    n, label = [0] * len(rows), list(range(len(rows)))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for i, (_, _, a) in enumerate(rows):
        for j in range(i):
            u, v = units[i], units[j]
            if u is None or v is None or a is None or a != rows[j][2] or len(u) != len(v) or u @ v < least:
                continue
            n[i] += 1
            n[j] += 1
            x, y = sorted((root(i), root(j)))
            label[y] = x
    names = {}
    for i, (k, _, _) in enumerate(rows):
        names.setdefault(root(i), []).append(k)
    out = []
    for i, (k, _, _) in enumerate(rows):
        known = [x for x in names[root(i)] if x is not None]
        name = min(known) if known else None
        out.append((k, n[i], name, name is None or k == name))
    return sorted(out, key=str)


def cloud(seed=5):
    r = np.random.default_rng(seed)
    rows = []
    for label, many in ((1, 90), (2, 25), (None, 4)):
        for _ in range(many):
            rows.append((r.normal(size=16), label))
    base = r.normal(size=16)
    # A dense group, a chain of neighbours, and scaled copies.
    rows += [(base + r.normal(size=16) * 0.06, 1) for _ in range(60)]
    angle = np.cumsum(np.full(20, np.arccos(0.985)))
    rows += [(np.r_[np.cos(a), np.sin(a), np.zeros(14)] * (k + 1), 2) for k, a in enumerate(angle)]
    rows += [(base * 3, 1), (base * 1e-30, 1), (base * 1e30, 1), (base, 2), (-base, 1), (base, None)]
    order = r.permutation(len(rows))
    out = [(int(i) * 3 + 1, [float(x) for x in np.float32(rows[k][0])], rows[k][1]) for i, k in enumerate(order)]
    out += [(9001, None, 1), (9002, [], 1), (9003, [0.0] * 16, 1), (9004, [1.0] + [None] * 15, 1), (9005, [float("nan")] * 16, 1)]
    out += [(9006, [float("inf")] * 16, 1), (9007, [1.0, 2.0], 1), (9008, [2.0, 4.0], 1), (9009, [3.0], 1), (9010, [3.0], 2)]
    return out + out[:5] * 3 + [(None, out[0][1], out[0][2]), (None, [5.0, -4.0, 1.0], 7), (out[1][0], out[3][1], out[3][2])]


@pytest.mark.parametrize("block, visitors, meetings", [(2048, 32, 64), (7, 2, 3)])
def test_like_all_pairs(spark, monkeypatch, block, visitors, meetings):
    for name, value in (("BLOCK_ROWS", block), ("VISITORS", visitors), ("MEETINGS", meetings)):
        monkeypatch.setattr(module, name, value)
    rows = cloud()
    vectors = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'mine' AS component_id", "1 AS id", "2 AS block", "3 AS vector")
    out = link_vectors(vectors.repartition(3))
    assert out.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert sorted((tuple(r) for r in out.collect()), key=str) == plain(rows)


def test_other_thresholds_and_empty_table(spark):
    rows = cloud(8)
    vectors = spark.createDataFrame(rows, SCHEMA)
    for least in (0.6, 1.0):
        found = link_vectors(vectors, least=least).collect()
        if least < 1:
            assert sorted((tuple(r) for r in found), key=str) == plain(rows, least)
        else:
            assert len(found) == len(rows)
    assert link_vectors(vectors.limit(0)).count() == 0
    assert link_vectors(vectors.where("label IS NULL")).where("n_links > 0 OR NOT kept").count() == 0
    with pytest.raises(ValueError, match="least cosine"):
        link_vectors(vectors, least=0.0)


def test_tiles_stop_early_and_lose_no_pair():
    r = np.random.default_rng(2)
    x, y = r.normal(size=(300, 64)), r.normal(size=(200, 64))
    y[:80] = x[:80] + r.normal(size=(80, 64)) * 0.05

    class Side(module._Side):
        def __init__(self, v, axes):
            self.unit = module._unit(v)
            self.turned = self.unit @ axes
            tails = np.sqrt(np.cumsum(np.square(self.turned[:, ::-1]), axis=1)[:, ::-1])
            self.rest, self.ids = np.hstack([tails, np.zeros((len(v), 1))]), np.arange(len(v))

    axes = np.linalg.eigh(module._unit(x).T @ module._unit(x))[1][:, ::-1]
    a, b = Side(x, axes), Side(y, axes)
    for least in (0.98, 0.9, 0.2, -0.5):
        want = np.nonzero(a.unit @ b.unit.T >= least)
        assert [p.tolist() for p in tile_links(a, b, least)] == [p.tolist() for p in want]


def test_merge_names_components_by_least_row():
    assert merge(np.arange(6), np.array([5, 4, 3]), np.array([4, 2, 0])).tolist() == [0, 1, 2, 0, 2, 2]
