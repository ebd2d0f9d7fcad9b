"""Hard negatives against a full sort, odd rows, the tree."""

import math
import random

import numpy as np

from tessella.llm import hard_negatives as hn


def rows(seed, count, dim=8, copies=0):
    rng = random.Random(seed)
    made = [(i, [rng.gauss(0.3, 0.4) for _ in range(dim)], rng.randrange(3)) for i in range(count)]
    return made + [(1000 + i, [0.5] * dim, i % 2) for i in range(copies)]


ODD = [
    (5, [0.5] * 8, 1), (7, [0.1] * 8, 2), (7, [0.1] * 8, 0), (2000, None, 1), (2001, [None] * 8, 1), (2002, [float("nan")] * 8, 0), (2003, [float("inf")] * 8, 0),
    (None, [1.0] * 8, 1), (2004, [0.2] * 8, None), (2100, [1.0, 2.0], 1), (2101, [3.0, 1.0], 1), (2105, [2.9, 1.0], 0), (2110, [], 0), (2115, [0.0] * 8, 1), (2120, [-0.5] * 8, 2),
]


def plain(rows, anchors, positives=5, negatives=3):
    usable = lambda r: r[0] is not None and r[2] is not None and r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])
    whole = [(i, [math.floor(256 * x) for x in v], g) for i, v, g in filter(usable, rows)]
    out = []
    for i, v, g in whole:
        if not anchors(i):
            continue
        scores = sorted((-sum(a * b for a, b in zip(v, w)), j, h) for j, w, h in whole if j != i and len(w) == len(v))
        for p, j, _ in [s for s in scores if s[2] == g][:positives]:
            fit = [(n, k) for n, k, h in scores if h != g and 50 * -p <= 100 * -n <= 95 * -p][:negatives]
            out += [(i, j, rank, k, -p, -n) for rank, (n, k) in enumerate(fit, 1)]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, g, 1, 2, "x") for i, v, g in rows], "vec_id long, embedding array<double>, label int, score int, block int, id string")


def mined(spark, data, condition="vec_id % 5 = 0"):
    whole = frame(spark, data)
    return sorted(map(tuple, hn.hard_negatives(whole, whole.where(condition)).collect()))


def test_against_sort(spark):
    data = rows(1, 400, copies=40) + ODD
    got = mined(spark, data)
    assert got == plain(data, lambda i: i % 5 == 0) and len(got) > 500


def test_small_blocks_and_slabs(spark, monkeypatch):
    monkeypatch.setattr(hn, "BLOCK", 7)
    monkeypatch.setattr(hn, "_SLAB", 13)
    data = rows(2, 200, dim=5, copies=30)
    assert mined(spark, data) == plain(data, lambda i: i % 5 == 0)


def test_large_values(spark):
    data = [(i, [float(i * 10**6), -3.5e6, 2e6], i % 2) for i in range(-10, 11)]
    assert mined(spark, data) == plain(data, lambda i: i % 5 == 0)
    huge = [(i, [1e300 * (i % 3), 2e10], i % 2) for i in range(20)]
    assert isinstance(mined(spark, huge), list)


def test_no_rows(spark):
    assert mined(spark, []) == []
    assert mined(spark, rows(3, 4), "vec_id < 0") == []


def test_tree_is_spanning_and_minimal():
    rng = np.random.default_rng(0)
    vecs = rng.integers(-200, 200, (60, 6))
    order, parents, edges = hn.spanning_tree(vecs)
    assert sorted(order) == list(range(60)) and all(p < i for i, p in enumerate(parents))
    for i in range(1, 60):
        assert abs(np.linalg.norm((vecs[order[i]] - vecs[order[parents[i]]]).astype(float)) - edges[i]) < 1e-9
    # each edge is the shortest between its child and the tree before it
    for i in range(1, 60):
        assert edges[i] <= min(np.linalg.norm((vecs[order[j]] - vecs[order[k]]).astype(float)) for j in range(i) for k in range(i, 60)) + 1e-9


def test_bounds_spare_scores_and_lose_none():
    rng = np.random.default_rng(1)
    middle = rng.normal(0, 300, (1, 16))
    anchors = (middle + rng.normal(0, 3, (40, 16))).round().astype(np.int64)
    order, parents, edges = hn.spanning_tree(anchors)
    block = {"vecs": anchors[order], "parents": parents, "edges": edges}
    vecs = rng.normal(0, 100, (2000, 16)).round().astype(np.int64)
    run = hn._Run(np.arange(2000), np.zeros(2000, np.int64), vecs)
    exact = vecs @ block["vecs"].T
    least = np.sort(exact, axis=0)[-10]
    scored = {}
    hn._down_the_tree(block, run.slabs[0], lambda place: (np.ones(2000, bool), least[place], np.inf), lambda place, near, scores: scored.update({place: dict(zip(near.tolist(), scores.tolist()))}))
    for place, found in scored.items():
        want = np.flatnonzero(exact[:, place] >= least[place])
        assert all(found[i] == exact[i, place] for i in want.tolist())
    assert sum(map(len, scored.values())) < 2000 * 40 / 4
