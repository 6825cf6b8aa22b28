from __future__ import annotations

import math

import numpy as np
import pytest

from thermocline.llm import hard_negatives as H

DDL = "vec_id long, embedding array<double>, label int, score string, row string, rank string, v string, part string, anchor string"


def frame(spark, rows):
    return spark.createDataFrame([(i, e, k, "a", "b", "c", "d", "e", "f") for i, e, k in rows], DDL)


def brute_force(rows):
    """By the definition, row against row, in Python integers."""
    use = []
    for n, (i, e, k) in enumerate(rows):
        if k is None or e is None or any(x is None or not math.isfinite(x) for x in e):
            continue
        v = [math.floor(x * 256) for x in e]
        if sum(x * x for x in v) < 2**62:
            use.append((n, i, k, v))
    last = lambda i: (i is None, i or 0)
    out = []
    for n, i, k, v in use:
        if i is None or i % 50:
            continue
        scored = [(sum(a * b for a, b in zip(v, w, strict=True)), j, m, q) for q, j, m, w in use if q != n and len(w) == len(v)]
        scored.sort(key=lambda s: (-s[0], last(s[1]), s[3]))
        for p, j, *_ in [s for s in scored if s[2] == k][:5]:
            fits = [s for s in scored if s[2] != k and 50 * p <= 100 * s[0] <= 95 * p][:3]
            out += [(i, j, r, s[1], p, s[0]) for r, s in enumerate(fits, 1)]
    return sorted(out, key=str)


def mined(df, **options):
    return sorted((tuple(r) for r in H.mine_hard_negatives(df, **options).collect()), key=str)


@pytest.mark.parametrize("seed, block, batch", [(1, 7, 2), (2, 64, 1024)])
def test_equals_brute_force(spark, seed, block, batch):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(4, 6))
    rows = []
    for n in range(160):
        e = (centres[rng.integers(4)] + 0.2 * rng.normal(size=6)).round(1).tolist()
        rows.append((int(n if n % 9 else 50 * (n // 9)), e, int(rng.integers(3)) if n % 4 else 1))
    rows += [rows[0], rows[0], rows[3], (100, [0.0] * 6, 1), (101, [0.0] * 6, 2), (None, rows[1][1], 2), (None, rows[2][1], 1)]
    rows += [(150, None, 1), (151, [None] * 6, 1), (200, [float("nan")] * 6, 0), (250, [float("inf")] + [0.0] * 5, 0), (300, rows[5][1], None)]
    rows += [(350, [1.0, 2.0], 1), (351, [1.0, 2.5], 1), (352, [0.5, 1.0], 2), (400, [], 0), (401, [], 0), (402, [], 1), (450, [1e30] * 6, 1)]
    assert mined(frame(spark, rows), block=block, batch=batch) == brute_force(rows)


def test_large_components_are_exact(spark):
    big = [(n, [2.0**22 - n, 2.0**21 + 3 * n, -(2.0**20)], n % 2) for n in range(0, 60)]
    assert mined(frame(spark, big), block=16) == brute_force(big)


def test_ties_and_one_large_label(spark):
    rows = [(n, [1.0, 0.0], 0) for n in range(120)] + [(500 + n, [0.9, float(n % 3)], 1) for n in range(40)]
    assert mined(frame(spark, rows), block=16, batch=2) == brute_force(rows)


def test_empty_table(spark):
    assert mined(frame(spark, []).limit(0)) == []


def test_cover_tree_covers_and_parts():
    rng = np.random.default_rng(3)
    points = (256 * (rng.normal(size=(9, 8))[rng.integers(9, size=700)] + 0.05 * rng.normal(size=(700, 8)))).astype(np.int64)
    tree = H.CoverTree(points, leaf=8)
    lift = np.sqrt(np.maximum(0, tree.norm**2 - (points.astype(float) ** 2).sum(axis=1)))
    x = np.column_stack([points, lift])
    seen = []

    def walk(node, centre):
        below = []
        for c, r, child, new in zip(*tree.nodes[node], strict=True):
            own = [c] if new else []
            own += walk(child, c) if child >= 0 else []
            assert all(np.linalg.norm(x[i] - x[c]) <= r + tree.slack for i in own)
            assert new or c == centre
            below += own
        return below

    assert sorted(walk(tree.root, 0)) == list(range(700)) and not seen
    for centres, chords, below, _ in tree.nodes:
        inner = centres[below >= 0]
        if len(inner) > 1:  # centres of a level lie further apart than half of its radius
            d = np.linalg.norm(x[inner][:, None] - x[inner][None], axis=2)[np.triu_indices(len(inner), 1)]
            assert d.min() >= chords.max() / 2


def test_descent_skips_what_cannot_count(monkeypatch):
    rng = np.random.default_rng(4)
    points = (256 * (rng.normal(size=(40, 16))[rng.integers(40, size=2000)] + 0.02 * rng.normal(size=(2000, 16)))).astype(np.int64)
    tree, verified = H.CoverTree(points), []
    plain = tree.products
    monkeypatch.setattr(tree, "products", lambda a, at: verified.append(len(at)) or plain(a, at))
    anchor = points[:1]
    low, high = np.array([H.LEAST]), np.array([H.MOST])
    w, p, s = H.search(tree, anchor, np.array([0]), low, high, 5, lambda w, p: p == 0)
    order = np.lexsort((np.arange(2000), -(points @ anchor[0])))
    assert p.tolist() == [i for i in order.tolist() if i][:5]
    assert sum(verified) < 800
