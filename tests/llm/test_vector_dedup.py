from __future__ import annotations

import numpy as np
import pytest

from thermocline.llm import common
from thermocline.llm.components import components
from thermocline.llm.vector_dedup import near_duplicate_vectors

ODD = [None, [0.0] * 8, [float("nan")] + [1.0] * 7, [float("inf")] + [1.0] * 7, [None] + [1.0] * 7, [], [1.0, 0.0]]


def brute(rows, cosine):
    """n_links and component of each row's position."""
    ok = lambda v: v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v)
    good = [k for k, (_, v) in enumerate(rows) if ok(v)]
    links = {k: set() for k in range(len(rows))}
    for k in good:
        for m in good:
            a, b = np.array(rows[k][1], np.float32).astype(float), np.array(rows[m][1], np.float32).astype(float)
            if k != m and len(a) == len(b) and a @ b / np.sqrt((a @ a) * (b @ b)) >= cosine:
                links[k].add(m)
    out = []
    for k in links:
        seen, todo = {k}, [k]
        while todo:
            new = links[todo.pop()] - seen
            seen |= new
            todo += new
        ids = [rows[m][0] for m in seen if rows[m][0] is not None]
        out.append((rows[k][0], len(links[k]), min(ids) if ids else None))
    return sorted(map(str, out))


@pytest.mark.parametrize("block", [4096, 8])
def test_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(common, "HOT_ROWS", 4)
    rng = np.random.default_rng(block)
    base = rng.normal(size=(6, 8))
    vectors = [base[k % 6] + rng.normal(size=8) * (0.02 if k % 3 else 0.35) for k in range(90)]
    rows = [(k, [float(np.float32(x)) for x in v]) for k, v in enumerate(vectors)]
    rows += [(100 + k, rows[5][1]) for k in range(9)] + [(5, rows[5][1]), (None, rows[7][1]), (None, None)] + [(200 + k, v) for k, v in enumerate(ODD)]
    df = spark.createDataFrame([(i, v, 1, True) for i, v in rows], "vec_id long, embedding array<float>, label int, node boolean").repartition(5)
    got = near_duplicate_vectors(df, block=block).collect()
    assert sorted(str((r.vec_id, r.n_links, r.component_id)) for r in got) == brute(rows, 0.9)
    assert all(r.kept == (r.vec_id is not None and r.vec_id == r.component_id) for r in got)


def test_empty(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert near_duplicate_vectors(df).count() == 0
    assert near_duplicate_vectors(spark.createDataFrame([(1, None)], "vec_id long, embedding array<float>")).collect()[0].kept


def test_components_of_paths_and_stars(spark):
    edges = [(k, k + 1) for k in range(0, 40)] + [(100, k) for k in range(101, 140)] + [(7, 7), (300, 300), (201, 200), (200, 201)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: 0 for k in range(41)} | {k: 100 for k in range(100, 140)} | {200: 200, 201: 200}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
