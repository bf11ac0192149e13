"""Exact top-k against all pairs, with few and many cells and blocks."""

import math

import numpy as np
import pytest

from rosterlake.llm import voronoi as V


def plain(rows, k, every):
    clean = [(i, [math.floor(256 * x) for x in v]) for i, v in rows
             if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    queries = {}
    for i, v in clean:
        if i % every == 0:
            queries[i] = min(v, queries.get(i, v))
    out = []
    for q, v in queries.items():
        scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in clean if i != q)[:k]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored)]
    return sorted(out)


def run(spark, rows, kind="array<float>", **more):
    df = spark.createDataFrame([(i, v, 1, "c") for i, v in rows], f"vec_id long, embedding {kind}, cell int, score string").repartition(3)
    return sorted((r.query_id, r.rank, r.vec_id, r.score) for r in V.voronoi_top_k(df, **more).collect())


@pytest.mark.parametrize("pivots,block_rows", [(1, 10_000), (5, 7), (64, 50)])
def test_clusters_copies_and_ties(spark, pivots, block_rows):
    rng = np.random.default_rng(pivots)
    centres = rng.normal(size=(6, 8))
    rows = [(i, np.float32(centres[i % 6] + 0.2 * rng.normal(size=8)).tolist()) for i in range(400)]
    rows += [(i, rows[7][1]) for i in range(400, 700)]  # one vector of a large share
    rows += [(i, [0.0] * 8) for i in range(700, 720)]
    assert run(spark, rows, pivots=pivots, block_rows=block_rows, group_queries=4) == plain(rows, 5, 50)


def test_edges(spark):
    rows = [(0, [1.0, 2.0]), (50, [0.5]), (50, [0.25, 9.0]), (3, None), (4, []), (5, [None, 1.0]), (6, [float("nan"), 1.0]), (7, [float("inf"), 1.0]), (None, [1.0, 1.0]),
            (-50, [-1.0, -0.001]), (9, [1e5, -1e5]), (9, [1e5, -1e5]), (100, [-0.0, 3.0])]
    assert run(spark, rows, kind="array<double>") == plain(rows, 5, 50)
    assert run(spark, rows[:1]) == [] and run(spark, []) == [] and run(spark, [(1, [1.0]), (2, [1.0])]) == []
    assert run(spark, [(0, [1.0]), (1, [1.0])]) == [(0, 1, 1, 65536)]


def test_bounds_spare_visits(spark, monkeypatch):
    """Far cells are not visited: fewer candidates reach the blocks than there are."""
    rng = np.random.default_rng(1)
    centres = 10 * np.eye(8)
    rows = [(i, (centres[i % 8] + 0.1 * rng.normal(size=8)).tolist()) for i in range(800)]
    asked = []
    solve = V._solve
    monkeypatch.setattr(V, "_solve", lambda data, visits, k, dim: (asked.append(visits.count()), solve(data, visits, k, dim))[1])
    assert run(spark, rows, kind="array<double>", pivots=16) == plain(rows, 5, 50)
    assert asked[0] == 16 and asked[1] < 16 * 8
