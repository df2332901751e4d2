"""Exact vector neighbours: clusters, blocks and bounds never change a result."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillwork.operators import vectors


def brute(q, v, k, low=-2.0, high=2.0):
    unit = lambda m: m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-300)
    out = []
    for i, x in zip(*q, strict=True):
        s = np.round(unit(v[1]) @ unit(x[None])[0], 12)
        good = sorted((-float(c), int(n)) for c, n in zip(s, v[0], strict=True) if n != i and low <= c <= high)[:k]
        out += [(int(i), n, round(-c, 9), r + 1) for r, (c, n) in enumerate(good)]
    return sorted(out)


def clustered(n: int, dim: int, groups: int, spread: float, seed: int = 5) -> np.ndarray:
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(groups, dim))
    # a third of all rows in one group
    of = np.where(rng.random(n) < 0.33, 0, rng.integers(0, groups, n))
    return centres[of] + spread * rng.normal(size=(n, dim))


@pytest.mark.parametrize("spread, band", [(0.1, (-2.0, 2.0)), (0.1, (0.2, 0.9)), (1.5, (-2.0, 2.0))])
def test_neighbours_are_brute_force(spark, monkeypatch, spread, band):
    monkeypatch.setattr(vectors, "A_CLUSTER", 60)
    m = clustered(900, 12, 12, spread)
    m[[7, 8]] = 0.0
    m[20] = m[21] = m[22]
    ids = np.arange(len(m))
    df = spark.createDataFrame([(int(i), x.tolist(), "other") for i, x in zip(ids, m, strict=True)] + [(5_000, None, "other")], "id long, e array<double>, v string").repartition(3)
    report: dict = {}
    got = vectors.top_k(df.where(F.col("id") % 9 == 0), df, "id", "e", 4, *band, block=100, report=report)
    asked = ids % 9 == 0
    assert sorted((r.query, r.neighbour, round(r.score, 9), r.rank) for r in got.collect()) == brute((ids[asked], m[asked]), (ids, m), 4, *band)
    assert report["compared"] > 0 and (report["skipped"] > report["compared"] / 2 or spread > 1 or band[0] > 0)


def test_neighbours_of_odd_input(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, None), (3, [0.0, 0.0])], "id long, e array<double>")
    assert sorted((r.query, r.neighbour, r.score) for r in vectors.top_k(df, df, "id", "e", 5).collect()) == [(1, 3, 0.0), (3, 1, 0.0)]
    assert vectors.top_k(df.limit(0), df, "id", "e", 5).count() == 0 and vectors.top_k(df, df.limit(0), "id", "e", 5).count() == 0


def test_blocks_grow_with_the_table_and_floors_hold_back_scores(spark, monkeypatch):
    """A table of many blocks is dealt into fewer, larger ones; a block gives back what reaches each query's own floor, ties included."""
    m = np.random.default_rng(1).normal(size=(600, 8))
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(m)], "id long, e array<double>")
    found, compared = [], []
    for larger in (1, 8):
        for name, value in (("BLOCK", 30), ("A_CLUSTER", 15), ("BLOCKS", 4), ("LARGER", larger)):
            monkeypatch.setattr(vectors, name, value)
        report: dict = {}
        found.append(sorted((r.query, r.neighbour, round(r.score, 9), r.rank) for r in vectors.top_k(df, df, "id", "e", 3, 0.2, 0.7, report=report).collect()))
        compared.append(report["compared"])
    assert found[0] == found[1] == brute((np.arange(600), m), (np.arange(600), m), 3, 0.2, 0.7) and compared[1] * 8 < compared[0]
    y = np.array([[1.0, 0.0], [0.6, 0.8], [0.6, -0.8], [0.0, 1.0]])
    best = vectors._best(np.array([10, 11]), y[[0, 0]], np.arange(4), y, 3, np.array([0.6, 0.9]), 2.0)
    assert best.values.tolist() == [[10, 0, 1.0], [10, 1, 0.6], [10, 2, 0.6], [11, 0, 1.0]]
