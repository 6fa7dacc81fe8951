"""Centroid clustering against a plain version."""

import hashlib
import math

import numpy as np
import pytest

from ledgerlane.llm import centroids as K
from tests.llm.helpers import same_rows

ROW = "vec_id bigint, embedding array<double>"


def plain(rows, dim, k, rounds):
    kept = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    start = sorted((hashlib.sha256(f"2:{'' if i is None else i}".encode()).hexdigest(), v) for i, v in kept)[:k]
    cent = [v for _, v in start]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(cent)) for _, v in kept]

    for _ in range(rounds):
        near = [j for _, j in assign()]
        for j in range(len(cent)):
            mine = [v for (_, v), g in zip(kept, near) if g == j]
            if mine:
                cent[j] = [sum(x) // len(mine) for x in zip(*mine)]
    last = assign()
    inertia = {}
    for d, j in last:
        inertia[j] = inertia.get(j, 0) + d
    return [(i, tuple(v), j, d, inertia[j], sum(inertia.values()), tuple(cent[j])) for (i, v), (d, j) in zip(kept, last)]


def got(spark, rows, dim, k, rounds):
    out = K.cluster_vectors(spark.createDataFrame(rows, ROW), dim=dim, k=k, rounds=rounds)
    return [(r["id"], tuple(r["vec"]), r["cluster"], r["distance"], r["cluster_inertia"], r["inertia"], tuple(r["centroid"])) for r in out.collect()]


def vectors(n, dim, seed, scale=1.0):
    rng = np.random.default_rng(seed)
    return [(i, (rng.normal(0, scale, dim) + rng.integers(0, 4)).tolist()) for i in range(n)]


@pytest.mark.parametrize("rounds", [0, 1, 3])
def test_matches_plain(spark, rounds):
    rows = vectors(300, 5, 1)
    same_rows(got(spark, rows, 5, 12, rounds), plain(rows, 5, 12, rounds))


def test_hard_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = vectors(40, 3, 2) + [(1, None), (2, []), (3, [1.0, 2.0]), (4, [1.0, None, 2.0]), (5, [nan, 0.0, 0.0]), (6, [0.0, -inf, 0.0]), (7, [0.0] * 4),
                                (None, [1.0, 1.0, 1.0]), (None, [1.0, 1.0, 1.0]), (8, [0.5] * 3), (8, [0.5] * 3), (8, [0.25] * 3), (-9, [-0.001, 0.0, -0.0])]
    rows += [(100 + i, [2.0, 2.0, 2.0]) for i in range(30)]  # ties everywhere
    same_rows(got(spark, rows, 3, 20, 4), plain(rows, 3, 20, 4))


def test_fewer_vectors_than_centroids_and_empty_clusters(spark):
    rows = [(i, [1.0, 1.0]) for i in range(5)] + [(9, [-1.0, 3.0])]
    same_rows(got(spark, rows, 2, 40, 2), plain(rows, 2, 40, 2))
    assert got(spark, [], 2, 40, 2) == []


def test_large_components_are_exact_and_too_large_ones_refused(spark):
    top = (K.component_limit(4) - 1) / 256
    rows = [(1, [top, -top, top, -top]), (2, [-top, top, -top, top]), (3, [top, top, -top, 0.0])]
    same_rows(got(spark, rows, 4, 2, 2), plain(rows, 4, 2, 2))
    with pytest.raises(Exception, match="too large"):
        got(spark, [(1, [1e30, 0.0, 0.0, 0.0])], 4, 2, 1)


def test_bounds_skip_most_distances():
    # The search gives the plain answer and computes a part of the distances only.
    rng = np.random.default_rng(4)
    cent = rng.integers(-300, 300, (200, 8)) + rng.integers(-4000, 4000, (200, 1))
    x = rng.integers(-300, 300, (1000, 8)) + rng.integers(-4000, 4000, (1000, 1))
    near, d, work = K.Search(cent).nearest(x)
    every = ((x[:, None, :] - cent[None]) ** 2).sum(2)
    assert (near == every.argmin(1)).all() and (d == every.min(1)).all()
    assert work < every.size / 10


def test_other_columns(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0], "x", 5), (2, [3.0, 4.0], "y", 6)], "vec_id bigint, embedding array<float>, id string, cluster int")
    assert sorted(r["id"] for r in K.cluster_vectors(df, dim=2, k=1).collect()) == [1, 2]
