"""Connected components against a plain union-find."""

import numpy as np
import pytest

from ledgerlane.llm.components import components


def brute(edges):
    root = {x: x for e in edges for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {x: find(x) for x in root}


RNG = np.random.default_rng(11)
GRAPHS = {
    "empty": [],
    "chain": [(i, i + 1) for i in range(70)][::-1],
    "star": [(500, i) for i in range(100)] + [(-3, 500)],
    "random": [tuple(int(x) for x in e) for e in RNG.integers(-200, 200, (180, 2)) if e[0] != e[1]],
    "repeats": [(1, 2), (2, 1), (1, 2), (3, 3), (9, 8)],
}


@pytest.mark.parametrize("name", GRAPHS)
def test_components(spark, name):
    edges = GRAPHS[name]
    got = components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    assert len(got) == len({r.node for r in got})
    assert {r.node: r.root for r in got} == brute([e for e in edges if e[0] != e[1]])
