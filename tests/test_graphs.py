"""Triangles, ranks and reachability against plain versions."""

import random
from itertools import combinations

import numpy as np
import pytest

from quernstone.operators.graphs import page_ranks, reachable, triangles


def some_edges(seed, nodes=40, n=150):
    """With a hub, loops, edges that are there twice and both ways, and nulls."""
    draw = random.Random(seed)
    edges = [(draw.randrange(nodes), draw.randrange(nodes)) for _ in range(n)] + [(0, i) for i in range(1, nodes)]
    return edges + [(b, a) for a, b in edges[:20]] + edges[:10] + [(5, 5), (None, 3), (4, None)]


@pytest.mark.parametrize("seed", [1, 2])
def test_triangles(spark, seed):
    edges = some_edges(seed)
    near = {i: set() for i in range(40)}
    for a, b in edges:
        if None not in (a, b) and a != b:
            near[a].add(b)
            near[b].add(a)
    want = {i: [len(s), 0] for i, s in near.items() if s}
    for u, v, w in combinations(range(40), 3):
        if v in near[u] and w in near[u] and w in near[v]:
            for x in (u, v, w):
                want[x][1] += 1
    got = triangles(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: [r.degree, r.triangles] for r in got} == want and sum(n for _, n in want.values()) > 100
    assert triangles(spark.createDataFrame([], "a long, b long")).collect() == []


def test_page_ranks(spark):
    edges = [(a, b) for a, b in some_edges(3) if a not in (7, 8)]  # two nodes without links of their own
    known = [(a, b) for a, b in edges if None not in (a, b)]
    nodes = sorted({x for e in known for x in e})
    m = np.zeros((len(nodes), len(nodes)))
    for a, b in known:
        m[nodes.index(b), nodes.index(a)] += 1
    out = m.sum(0)
    m = np.where(out > 0, m / np.where(out > 0, out, 1), 1 / len(nodes))
    ranks = np.full(len(nodes), 1 / len(nodes))
    for _ in range(200):
        ranks = 0.15 / len(nodes) + 0.85 * m @ ranks
    got = {r.node: r.rank for r in page_ranks(spark.createDataFrame(edges, "a long, b long"), rounds=40, tolerance=1e-7).collect()}
    assert {7, 8} & got.keys() and np.allclose([got[x] for x in nodes], ranks, atol=1e-6) and sum(got.values()) == pytest.approx(1)
    assert page_ranks(spark.createDataFrame([], "a long, b long")).collect() == []


def test_reachable(spark):
    edges = [(1, 2), (2, 3), (3, 1), (3, 4), (4, 5), (5, 6), (9, 1), (1, 2), (None, 7), (2, None)]
    frame, starts = spark.createDataFrame(edges, "a long, b long"), spark.createDataFrame([(1,), (1,), (None,)], "x long")
    assert {r.node: r.hops for r in reachable(frame, starts, 4).collect()} == {1: 0, 2: 1, 3: 2, 4: 3, 5: 4}
    assert {r.node: r.hops for r in reachable(frame, starts, 50).collect()} == {1: 0, 2: 1, 3: 2, 4: 3, 5: 4, 6: 5}
