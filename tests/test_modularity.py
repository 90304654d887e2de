"""Communities against plain code, and against rounds of labels."""

from __future__ import annotations

import random

import pytest

from tidewright.operators.design import communities
from tidewright.operators.modularity import modular_communities, modularity


def plain(pairs):
    links = {(min(a, b), max(a, b)): 1 for a, b in pairs if a is not None and b is not None and a != b}
    label = {n: n for p in pairs for n in p if n is not None}
    m = len(links)
    k = {}
    for a, b in links:
        k[a], k[b] = k.get(a, 0) + 1, k.get(b, 0) + 1
    while True:
        best = {}
        for (a, b), w in links.items():
            gain = 2 * m * w - k[a] * k[b]
            if gain > 0:
                for n in (a, b):
                    best[n] = min(best.get(n, (0, 0, 0)), (-gain, a, b))
        into = {b: a for (_, a, b) in set(best.values()) if best.get(a) == best.get(b)}
        if not into:
            return label
        label = {n: into.get(c, c) for n, c in label.items()}
        new = {}
        for (a, b), w in links.items():
            x, y = into.get(a, a), into.get(b, b)
            if x != y:
                new[min(x, y), max(x, y)] = new.get((min(x, y), max(x, y)), 0) + w
        links = new
        for b, a in into.items():
            k[a] += k.pop(b)


@pytest.mark.parametrize("seed", [1, 2])
def test_communities(spark, seed):
    rng = random.Random(seed)
    pairs = [(g * 20 + rng.randrange(20), g * 20 + rng.randrange(20)) for g in range(4) for _ in range(60)] + [(rng.randrange(80), rng.randrange(80)) for _ in range(15)] + [(500, 500), (600, None), (None, 601)]
    edges = spark.createDataFrame(pairs, "src long, dst long")
    found = modular_communities(edges)
    got = {r.node: r.label for r in found.collect()}
    assert got == plain(pairs)
    q = modularity(edges, found)
    links = {(min(p), max(p)) for p in pairs if None not in p and p[0] != p[1]}
    inside, degree = sum(got[a] == got[b] for a, b in links) / len(links), {}
    for p in links:
        for n in p:
            degree[got[n]] = degree.get(got[n], 0) + 1
    assert q == pytest.approx(inside - sum((d / 2 / len(links)) ** 2 for d in degree.values()))
    assert q >= modularity(edges, communities(edges, 2)) and q > 0.5
    assert modular_communities(edges.limit(0)).count() == 0
