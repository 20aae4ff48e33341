"""Connected components against union-find: paths, stars, random graphs, and groups joined later."""

import random

import pytest

from tellake.llm.components import connected_components, join_components

RNG = random.Random(5)
SHUFFLED = RNG.sample(range(80), 80)
RANDOM = [(RNG.randrange(300), RNG.randrange(300)) for _ in range(200)]
GRAPHS = {
    "path": [(i, i + 1) for i in range(80)],
    "shuffled path": list(zip(SHUFFLED, SHUFFLED[1:])),
    "star": [(1000, i) for i in range(50)],
    "random": RANDOM,
    "odd": [(1, 1), (2, 3), (3, 2), (2, 3), (None, 4), (5, None)],
    "empty": [],
}


def components(links):
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        if a is not None and b is not None and a != b:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    return sorted((x, find(x)) for x in root)


def frame(spark, links):
    return spark.createDataFrame(links, "a long, b long")


@pytest.mark.parametrize("name", GRAPHS)
def test_components(spark, name):
    assert sorted(map(tuple, connected_components(frame(spark, GRAPHS[name])).collect())) == components(GRAPHS[name])


@pytest.mark.parametrize("cut", [0, 120, 200])
def test_joined_components(spark, cut):
    before = connected_components(frame(spark, RANDOM[:cut]))
    assert sorted(map(tuple, join_components(before, frame(spark, RANDOM[cut:])).collect())) == components(RANDOM)
