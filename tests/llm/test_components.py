import random

import pytest

from flightloom.llm.components import connected_components


def brute(edges):
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    return sorted((x, find(x)) for x in root)


CASES = {
    "none": [],
    "self": [(3, 3)],
    "chain": [(i, i + 1) for i in range(40)],
    "star": [(0, i) for i in range(1, 300)] + [(i, 500) for i in range(5)],
    "random": [(random.Random(i).randrange(200), random.Random(-i - 1).randrange(200)) for i in range(150)],
    "signed": [(-5, 7), (7, 9), (9, -(2**63)), (2**63 - 1, 3), (-5, 7)],
}


@pytest.mark.parametrize("name", CASES)
def test_components(spark, name):
    edges = spark.createDataFrame(CASES[name], "a long, b long")
    assert sorted(map(tuple, connected_components(edges).collect())) == brute(CASES[name])
