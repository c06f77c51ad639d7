import random

import pytest

from tidemark.llm.components import components


def expected(links):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        if a != b:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    return {x: find(x) for x in parent}


RANDOM = random.Random(3)
CASES = {
    "none": [],
    "itself": [(1, 1)],
    "chain": [(n, n + 1) for n in range(150)],
    "shuffled chain": list(zip(*(RANDOM.sample(range(-30, 30), 60)[i:] for i in (0, 1)))),
    "star": [(50, n) for n in range(40)],
    "repeated": [(1, 2), (2, 1), (1, 2), (7, 8)],
    "random": [(RANDOM.randrange(200), RANDOM.randrange(200)) for _ in range(120)],
}


@pytest.mark.parametrize("name", CASES)
def test_components(spark, name):
    links = CASES[name]
    found = components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r["node"]: r["label"] for r in found} == expected(links)
    assert len(found) == len(expected(links))
