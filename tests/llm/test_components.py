"""Connected components against union-find."""

from __future__ import annotations

import random

import pytest
from pricevault.llm.components import components


def labels(edges):
    root = {}

    def find(i):
        while root.setdefault(i, i) != i:
            i = root[i]
        return i

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    return {i: find(i) for i in root}


def cases():
    rng = random.Random(6)
    yield "none", []
    yield "chain", [(i, i + 1) for i in range(60)]
    yield "star", [(0, i) for i in range(1, 200)] + [(500, i) for i in range(501, 600)]
    yield "zigzag", [((i * 37) % 101, ((i + 1) * 37) % 101) for i in range(100)]
    yield "random", [(rng.randrange(300), rng.randrange(300)) for _ in range(200)]


@pytest.mark.parametrize(("name", "edges"), list(cases()))
def test_labels_are_the_least_node(spark, name, edges):
    frame = spark.createDataFrame(edges + edges[:3], "a long, b long")
    rows = components(frame).collect()
    assert len(rows) == len({r.node for r in rows})
    assert {r.node: r.label for r in rows} == labels([e for e in edges if e[0] != e[1]])
