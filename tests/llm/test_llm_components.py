from __future__ import annotations

import numpy as np
from llm_brute import Union

from gridwright.llm.components import connected_components


def test_random_graphs_chains_and_stars(spark):
    rng = np.random.default_rng(4)
    chain = [(k, k + 1) for k in range(1000, 1040)]
    star = [(5000, k) for k in range(5001, 5200)]
    noise = [(int(a), int(b)) for a, b in rng.integers(0, 300, (150, 2))]
    edges = chain[::-1] + star + noise + [(7, 7), (1000, 1001)]
    union = Union()
    for a, b in edges:
        union.tie(a, b)
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: union.find(x) for x in linked}


def test_no_edges(spark):
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0
