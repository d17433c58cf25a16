import random

import brute
from deposit_analytics.llm.components import components


def test_components_of_paths_stars_and_random_graphs(spark):
    rng = random.Random(1)
    edges = [(k, k + 1) for k in range(100, 160)] + [(7, k) for k in range(200, 260)]
    edges += [(rng.randrange(300, 400), rng.randrange(300, 400)) for _ in range(60)] + [(3, 3), (None, 4), (-9, -2**40)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    real = [(a, b) for a, b in edges if a is not None and a != b]
    groups = brute.Groups({one for edge in real for one in edge})
    for a, b in real:
        groups.tie(a, b)
    assert got == {one: groups.find(one) for one in groups.parent if groups.find(one) != one}


def test_no_edges(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
