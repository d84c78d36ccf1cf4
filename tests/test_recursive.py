"""Reachability with cycles and bounds."""

import random

from tarnwheel.operators.recursive import reach


def plain(start, edges, most=None):
    depth, now, d = {}, {x for x in start if x is not None}, 0
    while now and (most is None or d <= most):
        depth |= {x: d for x in now}
        now = {b for a, b in edges if a in now and b is not None} - set(depth)
        d += 1
    return depth


def test_reach(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(70)] + [(None, 1), (2, None), (100, 101), (101, 100)]
    start = [0, 1, None, 100, 100]
    e = spark.createDataFrame([(*x, "n") for x in edges], "src int, dst int, node string")
    s = spark.createDataFrame([(x, 1) for x in start], "node int, depth int")
    for most in (None, 0, 2):
        got = [(r.node, r.depth) for r in reach(s, e, most).collect()]
        assert len(got) == len(dict(got)) and dict(got) == plain(start, edges, most)
    assert reach(s.limit(0), e).collect() == []
    assert {r.node for r in reach(s, e.limit(0)).collect()} == {0, 1, 100}
