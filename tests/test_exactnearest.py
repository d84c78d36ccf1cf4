"""All pairs by matrix products against all pairs singly: ties, copies, odd rows, and how tasks are bounded."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tarnwheel.functions.vectors import inner_product
from tarnwheel.operators import exactnearest, relational


def both(spark, rows, k, ask):
    df = spark.createDataFrame(rows, "i long, v array<float>")
    order = lambda found: sorted((r.asked, -1 if r.similarity is None else 0, -(r.similarity or 0), r.i) for r in found.collect())
    got = order(exactnearest.nearest(df.where(ask), df, "i", "v", k))
    want = order(relational.nearest(df.where(ask), df, "i", inner_product(F.col("asked_v"), F.col("v")), k))
    return got, want


@pytest.mark.parametrize("small", [False, True])
def test_as_singly_with_ties_and_copies(spark, monkeypatch, small):
    if small:
        for name, value in {"ASKED": 70, "ROWS": 900, "LEAST": 10, "AT_ONCE": 3, "TILE": 64, "AGAIN": 64}.items():
            monkeypatch.setattr(exactnearest, name, value)
    rng = np.random.default_rng(3)
    x = np.round(rng.normal(size=(400, 7)), 1).astype(np.float32)
    x[100:250] = x[0]  # a hot vector
    x[rng.integers(0, 400, 100)] = x[rng.integers(0, 400, 100)]
    got, want = both(spark, list(zip(rng.permutation(400).tolist(), x.tolist(), strict=True)), 5, "i % 4 = 0")
    assert got == want and len(got) == 500


def test_odd_rows_as_singly(spark):
    rows = [(0, [1.0, 2.0]), (1, [2.0, 1.0]), (2, None), (3, []), (4, [1.0, None]), (5, [float("inf"), 1.0]), (6, [1.0, 2.0, 3.0]), (7, [1.0, 2.0]), (7, [0.5, 0.5]), (None, [1.0, 1.0])]
    got, want = both(spark, rows, 4, "true")
    assert got == want and got
    for k in (3, 20):
        assert both(spark, rows[:2], k, "i = 0") == ([(0, 0, -4.0, 1)],) * 2
    assert both(spark, rows[2:4], 3, "true")[0] == both(spark, rows[2:4], 3, "true")[1]
    assert both(spark, rows, 3, "false") == ([], [])


def test_plan_compares_blocks(spark):
    from tarnwheel.plans import catalog

    plan = catalog.QUERIES["q_nearest_vectors"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
