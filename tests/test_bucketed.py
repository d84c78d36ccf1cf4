"""Bucketed tables join and sum without an exchange."""

from tarnwheel.plans import catalog
from tarnwheel.sources import bucketed


def test_no_exchange_and_right_rows(spark):
    query = catalog.QUERIES["q_bucketed_join"](spark, "/root/testdata/sf0.001")
    plan = query._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "SortMergeJoin" in plan
    a = spark.createDataFrame([(k % 5, k) for k in range(40)] + [(None, 1)], "k int, v int")
    b = spark.createDataFrame([(k, str(k)) for k in range(1, 7)] + [(None, "n")], "k int, w string")
    for how in ("inner", "left"):
        got = bucketed.merged_join(bucketed.bucketed(a, ["k"], 4), bucketed.bucketed(b, ["k"], 4), ["k"], how)
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, a.join(b, ["k"], how).collect()), key=repr)
    bucketed.drop(spark)
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("tarnwheel_") and not t.isTemporary]
