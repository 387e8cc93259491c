"""What a store of batches holds grows with the table: a join with it never broadcasts it."""

from martworks.sources.runs import RunStore


def test_stored_rows_are_not_broadcast(spark, tmp_path):
    store = RunStore(spark, str(tmp_path / "store"), "k long, v string", ["k"])
    store.append(spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string"), 0)
    rows = spark.createDataFrame([(2, "x"), (3, "y")], "k long, v string")
    new = rows.join(store.near(rows).select("k"), "k", "left_anti")
    assert "Broadcast" not in new._jdf.queryExecution().executedPlan().toString()
    assert [r.k for r in new.collect()] == [3]
