"""What a vault holds grows with the data: loads never broadcast it."""

from martworks.operators.vault import load_hub, load_link, load_satellite


def test_stored_tables_are_not_broadcast(spark):
    src = spark.createDataFrame([(1, 2, "x"), (2, 3, "y")], "a long, b long, name string")
    hub, link = load_hub(src, "pk", "a", None, "s", "2001-01-01"), load_link(src, "pk", ["a", "b"], None, "s", "2001-01-01")
    sat = load_satellite(src, "a", ["name"], None, "s", "2001-01-01")
    for new in (load_hub(src, "pk", "a", hub, "s", "2002-01-01"), load_link(src, "pk", ["a", "b"], link, "s", "2002-01-01"),
                load_satellite(src, "a", ["name"], sat, "s", "2002-01-01")):
        assert "Broadcast" not in new._jdf.queryExecution().executedPlan().toString()
        assert new.count() == 0
