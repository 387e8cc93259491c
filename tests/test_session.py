from __future__ import annotations

from types import SimpleNamespace

import pytest

from martworks import session


def fake(master, configured=None):
    context = SimpleNamespace(master=master, applicationId=f"app-{master}")
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: configured), sparkContext=context)


def test_the_configured_folder_wins():
    assert session.shared_dir(fake("yarn", "hdfs:///shared/")) == "hdfs:///shared"


def test_a_local_master_gets_one_folder_per_application():
    assert session.shared_dir(fake("local[2]")) == session.shared_dir(fake("local[2]"))


def test_a_cluster_without_a_shared_folder_is_an_error():
    with pytest.raises(ValueError):
        session.shared_dir(fake("yarn"))


def test_reliable_keeps_rows_and_schema(spark):
    df = spark.range(10).selectExpr("id", "cast(id as decimal(14,2)) d", "timestamp_ntz'2022-01-01' t", "struct(id as a) s")
    kept = session.reliable(df)
    assert kept.dtypes == df.dtypes and kept.exceptAll(df).count() == 0 and kept.count() == 10
