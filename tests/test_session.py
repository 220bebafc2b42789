"""Where intermediate tables go."""

import os
from types import SimpleNamespace

import pytest

from shelfcast import session
from shelfcast.operators.partitions import partitions_for


def test_tables_go_to_the_named_folder(spark):
    assert session.scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def fake(master, setting=None):
    context = SimpleNamespace(
        master=master,
        applicationId="app",
        getConf=lambda: {},
        getCheckpointDir=lambda: None,
    )
    return SimpleNamespace(sparkContext=context, conf={session.SETTING: setting})


def test_a_cluster_must_name_a_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_folder(fake("yarn"))
    assert session.shared_folder(fake("yarn", "hdfs://shared")) == "hdfs://shared"


def test_local_mode_keeps_one_temporary_folder():
    assert session.shared_folder(fake("local[2]")) == session.shared_folder(fake("local[2]"))


def test_stored_tables_keep_rows_and_schema(spark):
    df = spark.range(10).selectExpr("id", "id * 0.5 AS half", "CAST(NULL AS STRING) AS s")
    stored = session.cut_lineage(df)
    assert stored.schema.simpleString() == df.schema.simpleString()
    assert stored.exceptAll(df).count() == 0


def test_scratch_tables_go_with_their_job(spark):
    before = session.cut_lineage(spark.range(3))
    with session.scratch_tables(spark):
        inside = session.cut_lineage(spark.range(5))
        (path,) = {name.rsplit("/", 1)[0] for name in inside.inputFiles()}
        assert inside.count() == 5
    assert not os.path.exists(path.removeprefix("file://")) and before.count() == 3


def test_training_partitions_grow_with_rows_only():
    counts = [partitions_for(n) for n in (0, 1, 20_000, 40_000, 480_000, 10**7, 10**10)]
    assert counts == [1, 1, 4, 8, 96, 2_000, 2_000_000]
    assert partitions_for(10**10, 10**6) == 10**4
