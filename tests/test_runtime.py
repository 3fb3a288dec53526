"""The shared folder comes from the session's spark.checkpoint.dir."""

from __future__ import annotations

from sessionlens import runtime
from sessionlens.runtime import CLUSTER_SETTINGS, configure, materialize, shared_dir, table_path


def test_shared_dir_follows_checkpoint_setting(spark):
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    root = shared_dir(spark)
    if configured:
        assert root.rstrip("/").endswith(configured.rstrip("/").split(":")[-1].rstrip("/"))
    assert table_path(spark, "x").startswith(root.rstrip("/") + "/sessionlens/x-")
    assert spark.sparkContext.getCheckpointDir() is not None


def test_configure_pins_utc(spark):
    configure(spark)
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"


def test_materialize_round_trip(spark):
    df = spark.range(10).withColumnRenamed("id", "v")
    back = materialize(df, "rt")
    assert sorted(r.v for r in back.collect()) == list(range(10))


def test_cluster_settings_never_guess_broadcasts():
    assert CLUSTER_SETTINGS["spark.sql.autoBroadcastJoinThreshold"] == "-1"
    assert CLUSTER_SETTINGS["spark.sql.adaptive.enabled"] == "true"


def test_tables_of_a_scope_go_at_its_end(spark):
    import os

    kept = runtime.materialize(spark.range(3), "outside")
    outside = runtime.written_tables()[-1]
    with runtime.table_scope(spark):
        inside = runtime.materialize(spark.range(4), "inside")
        path = runtime.written_tables()[-1].removeprefix("file:")
        assert inside.count() == 4 and os.path.isdir(path)
    assert not os.path.exists(path)
    assert runtime.written_tables()[-1] == outside and kept.count() == 3
