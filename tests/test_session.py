"""The shared checkpoint folder comes from the session."""

from __future__ import annotations

from thermocline.session import checkpoint_root, materialize


def test_checkpoint_root_uses_session_setting(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    root = checkpoint_root(spark)
    assert root
    if configured:
        assert root.rstrip("/").endswith(configured.rstrip("/").split(":", 1)[-1].rstrip("/")) or configured in root


def test_materialize_round_trip(spark):
    df = spark.range(1000).withColumnRenamed("id", "x")
    pinned = materialize(df, "test")
    assert pinned.count() == 1000
    assert pinned.inputFiles()[0].find(checkpoint_root(spark).split(":", 1)[-1]) >= 0
