"""Session helpers: a local session for tests and benches, and the shared
checkpoint folder taken from the session (never a machine-local default on a
cluster)."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

UTC = "UTC"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "thermocline") -> SparkSession:
    """Local session as used by the tests and ``bench.py`` (UI off, UTC, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", UTC)
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("THERMOCLINE_DRIVER_MEMORY", "8g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_utc(spark: SparkSession) -> None:
    """Event times are wall-clock UTC; windows and casts between TIMESTAMP and
    TIMESTAMP_NTZ are only stable when the session zone is UTC."""
    if spark.conf.get("spark.sql.session.timeZone") != UTC:
        spark.conf.set("spark.sql.session.timeZone", UTC)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    Only when the session has none (local tests) is a scratch folder made and
    registered, so ``DataFrame.checkpoint()`` works there too.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured.rstrip("/")
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set: name a shared folder (e.g. on HDFS or object "
            "storage) that every executor can reach; a machine-local folder is not safe on a cluster"
        )
    scratch = tempfile.mkdtemp(prefix="thermocline-ckpt-")
    sc.setCheckpointDir(scratch)
    return scratch


def materialize(df: DataFrame, label: str = "pinned") -> DataFrame:
    """Write ``df`` once as Parquet under the shared checkpoint folder and read it
    back: cuts lineage like ``checkpoint()``, but columnar and compressed, so
    later branches read only the columns they need. Every branch that reads the
    result sees the same rows, even if a sampled shuffle upstream would not
    repeat itself."""
    spark = df.sparkSession
    path = f"{checkpoint_root(spark)}/thermocline/{label}-{uuid.uuid4().hex}"
    df.write.mode("error").parquet(path)
    out = spark.read.parquet(path)
    out.written_to = path
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes the files of tables that ``materialize`` returned and that nothing reads any more: all
    that was derived from them has been written itself."""
    for table in tables:
        sc = table.sparkSession.sparkContext
        path = sc._jvm.org.apache.hadoop.fs.Path(table.written_to)
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)
