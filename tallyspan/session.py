"""Session factory and the shared folder for tables that outlive executors."""

from __future__ import annotations

import atexit
import os
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "tallyspan", master: str | None = None, conf: dict[str, str] | None = None) -> SparkSession:
    """A session with the settings every operator assumes: UTC, ANSI, AQE.

    ``master`` stays unset on a cluster, where spark-submit names it.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.showConsoleProgress": "false",
    } | (conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    The cluster names it in ``spark.checkpoint.dir``. Only where that is unset
    in a local session (as in tests) a folder under the warehouse stands in for
    it; on a cluster its absence is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir names no folder that driver and executors share")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_tallyspan_shared"


_RUNS: dict[str, str] = {}


def run_dir(spark: SparkSession) -> str:
    """This run's own folder in the shared one; it goes when the driver's process ends."""
    base = shared_dir(spark)
    if base not in _RUNS:
        path = _RUNS[base] = f"{base}/run-{os.getpid()}-{uuid.uuid4().hex}"
        jvm, conf, owner = spark._jvm, spark._jsc.hadoopConfiguration(), os.getpid()

        def remove() -> None:
            if os.getpid() != owner:
                return
            try:
                at = jvm.org.apache.hadoop.fs.Path(path)
                at.getFileSystem(conf).delete(at, True)
            except Exception:  # the JVM may be gone; a leftover folder is no failure of the run
                return

        atexit.register(remove)
    return _RUNS[base]


def materialize(df: DataFrame, label: str = "t") -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage, survives lost executors, and keeps Parquet's column
    pruning for later readers.
    """
    path = f"{run_dir(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
