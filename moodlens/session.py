"""Session building, the shared work folder and lineage cuts."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "moodlens", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings every job here relies on (UTC, AQE with skew handling)."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            builder = (
                builder.config("spark.driver.bindAddress", "127.0.0.1")
                .config("spark.driver.host", "127.0.0.1")
                .config("spark.ui.enabled", "false")
            )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only where that setting is absent (single-machine tests) is a temporary folder made.
    """
    current = spark.sparkContext.getCheckpointDir()
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if not current:
            spark.sparkContext.setCheckpointDir(configured)
        return configured
    if current:
        # the context appends its own unique sub-folder to the folder it was given
        return os.path.dirname(current.removeprefix("file:"))
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    made = tempfile.mkdtemp(prefix="moodlens-")
    spark.sparkContext.setCheckpointDir(made)
    return made


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; nothing exists there yet."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a scratch table that nothing reads any more; only paths of :func:`scratch_path` are accepted."""
    if not path.startswith(shared_dir(spark).rstrip("/") + "/"):
        raise ValueError(f"{path} is no scratch path")
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives executor loss, unlike a local one."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
