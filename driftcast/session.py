"""Session settings and shared-storage helpers."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession

# Settings the plans are written for: ANSI (the default), UTC days, AQE with
# skew-join splitting and partition coalescing, no UI server.
SESSION_CONF: dict[str, str] = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Hash partitioning on the commune alone is enough to co-locate
    # (commune, day) joins: lets the exploded commune x day spine keep the
    # partitioning of its commune table instead of being shuffled again.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "driftcast") -> SparkSession:
    """Local session for tests and the bench; on a cluster the submitted
    session is used as is (``getOrCreate`` returns it)."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in SESSION_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("DRIFTCAST_DRIVER_MEM", "8g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_conf(spark)
    ensure_checkpoint_dir(spark)
    return spark


def apply_conf(spark: SparkSession) -> None:
    """The settings above that a running session can still take, and the
    package's own folder for its Python workers (on a cluster where the
    executors do not see that folder, ship the package with ``--py-files``)."""
    for k, v in SESSION_CONF.items():
        if spark.conf.isModifiable(k):
            spark.conf.set(k, v)
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``. Where it is unset, a
    local master gets a scratch folder (tests); a cluster is an error, since
    executors could not see each other's files.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        d = os.environ.get("DRIFTCAST_SCRATCH") or "/tmp/driftcast-checkpoints"
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/driftcast/{name}-{uuid.uuid4().hex[:12]}"
