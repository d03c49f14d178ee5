"""Session helpers.

The library itself never sets cluster sizing (shuffle partitions, memory): those belong to
the deployment. ``build_session`` is for tests and the local benchmark only.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "affinity",
                  extra: dict | None = None) -> SparkSession:
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder named by the cluster (``spark.checkpoint.dir``).

    Only a local-mode session (tests, the bench) that names none gets a private scratch
    folder. On a cluster the setting must point at shared storage; a machine-local folder
    would be lost with its executor, so a cluster session without it is an error.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect sessions expose no SparkContext
        sc = None
    current = sc.getCheckpointDir() if sc is not None else None
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured and sc is not None:
        configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        master = sc.master if sc is not None else spark.conf.get("spark.master", "")
        if not master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder: intermediate tables are written there")
        configured = tempfile.mkdtemp(prefix="affinity-ckpt-")
    if sc is not None:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    return configured


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialize ``df`` into the reliable checkpoint folder and return the re-read frame.

    Used for the few tables reused by many downstream stages (similarity top-K, splits).
    Survives executor loss, unlike a local checkpoint.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the checkpoint folder for written intermediate tables."""
    base = checkpoint_dir(spark)
    return os.path.join(base, name)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as parquet under the checkpoint folder and return the re-read table.

    For an input that many branches of one plan read (a split feeding norms, group sizes, both
    sides of a self-join and the recommendation joins): Catalyst pushes different inferred
    filters into each branch, so their exchanges are not reused and the input would be
    recomputed per branch. The written table is read back with column pruning and filter
    pushdown and survives the loss of executors.
    """
    import uuid

    spark = df.sparkSession
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
