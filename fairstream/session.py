"""Session settings and the shared folder used for lineage cuts and stream state."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "fairstream") -> SparkSession:
    """Build (or reuse) a session with the settings the library relies on.

    On a cluster pass ``master=None`` and let the submitter decide; AQE then
    coalesces the shuffle partitions to what the data needs at run time.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = (
        builder
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor and the driver can reach.

    It is the cluster's ``spark.checkpoint.dir`` (or a checkpoint folder the
    application already registered). Only when neither exists (a local test
    run) do we make one under the machine's temp folder and register it as the
    checkpoint folder, so that ``DataFrame.checkpoint()`` works too. On any
    other master a missing setting is an error: a machine's own folder would
    hide one executor's files from the others.
    """
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if base:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(base)
        return base
    if sc.getCheckpointDir() is None:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="fairstream-"))
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared folder (never reused between runs)."""
    base = shared_dir(spark).rstrip("/")
    return f"{base}/fairstream/{name}-{uuid.uuid4().hex[:12]}"


def spread(df, partitions: int | None = None):
    """``df`` in ``partitions`` partitions, or as it is.

    Seeded draws (the k-means start) depend on the partitioning, so the number
    is the caller's choice and never the cluster's core count.
    """
    return df.repartition(partitions) if partitions else df
