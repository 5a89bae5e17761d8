"""Session settings and the shared scratch area that written intermediate tables live in."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = 8, app: str = "tabularium", **conf: str) -> SparkSession:
    """A local session for tests and the bench; on a cluster the submitter builds the session."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("TABULARIUM_DRIVER_MEMORY", "8g"))
        .config("spark.sql.warehouse.dir", os.path.join(tempfile.gettempdir(), "tabularium-warehouse"))
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by spark.checkpoint.dir.

    Only a local session may fall back to a temporary folder of this machine: on a
    cluster the executors could not see it.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = spark.sparkContext.getCheckpointDir()
    if not configured:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
        configured = tempfile.mkdtemp(prefix="tabularium-")
        spark.sparkContext.setCheckpointDir(configured)
    return configured.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path under the scratch area that no earlier job has used."""
    return f"{scratch_root(spark)}/tabularium/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str = "step") -> DataFrame:
    """Write `df` to the scratch area and read it back: cuts lineage and fixes row placement.

    The written columns can be pruned by later readers, and a lost executor costs a
    re-read, not a recomputation.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
