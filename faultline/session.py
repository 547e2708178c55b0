"""Session helpers.

Library code never creates a session; it takes the caller's.  ``get_spark``
is for tests, the bench and local runs only.
"""
from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_spark(cpus: int | str | None = None, shuffle_partitions: int | None = None,
              app: str = "faultline") -> SparkSession:
    cpus = cpus or os.environ.get("BENCH_CPUS") or "8"
    parts = shuffle_partitions or (int(cpus) if str(cpus).isdigit() else 8)
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("FAULTLINE_DRIVER_MEMORY", "16g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder the cluster configured.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as
    is.  Only a session on one machine (local tests) may go without: it gets a
    private folder under the system temp dir.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        conf = tempfile.mkdtemp(prefix="faultline-ckpt-")
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir() or conf


def stored(df: DataFrame, name: str) -> DataFrame:
    """Compute once and cut the lineage: write as a table under the shared checkpoint folder and read it back.

    Unlike ``checkpoint()``, which computes rows a second time to write them, this is one pass, and
    readers get column pruning and pushed filters."""
    path = os.path.join(ensure_checkpoint_dir(df.sparkSession), "stored", f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
