"""Session helpers: a local session for tests and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

LOCAL_CONF = {
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # coalesce to the advisory size rather than to the default parallelism:
    # fewer, fuller tasks (the setting Spark recommends for busy clusters)
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # joins on (client, month) may reuse an existing partitioning by client:
    # the spine and the per-client aggregate then need no extra shuffle
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.driver.memory": "8g",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cpus: int | str = 8, **extra: str) -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("clientincome")
    for k, v in {**LOCAL_CONF, **extra}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def cluster_conf(input_bytes: int, executor_cores: int, executors: int) -> dict[str, str]:
    """Settings for a cluster run sized from the input volume.

    Shuffle partitions target ~200 MB of shuffled input each (AQE coalesces
    smaller ones and splits skewed ones at runtime); scans read 256 MB splits.
    Pass the result to ``SparkSession.builder.config`` or ``spark-submit``.
    """
    target = 200 * 1024 * 1024
    slots = max(1, executor_cores * executors)
    partitions = max(slots * 2, -(-int(input_bytes) // target))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * 1024 * 1024),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.requireAllClusterKeysForCoPartition": "false",
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.parquet.compression.codec": "snappy",
        # a written population filters the account scan: up to 64 MB of ids make a
        # Bloom filter where the scan it thins out is at least 10 GB
        "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
        "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "64m",
        "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "10g",
    }


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide checkpoint folder (``spark.checkpoint.dir``).

    On a cluster the setting must be present; only a local session (tests)
    gets its own folder when it is unset.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not conf:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        conf = tempfile.mkdtemp(prefix="clientincome-ckpt-")
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir() or conf


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder for written intermediate tables."""
    base = shared_dir(spark)
    return os.path.join(base, f"{name}-{uuid.uuid4().hex[:12]}")
