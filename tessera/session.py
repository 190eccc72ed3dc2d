"""Session helpers.

Library code never creates a session: every function takes the caller's
``SparkSession``. ``local_session`` exists for tests, the bench and scripts.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "tessera") -> SparkSession:
    """A local session with AQE on, the UI off and UTC session time."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("TESSERA_DRIVER_MEMORY", "16g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as
    it is. Only when it is unset (local tests) a fresh scratch folder is set.
    """
    sc = spark.sparkContext
    current = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir() or None
    if not current:
        if not str(sc.master).startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is unset: name a shared folder for checkpoints and exports")
        current = tempfile.mkdtemp(prefix="tessera-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return current


# Input bytes per shuffle partition aimed at before AQE coalescing.
TARGET_PARTITION_BYTES = 128 * 1024 * 1024


# Share of the input that reaches a shuffle after column pruning, filters and
# map-side partial aggregation (the plans shuffle reduced data).
SHUFFLED_SHARE = 0.1


def cluster_conf(input_bytes: int, executors_cores: int = 8000) -> dict[str, str]:
    """Session settings the plans are written for, sized for ``input_bytes`` of input.

    Shuffle partitions start at about one per 128 MiB of shuffled data (at
    least two waves of the cluster's cores), however large the input, so a
    partition never grows past its target; AQE coalesces small partitions and splits skewed ones at run
    time. Broadcasts stay bounded by the threshold; larger sides go to
    sort-merge joins.
    """
    shuffled = int(input_bytes * SHUFFLED_SHARE)
    partitions = max(2 * executors_cores, -(-shuffled // TARGET_PARTITION_BYTES))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(TARGET_PARTITION_BYTES),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.files.maxPartitionBytes": str(TARGET_PARTITION_BYTES),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
        "spark.sql.ansi.enabled": "true",
    }

