"""Session helpers.

Library code never creates a session: every function takes DataFrames or a
``SparkSession`` from the caller.  ``local_session`` is for tests and the
bench only; ``checkpoint_root`` reads the cluster's shared checkpoint folder
from the session and sets one only where it is unset (local runs).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "fieldstat") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
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
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_root(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    On a cluster ``spark.checkpoint.dir`` names a shared (HDFS/object store)
    folder; it is read from the session and never overridden.  Where it is
    unset, a session on one machine (tests, local bench) gets a folder of its
    own there; any other session is refused, because its executors would each
    write to their own disk.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir is not set: executors need a shared folder")
        root = os.path.join(tempfile.gettempdir(), f"fieldstat-{sc.applicationId}")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root
