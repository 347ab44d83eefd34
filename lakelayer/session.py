"""Session construction and shared scratch space.

Library code never creates its own session: every operator takes the
caller's DataFrames. ``build_session`` exists for tests, the bench and local
runs. ``scratch_path`` hands out fresh directories under the cluster's shared
``spark.checkpoint.dir``; only when the session has none (tests, local runs)
does it set one of its own.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"
_REMOVED_AT_END: set[str] = set()


def build_session(
    master: str = "local[8]",
    shuffle_partitions: int = 8,
    app_name: str = "lakelayer",
    extra: dict | None = None,
) -> SparkSession:
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.driver.memory", "16g")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables, from the session.

    On a cluster ``spark.checkpoint.dir`` names a shared file system; it is
    read, never replaced. Only when it is unset (tests, a laptop) is a local
    directory created and registered; on any other master that is an error.
    """
    root = spark.conf.get(_CHECKPOINT_KEY, None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not root:
        root = tempfile.mkdtemp(prefix="lakelayer-ckpt-")
        spark.conf.set(_CHECKPOINT_KEY, root)
        spark.sparkContext.setCheckpointDir(root)
    elif spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused directory under the shared checkpoint folder. All of an
    application's scratch is removed when the application ends."""
    folder = f"{checkpoint_root(spark)}/lakelayer/{spark.sparkContext.applicationId}"
    if folder not in _REMOVED_AT_END:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        fs.mkdirs(path)
        fs.deleteOnExit(path)
        _REMOVED_AT_END.add(folder)
    return f"{folder}/{name}-{uuid.uuid4().hex[:12]}"
