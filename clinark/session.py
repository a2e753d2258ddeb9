"""Session helpers: a local session for tests/bench, and the shared work folder.

On a cluster the session is created by the platform; the library only reads
``spark.checkpoint.dir`` from it. A folder of our own is chosen only when that
setting is absent (local tests), never in place of a cluster setting.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = 8, shuffle_partitions: int = 8,
                  app: str = "clinark", extra_conf: dict[str, str] | None = None) -> SparkSession:
    """A local session for tests and the bench. Not used by library code."""
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
        .config("spark.driver.memory", os.environ.get("CLINARK_DRIVER_MEMORY", "16g"))
        .config("spark.sql.ansi.enabled", "true")
    )
    for key, value in (extra_conf or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide folder for written tables and checkpoints.

    Read from ``spark.checkpoint.dir`` (or the context's checkpoint dir). Only when
    neither is set and the master is local (tests) a fresh folder is made and
    registered as the checkpoint dir, so later calls agree; on a cluster an unset
    folder is an error.
    """
    sc = spark.sparkContext
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        try:
            conf_dir = spark.conf.get("spark.checkpoint.dir", None)
        except Exception:  # noqa: BLE001 - conf lookup may be restricted
            conf_dir = None
    if conf_dir:
        return conf_dir.rstrip("/")
    current = sc.getCheckpointDir()
    if current:
        # getCheckpointDir() returns <base>/<uuid>; keep our tables beside it.
        return current.rstrip("/").rsplit("/", 1)[0]
    if not str(sc.master).startswith("local"):
        # A folder on the driver's disk is not visible to executors; never guess one.
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    base = tempfile.mkdtemp(prefix="clinark-")
    sc.setCheckpointDir(base)
    return base


def run_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh, unique sub-folder of the shared folder for one run."""
    return f"{shared_dir(spark)}/{purpose}-{uuid.uuid4().hex[:12]}"
