"""Session construction and the shared work folder.

Scratch output (CSV round trips, exports, versioned snapshots, stream sinks)
goes under the folder the cluster names in ``spark.checkpoint.dir``.  Only when
that is unset (local runs, tests) does this module pick a folder of its own.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "ledgerline", extra_conf: dict[str, str] | None = None) -> SparkSession:
    """Session with the settings the operators are written for.

    AQE coalesces the small post-aggregation shuffles and splits skewed join
    partitions; the UI stays off.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _context(spark: SparkSession):
    """The SparkContext of a classic session; None under Spark Connect."""
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - Connect sessions have no context
        return None


def default_parallelism(spark: SparkSession) -> int:
    sc = _context(spark)
    if sc is not None:
        return sc.defaultParallelism
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def checkpoint_root(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder; set a local one only if unset
    (local runs and tests)."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    sc = _context(spark)
    if not root and sc is not None:
        root = sc.getCheckpointDir()
    if not root:
        if sc is None:
            raise RuntimeError("set spark.checkpoint.dir to a shared folder for scratch output")
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            # every executor would write to a disk of its own
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="ledgerline-ckpt-")
        sc.setCheckpointDir(root)
        root = sc.getCheckpointDir() or root
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused folder below the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/ledgerline/{name}-{uuid.uuid4().hex[:12]}"


def table_path(sf_dir: str, table: str) -> str:
    return os.path.join(sf_dir, f"{table}.parquet")
