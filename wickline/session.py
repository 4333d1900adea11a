"""Session helpers.

Library code never creates a session; it only reads settings from the one it
is given.  ``local_session`` is for tests and the benchmark.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("wickline")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _context(spark: SparkSession):
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - a remote (Connect) session has no context
        return None


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared folder the cluster names in ``spark.checkpoint.dir``."""
    sc = _context(spark)
    configured = sc.getCheckpointDir() if sc is not None else None
    if configured:
        return configured
    return spark.conf.get("spark.checkpoint.dir", None)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names.

    Where it is unset, a session that runs in this one process (tests, the
    benchmark) gets a fresh local folder; any other session raises, since a
    folder of one machine is not seen by the others.
    """
    sc = _context(spark)
    existing = checkpoint_dir(spark)
    if existing:
        if sc is not None and not sc.getCheckpointDir():
            sc.setCheckpointDir(existing)
        return (sc.getCheckpointDir() if sc is not None else None) or existing
    if sc is None or not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all machines share")
    local = tempfile.mkdtemp(prefix="wickline-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the checkpoint directory (shared on a cluster)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex}"


def workers_can_import(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])


def sf_dir() -> str:
    return os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
