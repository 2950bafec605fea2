"""Session helpers: local test session and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import threading

from pyspark.sql import SparkSession

# Settings every job relies on.  AQE re-plans joins from runtime sizes, splits
# skewed shuffle partitions and coalesces small ones; the session time zone is
# pinned so DATE casts never depend on the machine.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, app: str = "ledgerline") -> SparkSession:
    """A local session for tests and the bench (UI off, no extra ports)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # local runs only: keep the session catalog's default database out of the working directory
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="ledgerline-warehouse-"))
    )
    for k, v in RECOMMENDED_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_TMP: dict[str, str] = {}
_LOCK = threading.Lock()


def scratch_dir(spark: SparkSession) -> str:
    """Shared folder for written intermediate tables.

    Uses the cluster's ``spark.checkpoint.dir`` (or the context's checkpoint
    directory).  Where neither is set, a local master gets a fresh temporary
    folder; on a cluster, whose executors would each write to their own disk,
    it fails and names the setting.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # sessions without a local SparkContext (e.g. Spark Connect)
        sc = None
    if sc is not None and sc.getCheckpointDir():
        return sc.getCheckpointDir().rstrip("/")
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path and sc is not None:
        path = sc.getConf().get("spark.checkpoint.dir", None)
    if not path:
        master = sc.master if sc is not None else ""
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise RuntimeError(f"spark.checkpoint.dir is not set: master {master!r} needs a folder that all executors share")
        with _LOCK:
            path = _TMP.setdefault(app_id(spark), tempfile.mkdtemp(prefix="ledgerline-ckpt-"))
    if sc is None:
        return path.rstrip("/")
    sc.setCheckpointDir(path)
    return (sc.getCheckpointDir() or path).rstrip("/")


def app_id(spark: SparkSession) -> str:
    """Application id of the session (also without a local SparkContext)."""
    try:
        return spark.sparkContext.applicationId
    except Exception:
        return spark.conf.get("spark.app.id", "app")


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """Path under the shared scratch folder."""
    return "/".join([scratch_dir(spark), *parts])
