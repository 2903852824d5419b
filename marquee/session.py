"""Session helpers.

The cluster owns the session: we only read its settings. A local session is
built for tests and the benchmark, and only there do we pick a scratch folder
ourselves (when ``spark.checkpoint.dir`` is unset).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"

def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "marquee",
                  folder: str | None = None) -> SparkSession:
    """A local session for tests and benchmarks (UI off, AQE on, UTC), whose
    checkpoints and warehouse are below ``folder`` (the caller removes it)."""
    folder = folder or tempfile.mkdtemp(prefix="marquee-")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", f"{folder}/warehouse")
        .config(CHECKPOINT_CONF, f"{folder}/checkpoints")
        .config("spark.driver.memory", os.environ.get("MARQUEE_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _context(spark: SparkSession):
    """The SparkContext, or None for a Spark Connect session."""
    try:
        return spark.sparkContext
    except Exception:  # Connect sessions have no local context
        return None


def _is_local(spark: SparkSession) -> bool:
    sc = _context(spark)
    master = sc.master if sc is not None else spark.conf.get("spark.master", "")
    return (master or "").startswith("local")


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder the cluster names, if any."""
    sc = _context(spark)
    if sc is not None and sc.getCheckpointDir():
        return sc.getCheckpointDir()
    configured = spark.conf.get(CHECKPOINT_CONF, None)
    if not configured and sc is not None:
        configured = sc.getConf().get(CHECKPOINT_CONF, None)
    return configured or None


def ensure_checkpoint_dir(spark: SparkSession) -> str | None:
    """Return the shared checkpoint folder, setting one only in local mode.

    On a cluster the folder must be shared storage named by the cluster
    (``spark.checkpoint.dir``); a machine-local temp folder would be lost with
    its executor, so we refuse to invent one there. A Connect session whose
    server names no folder gets None (callers then persist instead).
    """
    sc = _context(spark)
    found = checkpoint_dir(spark)
    if sc is None:
        return found
    if found:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(found)
        return sc.getCheckpointDir() or found
    if not _is_local(spark):
        raise RuntimeError(
            f"{CHECKPOINT_CONF} is not set; point it at shared storage for this cluster")
    folder = tempfile.mkdtemp(prefix="marquee-ckpt-")
    sc.setCheckpointDir(folder)
    return sc.getCheckpointDir() or folder


_ISSUED: dict[str, list[str]] = {}


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, never reused path under the shared checkpoint folder;
    :func:`remove_scratch` removes what was written there."""
    root = ensure_checkpoint_dir(spark)
    if not root:
        raise RuntimeError(f"{CHECKPOINT_CONF} is not set; scratch output needs shared storage")
    root = root.rstrip("/")
    path = f"{root}/marquee-{label}-{uuid.uuid4().hex}"
    _ISSUED.setdefault(_application(spark), []).append(path)
    return path


def _application(spark: SparkSession) -> str:
    """A name for the session's application, also of one without a context."""
    sc = _context(spark)
    return sc.applicationId if sc is not None else f"session {id(spark)}"


def remove_path(spark: SparkSession, path: str) -> None:
    """Remove a folder through the file system that holds it. A session without
    a context can't reach it: there the cluster cleans its checkpoint folder."""
    if _context(spark) is None:
        return
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def remove_scratch(spark: SparkSession) -> None:
    """Remove every scratch folder this application was given. Frames that
    read them can't be evaluated afterwards; call it once results are stored."""
    for path in _ISSUED.pop(_application(spark), []):
        remove_path(spark, path)


def shuffle_partitions(df) -> int:
    """The session's shuffle partition count (sized by the cluster for its data)."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
