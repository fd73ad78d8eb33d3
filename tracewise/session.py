"""Session defaults and the shared folder used for written intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_session(master: str | None = None, app: str = "tracewise",
                shuffle_partitions: int | None = None,
                extra: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with UTC time, AQE and skew-join handling on.

    ``master`` is only set for local runs; on a cluster the launcher decides.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
        builder = builder.config("spark.driver.memory", "16g")
    for k, v in DEFAULTS.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's checkpoint folder; create a private one only when unset.

    The cluster names its shared folder in ``spark.checkpoint.dir``. Only a
    local session without that setting (tests) gets a fresh temporary folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        try:
            configured = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset key raises
            configured = None
    if not configured:
        if not is_single_machine(sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="tracewise-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    # setCheckpointDir appends a per-application uuid folder; stay inside it.
    return f"{base}/tables/{name}-{uuid.uuid4().hex[:12]}"


def stored_dir(spark: SparkSession, name: str) -> str:
    """A folder below the shared checkpoint folder that keeps its name for the whole application."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/{name}"


def path_stamp(spark: SparkSession, path: str) -> str:
    """Changes when the files below a path do (bytes, files, time of the last change)."""
    fs, hpath = _file_system(spark, path)
    summary = fs.getContentSummary(hpath)
    return f"{path}:{summary.getLength()}:{summary.getFileCount()}:{fs.getFileStatus(hpath).getModificationTime()}"


def is_single_machine(master: str) -> bool:
    """Driver and executors are one process (``local``, ``local[8]``), so a temporary folder is shared."""
    return master == "local" or master.startswith("local[")


def _file_system(spark: SparkSession, path: str):
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, hpath = _file_system(spark, path)
    return fs.exists(hpath)


def path_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a path (one call to the store that holds it)."""
    fs, hpath = _file_system(spark, path)
    return int(fs.getContentSummary(hpath).getLength())


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder that this library wrote."""
    fs, hpath = _file_system(spark, path)
    fs.delete(hpath, True)
