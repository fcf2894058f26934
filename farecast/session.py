"""Session helpers: a local session for tests and the shared work folder.

Every intermediate table this package writes (range-indexed inputs, landed
stream files, sink tables of the demo queries) goes below the folder the
cluster names in ``spark.checkpoint.dir``. Only when that is unset -- local
runs and tests -- is a fresh temporary folder set as the checkpoint folder.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()


def local_session(
    cores: int | str = "*", shuffle_partitions: int = 8, app: str = "farecast", event_log_dir: str | None = None
) -> SparkSession:
    """Session used by tests and bench: local mode, AQE on, no UI.

    ``event_log_dir`` turns on Spark's event log there (stage and task times
    without a UI)."""
    builder = SparkSession.builder
    if event_log_dir:
        builder = builder.config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", event_log_dir)
    return (
        builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session.

    Read from the running context first, then from ``spark.checkpoint.dir``.
    If neither is set and the master is local, a new temporary folder is
    created and set; on a cluster an unset folder is an error, because a
    machine-local folder would not survive the loss of an executor.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect has no SparkContext: the server owns the folder
        found = spark.conf.get("spark.checkpoint.dir", None)
        if not found:
            raise RuntimeError("set spark.checkpoint.dir on the Spark Connect server") from None
        return found.rstrip("/")
    found = sc.getCheckpointDir()
    if not found:
        found = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
        if found:
            sc.setCheckpointDir(found)
            found = sc.getCheckpointDir() or found
    if not found:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder before running on a cluster")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="farecast-ckpt-"))
        found = sc.getCheckpointDir()
    return found.rstrip("/")


def session_id(spark: SparkSession) -> str:
    """Identity of the running application (memo key for saved tables)."""
    return spark.conf.get("spark.app.id", None) or str(id(spark))


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder for one intermediate table."""
    return f"{checkpoint_dir(spark)}/farecast/{session_id(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def clear_scratch(spark: SparkSession) -> None:
    """Remove every intermediate table of this application. Frames that read one cannot be used after."""
    remove_path(spark, f"{checkpoint_dir(spark)}/farecast/{session_id(spark)}")


def ship_code(spark: SparkSession) -> None:
    """Send this package to the Python workers once per application (Spark's file
    server carries the archive), so that nothing needs to be installed there."""
    app = session_id(spark)
    if app in _SHIPPED:
        return
    root = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="farecast-py-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)  # the driver serves it as long as it lives
    archive = Path(folder) / "farecast_code.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    spark.sparkContext.addPyFile(str(archive))
    _SHIPPED.add(app)


# --- files of the shared folder -------------------------------------------------
# Spark has no public API for listing or removing files of the storage it reads,
# so these few helpers use the file system of the session's Hadoop configuration.


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, target = _file_system(spark, path)
    return fs.exists(target)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names in one folder (none if it does not exist); a single listing."""
    fs, target = _file_system(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(target)) if fs.exists(target) else []


def touch(spark: SparkSession, path: str) -> None:
    """Create an empty file (a marker) and its folders."""
    fs, target = _file_system(spark, path)
    fs.create(target, True).close()


def remove_path(spark: SparkSession, path: str) -> None:
    fs, target = _file_system(spark, path)
    fs.delete(target, True)


def move_path(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file or folder within one file system, over what is at ``target``."""
    fs, old = _file_system(spark, source)
    new = _file_system(spark, target)[1]
    fs.delete(new, True)
    if not fs.rename(old, new):
        raise OSError(f"could not rename {source} to {target}")
