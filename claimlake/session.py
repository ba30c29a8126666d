"""Session helpers: building a session for tests/bench and finding the shared work folder."""

from __future__ import annotations

import contextlib
import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "claimlake") -> SparkSession:
    """Session for tests and the bench: AQE on, UI off, UTC, Arrow on."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach: the session's ``spark.checkpoint.dir``.

    A cluster names it; only when it is unset in local mode (tests) do we create one and
    register it as the checkpoint dir, so that later calls agree. On a cluster without it we
    refuse: a driver-local temporary folder is not visible to executors.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        try:
            root = spark.sparkContext.getCheckpointDir()
        except Exception:  # noqa: BLE001 - no SparkContext handle (e.g. a Connect session)
            root = None
    if not root:
        master = spark.conf.get("spark.master", "") or ""
        if master and not master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="claimlake-")
        try:
            spark.sparkContext.setCheckpointDir(root)
            root = spark.sparkContext.getCheckpointDir() or root
        except Exception:  # noqa: BLE001
            pass
    return root.rstrip("/")


def default_parallelism(spark: SparkSession) -> int:
    """Task slots of the cluster (``defaultParallelism``), with a conf fallback."""
    try:
        return int(spark.sparkContext.defaultParallelism)
    except Exception:  # noqa: BLE001 - no SparkContext handle
        return int(spark.conf.get("spark.default.parallelism", None) or spark.conf.get("spark.sql.shuffle.partitions"))


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A new, unique sub-folder of the shared root (never reused, never cleared)."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def remove_folder(spark: SparkSession, path: str) -> bool:
    """Delete a folder of any Hadoop file system, from the driver; false if there was none."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def list_folder(spark: SparkSession, path: str) -> list[str]:
    """What lies directly in a folder of any Hadoop file system, by name; nothing if there is none."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(f.getPath().toString() for f in files.listStatus(folder)) if files.exists(folder) else []


@contextlib.contextmanager
def sql_conf(spark: SparkSession, **settings: str):
    """Temporarily set SQL confs (keys with '__' for '.'), restoring the previous values."""
    keys = {k.replace("__", "."): str(v) for k, v in settings.items()}
    old = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``claimlake`` importable in the executors' Python workers (once per application).

    Only the file mode runs Python on executors (``mapInPandas``). A cluster job normally ships
    the package with ``--py-files``; this does the same at run time: the package is zipped on
    the driver and registered with ``addPyFile`` (``addArtifacts`` on a Connect session), and
    Spark copies it to every executor.
    """
    try:
        app = spark.sparkContext.applicationId
    except Exception:  # noqa: BLE001 - Connect session
        app = spark.conf.get("spark.app.id", None) or "connect"
    if app in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    archive = shutil.make_archive(
        os.path.join(tempfile.mkdtemp(prefix="claimlake-pyfiles-"), "claimlake"),
        "zip",
        root_dir=os.path.dirname(pkg),
        base_dir=os.path.basename(pkg),
    )
    try:
        spark.sparkContext.addPyFile(archive)
    except Exception:  # noqa: BLE001 - Connect session
        spark.addArtifacts(archive, pyfile=True)
    _SHIPPED.add(app)
