"""Session helpers: defaults for local runs, checkpoint and scratch folders.

On a cluster the caller owns the session; we only read
``spark.checkpoint.dir`` from it.  A local fallback folder is created only
when that setting is unset *and* the master is local (tests, bench).
"""

from __future__ import annotations

import atexit
import tempfile
import uuid
import weakref

from pyspark.sql import SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "errlens", driver_memory: str | None = None) -> SparkSession:
    """Build (or reuse) a session.

    Master, shuffle partitions and memory are left to ``spark-submit`` or
    the session's owner unless given here (tests, bench).  Dates are read
    in UTC, the UI is off (no server is started), and reliable checkpoints
    are removed once the frame that owns them is garbage-collected.
    """
    builder = (
        SparkSession.builder
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if driver_memory:
        builder = builder.config("spark.driver.memory", driver_memory)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, registering it with the context.

    Reads ``spark.checkpoint.dir`` from the session.  Only when it is unset
    and the master is local is a temporary folder made (tests, bench); on a
    cluster an unset value is an error, since a machine-local folder would
    not survive the loss of an executor.
    """
    sc = spark.sparkContext
    path = spark.conf.get(_CHECKPOINT_KEY, None) or sc.getConf().get(_CHECKPOINT_KEY, None)
    current = sc._jsc.sc().getCheckpointDir()
    if not path and current.isDefined():
        return current.get()          # the caller already chose a folder
    if not path:
        if not _is_local(spark):
            raise RuntimeError(
                f"{_CHECKPOINT_KEY} is not set; point it at a shared folder")
        path = tempfile.mkdtemp(prefix="errlens-ckpt-", dir="/tmp")
        spark.conf.set(_CHECKPOINT_KEY, path)
    if current.isEmpty():
        sc.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder for written tables.

    All scratch folders of an application lie in one folder, which
    :func:`clear_scratch` removes; the driver also does so when it exits.
    """
    root = _scratch_root(spark)
    if root not in _roots:
        _roots.add(root)
        weak = weakref.ref(spark)
        atexit.register(lambda: (s := weak()) and _still_running(s) and clear_scratch(s))
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"


_roots: set[str] = set()


def _scratch_root(spark: SparkSession) -> str:
    base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/scratch/{spark.sparkContext.applicationId}"


def _still_running(spark: SparkSession) -> bool:
    return spark.sparkContext._jsc is not None and not spark.sparkContext._jsc.sc().isStopped()


def clear_scratch(spark: SparkSession) -> None:
    """Remove the written tables of this application (frames that read them end here)."""
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_scratch_root(spark))
    root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(root, True)
