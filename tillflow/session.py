"""Session and the shared scratch location.

The launcher rules: ``get_session`` sets neither master, shuffle partitions nor
memory unless its caller passes them (``bench.py`` and the tests do).

Scratch output (CSV round trips, streaming checkpoints, target tables built by
a registered query) lives under the folder the cluster names in
``spark.checkpoint.dir`` and is deleted when the session's JVM ends, as is the
folder of this application's own checkpoints there. Only on a local master, and
only when that setting is missing, a local folder is made.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_scratch: dict[str, str] = {}
#: Applications whose checkpoint folder will be deleted.
_forgotten: set[str] = set()


def get_session(master: str | None = None, app: str | None = None, **conf: str) -> SparkSession:
    """The session of the launcher, with only what is passed here set on top."""
    builder = SparkSession.builder
    if master:
        builder = builder.master(master)
    if app:
        builder = builder.appName(app)
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder; a local one is made only for a local master without one."""
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(base)
        own = sc.getCheckpointDir()  # base/<id of this application's checkpoints>
        if own.rstrip("/") != base.rstrip("/") and sc.applicationId not in _forgotten:
            _delete_on_exit(spark, own)
            _forgotten.add(sc.applicationId)
        return base
    current = sc.getCheckpointDir()
    if current:
        return current
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    base = tempfile.mkdtemp(prefix="tillflow-ckpt-")
    sc.setCheckpointDir(base)
    _delete_on_exit(spark, base)
    return base


def _delete_on_exit(spark: SparkSession, path: str) -> None:
    """Have the file system delete an existing folder when the session's JVM ends."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(p)


def file_system(spark: SparkSession, path: str):
    """The file system of ``path`` and the path as it knows it."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused folder under the shared checkpoint location; it goes with the session."""
    app = spark.sparkContext.applicationId
    if app not in _scratch:
        root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tillflow-scratch-{uuid.uuid4().hex}"
        fs, p = file_system(spark, root)
        fs.mkdirs(p)
        fs.deleteOnExit(p)
        _scratch[app] = root
    return f"{_scratch[app]}/{name}-{uuid.uuid4().hex[:12]}"
