"""Spark session helpers.

``spark.checkpoint.dir`` is read from the session. Only a local master may leave it
unset (tests); a fresh scratch folder is then made. Intermediate tables are Parquet in
that shared folder, so they outlive executors and need no lineage.
"""

from __future__ import annotations

import atexit
import os
import shutil
import sys
import tempfile
import uuid

from pyspark import SparkContext
from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "smishlens", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with AQE, UTC time and the UI switched off."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def is_local(spark: SparkSession) -> bool:
    """True for ``local`` masters, where driver and tasks are one process."""
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder that the cluster names in ``spark.checkpoint.dir``.

    It is used as it is. Only a local master may leave it unset; a new scratch
    folder is then made. Any other master without the setting is an error, as a
    folder of the driver's machine would be invisible to the executors.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not is_local(spark):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        conf_dir = tempfile.mkdtemp(prefix="smishlens-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        atexit.register(shutil.rmtree, conf_dir, ignore_errors=True)
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


_SCRATCH: dict[str, str] = {}


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new path ``<shared folder>/smishlens-<session>/<name>-<unique>``.

    The session's folder is deleted when the driver's Python ends."""
    app = spark.sparkContext.applicationId
    if app not in _SCRATCH:
        _SCRATCH[app] = f"{ensure_checkpoint_dir(spark)}/smishlens-{uuid.uuid4().hex[:12]}"
        atexit.register(_drop_folder, _SCRATCH[app])
    return f"{_SCRATCH[app]}/{name}-{uuid.uuid4().hex[:12]}"


def _drop_folder(path: str) -> None:
    """Delete a folder of any Hadoop store; the session may have been stopped before."""
    jvm = SparkContext._jvm
    if jvm is None:
        return
    try:
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(jvm.org.apache.hadoop.conf.Configuration()).delete(target, True)
    except Exception as problem:  # at the very end of the driver: leave a word, not a traceback
        print(f"could not delete {path}: {type(problem).__name__}", file=sys.stderr)


def shared_table(df, name: str, compression: str | None = None):
    """Write ``df`` as Parquet into the shared folder and read it back.

    Cuts the lineage like a checkpoint, and keeps column pruning, compression
    and size statistics for what reads it. ``compression``: another codec than the session's."""
    path = scratch_folder(df.sparkSession, name)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path of any Hadoop store is there."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def drop_table(df) -> None:
    """Delete the folder of a table of :func:`shared_table` that is no longer needed."""
    files = df.inputFiles()
    if files:
        _drop_folder(os.path.dirname(files[0]))
