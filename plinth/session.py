"""Session helpers: a configured SparkSession and the shared work folder.

Lineage is cut with reliable checkpoints or written tables in the folder
the cluster names in ``spark.checkpoint.dir``.  That setting is read from
the session; only a local master (tests, the bench) gets a fresh scratch
folder when it is unset.  On a cluster an unset value is an error, since a
machine-local folder would not survive the loss of an executor.
"""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
import zipfile
from contextlib import contextmanager

from pyspark.sql import SparkSession

_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.driver.memory": "8g",          # only takes effect when this call starts the JVM
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "plinth", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings the library relies on."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in _DEFAULTS.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder; set a scratch one only on a local master."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_value = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if conf_value:
        sc.setCheckpointDir(conf_value)
        return sc.getCheckpointDir() or conf_value
    if not _is_local(spark):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a shared folder (HDFS, S3, ...) "
            "so checkpoints and written tables survive executor loss")
    scratch = tempfile.mkdtemp(prefix="plinth-ckpt-", dir=os.environ.get("PLINTH_SCRATCH", "/tmp"))
    spark.conf.set("spark.checkpoint.dir", scratch)
    sc.setCheckpointDir(scratch)
    return sc.getCheckpointDir() or scratch


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path for a written table under the shared folder."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/plinth-work/{name}-{uuid.uuid4().hex[:12]}"


def written_table(df, name: str):
    """``df`` written as Parquet under the shared folder and read back: cuts the lineage like a
    checkpoint, and later scans read only the columns and row groups they need."""
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def temporary_table(df, name: str):
    """``written_table`` for the length of a ``with`` block, which deletes its folder at the end: for
    passes over a table whose results do not refer to it."""
    spark = df.sparkSession
    path = work_path(spark, name)
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    try:
        df.write.parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


_ship_lock = threading.Lock()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once a session, so that worker functions import there
    wherever the driver was started."""
    sc = spark.sparkContext
    with _ship_lock:              # members run in threads: a second file of this name is an error in Spark
        if not getattr(sc, "_plinth_shipped", False):
            sc.addPyFile(_package_zip())
            sc._plinth_shipped = True


def _package_zip() -> str:
    root = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="plinth-ship-"), "plinth-package.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(root):
            for n in sorted(names):
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    return path
