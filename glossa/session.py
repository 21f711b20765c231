"""Session construction and shared-storage helpers."""

from __future__ import annotations

import hashlib
import io
import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app_name: str = "glossa") -> SparkSession:
    """A session with the settings every plan here assumes.

    AQE re-plans joins at runtime (broadcast when a side is measured small,
    splits skewed partitions); the UI stays off.
    """
    b = (SparkSession.builder.appName(app_name)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         .config("spark.ui.enabled", "false")
         # checkpoint files of a DataFrame that is no longer referenced are removed
         .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.driver.memory", os.environ.get("GLOSSA_DRIVER_MEMORY", "16g")))
    if master:
        b = b.master(master)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names shared storage and is used as given. When it
    is unset, a local session gets a private folder; on a cluster that is an error.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="glossa-ckpt-")
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for written tables. The application's
    folder is removed when the driver ends."""
    sc = spark.sparkContext
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/{sc.applicationId}"
    if getattr(sc, "_glossa_scratch", None) != folder:
        path = sc._jvm.org.apache.hadoop.fs.Path(folder)
        fs = path.getFileSystem(sc._jsc.hadoopConfiguration())
        fs.mkdirs(path)
        fs.deleteOnExit(path)
        sc._glossa_scratch = folder
    return f"{folder}/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df):
    """Write ``df`` as Parquet to the shared checkpoint folder and continue from there.

    Used where a derived table is read by several branches of a plan (e.g. the
    value-count table of a global rank feeds a quantile sketch, a window and a
    join): it is computed once, and the lineage is cut so a lost executor does
    not recompute the whole upstream. A table rather than ``checkpoint()``: that one
    runs the last stage twice (count, then write), and its files cannot be pruned by column.
    """
    path = scratch_path(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship_package(spark: SparkSession) -> None:
    """Make ``glossa`` importable in Python workers (needed by the few
    ``mapInPandas`` steps): a zip of the package is written once, through the
    Hadoop file system, into the shared checkpoint folder and added with
    ``addPyFile``, so every executor fetches the same file. Done once per
    SparkContext; the file name carries a content hash."""
    sc = spark.sparkContext
    if getattr(sc, "_glossa_shipped", False):
        return
    import glossa
    pkg_dir = os.path.dirname(os.path.abspath(glossa.__file__))
    root = os.path.dirname(pkg_dir)
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as zf:
        for d, _, files in sorted(os.walk(pkg_dir)):
            for f in sorted(files):
                if f.endswith(".py"):
                    full = os.path.join(d, f)
                    zf.write(full, os.path.relpath(full, root))
    data = buf.getvalue()
    target = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pyfiles/glossa-{hashlib.sha1(data).hexdigest()[:16]}.zip"
    path = sc._jvm.org.apache.hadoop.fs.Path(target)
    fs = path.getFileSystem(sc._jsc.hadoopConfiguration())
    if not fs.exists(path):
        out = fs.create(path, True)
        try:
            out.write(bytearray(data))
        finally:
            out.close()
    sc.addPyFile(str(path.toString()))
    sc._glossa_shipped = True
