"""Intermediate tables in the folder that the cluster shares."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_TEMPORARY = "file://" + tempfile.gettempdir()
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_HANDED = "spark.sql.execution.arrow.maxBytesPerBatch"
#: Of each application: the folder of this run's own files.
_OWN: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; a temporary one only in local mode."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return _TEMPORARY


def run_dir(spark: SparkSession) -> str:
    """This application's folder in the shared one; no other application writes there."""
    key = spark.sparkContext.applicationId
    if key not in _OWN:
        root = shared_dir(spark)
        _OWN[key] = f"{root}/linkloom/{key}-{uuid.uuid4().hex}"
        if root == _TEMPORARY:
            atexit.register(shutil.rmtree, local_path(_OWN[key]), ignore_errors=True)
    return _OWN[key]


def new_path(spark: SparkSession, tag: str) -> str:
    return f"{run_dir(spark)}/{tag}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, tag: str, handed: int | None = None) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: lineage ends here.

    The file outlives any executor, so a lost one costs no upstream work; the shuffle files
    behind it go at once, where Spark would keep them until the driver collects its garbage.
    ``release`` removes the files of a finished run. ``handed``: bytes that Python workers
    get at once meanwhile, for rows so long that Spark's batches would take much memory.
    """
    spark = df.sparkSession
    path = new_path(spark, tag)
    own = {_CLEANUP: "true"} | ({_HANDED: str(handed)} if handed else {})
    before = {k: spark.conf.get(k, None) for k in own}
    try:
        for k, v in own.items():
            spark.conf.set(k, v)
        df.write.parquet(path)
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Delete the intermediate files of this application, and no other's. Only call it when no result is still to be read."""
    path = _OWN.pop(spark.sparkContext.applicationId, None)
    if path:
        root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(root, True)


def local_path(path: str) -> str | None:
    """The plain path of a file: URI, None for any other scheme."""
    if path.startswith("file:"):
        rest = path[5:]
        return "/" + rest.lstrip("/")
    return path if os.path.isabs(path) else None
