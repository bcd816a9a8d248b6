"""Intermediate tables in the shared folder the cluster names."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_local_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach.

    The session's ``spark.checkpoint.dir`` is used as it stands. Only a local
    session without the setting gets a temporary folder; a cluster must name one.
    """
    named = spark.conf.get(_SETTING, None)
    if named:
        return named
    context = spark.sparkContext
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise ValueError(f"set {_SETTING} to a folder all executors share")
    app = context.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="turnmill-")
    return _local_dirs[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nothing else uses."""
    return f"{shared_dir(spark).rstrip('/')}/turnmill-{uuid.uuid4().hex}/{name}"


@contextmanager
def _shuffles_removed(spark: SparkSession):
    """Shuffle files of what runs inside go when it is done, not at some later
    garbage collection."""
    before = spark.conf.get(_CLEAN, None)
    spark.conf.set(_CLEAN, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEAN)
        else:
            spark.conf.set(_CLEAN, before)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet and read it back.

    Later passes then read only the columns they need, and a lost executor costs
    a re-read of files rather than a recomputation of everything upstream.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with _shuffles_removed(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop(*staged: DataFrame) -> None:
    """Delete staged tables that no later step reads."""
    for df in staged:
        spark = df.sparkSession
        jvm, root = spark._jvm, shared_dir(spark).removeprefix("file://").rstrip("/")
        folders = {f.rpartition("/")[0] for f in df.inputFiles()}
        for folder in folders:
            if root in folder and "/turnmill-" in folder:
                path = jvm.org.apache.hadoop.fs.Path(folder)
                path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
