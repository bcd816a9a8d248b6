"""Questions about paths, asked of the file system that holds them."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession


def exists(spark: SparkSession, path: str) -> bool:
    """Whether Spark finds anything at ``path``, on any file system it can read."""
    try:
        spark.read.format("binaryFile").load(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True
