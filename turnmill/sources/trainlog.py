"""Training logs and trainer states written as JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from turnmill import config
from turnmill.sources.files import exists


def read_log(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Records of JSON arrays, one array per file; no rows if the path is missing.

    All record kinds share one sparse schema. With ``lines`` every line is a record,
    which lets Spark split large files.
    """
    if not exists(spark, path):
        return spark.createDataFrame([], config.TRAIN_LOG_SCHEMA)
    return spark.read.schema(config.TRAIN_LOG_SCHEMA).option("multiLine", not lines).json(path)


def read_state(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """The same records from the ``log_history`` of trainer states, one per file or line."""
    schema = T.StructType([
        T.StructField("log_history", T.ArrayType(config.TRAIN_LOG_SCHEMA)),
    ])
    state = spark.read.schema(schema).option("multiLine", not lines).json(path)
    return state.select(F.inline("log_history"))
