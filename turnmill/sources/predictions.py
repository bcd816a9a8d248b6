"""Prediction tables as CSV: header, six columns, texts with line breaks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from turnmill import config
from turnmill.sources.files import exists

_QUOTING = {"header": True, "quote": '"', "escape": '"', "encoding": "UTF-8"}


#: Key and evaluation order, written and read along where a table has them.
ORDER_COLUMNS = ("row_id", "split_order")


def write_predictions(df: DataFrame, path: str, columns=None, mode: str = "errorifexists") -> None:
    """Write key and order, if there, and the prediction columns; whitespace at the ends of
    a text is kept."""
    columns = columns or [
        *(c for c in ORDER_COLUMNS if c in df.columns), *config.PREDICTION_SCHEMA.fieldNames()]
    df.select(*columns).write.mode(mode).options(
        **_QUOTING, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    ).csv(path)


def read_predictions(spark: SparkSession, path: str,
                     schema: StructType = config.PREDICTION_SCHEMA) -> DataFrame:
    """Read prediction columns by the header's names, with key and order if they are
    there; an empty cell is null, a missing column is null, a missing path gives no rows.

    Texts hold line breaks, so records cannot be told from raw lines: each file is
    read by one task. Tables of size belong in Parquet; CSV is the exchange format.
    """
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    df = spark.read.options(
        **_QUOTING, multiLine=True, nullValue="",
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    ).csv(path)

    def cell(name: str, kind) -> Column:
        if name not in df.columns:
            return F.lit(None).cast(kind).alias(name)
        text = F.col(f"`{name}`")
        return F.when(text != "", text).cast(kind).alias(name)

    kept = [cell(c, "string") for c in ORDER_COLUMNS if c in df.columns]
    return df.select(*kept, *[cell(f.name, f.dataType) for f in schema])
