"""Support rows: reading, and writing and reading of curated splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from turnmill import config
from turnmill.operators.cleaning import with_row_id


_CSV = {"header": True, "quote": '"', "escape": '"', "multiLine": True}


def _key(name: str = "row_id") -> Column:
    """The key as text; a row without one is an error, as order, values and splits hang
    on it."""
    missing = F.raise_error(F.lit(f"{name} is null; drop the column to have keys derived"))
    return F.coalesce(F.col(name).cast("string"), missing)


def by_name(df: DataFrame, schema: StructType) -> DataFrame:
    """The schema's columns, found by name and cast to its types; missing ones are null,
    but for a missing key."""
    def column(name: str) -> Column:
        return F.col(f"`{name}`") if name in df.columns else F.lit(None)

    return df.select(*[column(f.name).cast(f.dataType).alias(f.name) for f in schema
                       if f.name in df.columns or f.name != "row_id"])


def read_rows(spark: SparkSession, path: str, fmt: str = "parquet",
              schema: StructType | None = config.RAW_SCHEMA, **options) -> DataFrame:
    """Instruction/response rows from files.

    Columns are found by name; CSV files need a header, and may have their columns in any
    order. ``instruction`` and ``response`` must be there; other columns of the schema may
    be missing. Where there is no ``row_id``, one is derived from the row's content. Pass
    ``schema=None`` to keep a file's own columns, extra ones included.
    """
    options = {**(_CSV if fmt == "csv" else {}), **options}
    df = spark.read.options(**options).format(fmt).load(path)
    missing = {"instruction", "response"} - set(df.columns)
    if missing:
        raise ValueError(f"{path} has no column {', '.join(sorted(missing))}")
    if schema is not None:
        df = by_name(df, schema)
    return df.withColumn("row_id", _key()) if "row_id" in df.columns else with_row_id(df)


def write_splits(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write rows with a ``split`` column, one folder per split."""
    df.write.mode(mode).partitionBy("split").parquet(path)


def read_splits(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    """All rows, or those of one split; only that split's folder is read."""
    df = spark.read.parquet(path)
    return df if split is None else df.where(F.col("split") == split)
