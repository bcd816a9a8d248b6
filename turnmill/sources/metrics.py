"""The result document: sample count, both metric sets, improvement, as JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from turnmill import config

_MISSING = "N/A"
_PARTS = {"base_model": "baseline", "fine_tuned": "fine_tuned"}


def write_document(document: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write the one-row document; a missing number is written as ``"N/A"``.

    Numbers and the text ``N/A`` cannot share a column, so the JSON text is put
    together by part and written as a text file.
    """
    def part(name: str) -> Column:
        fields = []
        for f in document.schema[name].dataType.fields:
            value = F.coalesce(F.col(f"{name}.{f.name}").cast("string"), F.lit(f'"{_MISSING}"'))
            fields.append(F.concat(F.lit(f'"{f.name}": '), value))
        return F.concat(F.lit(f'"{name}": {{'), F.concat_ws(", ", *fields), F.lit("}"))

    text = F.concat(
        F.lit('{"eval_samples": '), F.col("eval_samples").cast("string"), F.lit(", "),
        F.concat_ws(", ", part("base_model"), part("fine_tuned"), part("improvement")), F.lit("}"),
    )
    document.select(text.alias("value")).coalesce(1).write.mode(mode).text(path)


def read_document(spark: SparkSession, path: str) -> DataFrame:
    """Read a document as one row of structs; ``N/A`` becomes null. A missing path is
    an error."""
    metric_map = T.MapType(T.StringType(), T.StringType())
    schema = T.StructType([
        T.StructField("eval_samples", T.LongType()),
        T.StructField("base_model", metric_map),
        T.StructField("fine_tuned", metric_map),
        T.StructField("improvement", metric_map),
    ])
    read = spark.read.schema(schema).option("multiLine", True).json(path)

    def part(name: str) -> Column:
        keys = [k for k in config.METRIC_DIGITS if name != "improvement" or k != "avg_generation_time_sec"]
        return F.struct(*[F.col(name)[key].try_cast("double").alias(key) for key in keys]).alias(name)

    return read.select("eval_samples", *[part(n) for n in ("base_model", "fine_tuned", "improvement")])


def document_metrics(document: DataFrame) -> DataFrame:
    """(model, metric, value) rows of a document's two metric sets."""
    entries = [
        F.struct(
            F.lit(model).alias("model"), F.lit(key).alias("metric"),
            F.col(f"{part}.{key}").alias("value"),
        )
        for part, model in _PARTS.items() for key in config.METRIC_DIGITS
    ]
    return document.select(F.inline(F.array(*entries)))
