"""Training-log analytics. A log mixes three kinds of records in one table; which kind
a record is shows in the column that is not null."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def record_kind() -> Column:
    return (
        F.when(F.col("loss").isNotNull(), "train")
        .when(F.col("eval_loss").isNotNull(), "eval")
        .otherwise("summary")
    )


def with_kind(log: DataFrame) -> DataFrame:
    return log.withColumn("kind", record_kind())


def loss_curve(log: DataFrame) -> DataFrame:
    """(series, step, loss) of training and validation, in step order; nothing if the log
    holds no training record.

    The series are read apart: every record with a training loss is a point of ``train``,
    every record with a validation loss one of ``validation``, so a record written at an
    evaluation step that holds both is a point of both (``kind`` names one kind only).
    """
    any_training = log.agg((F.count("loss") > 0).alias("any")).scalar()
    point = lambda series, column: F.struct(
        F.lit(series).alias("series"), F.col("step").alias("step"), F.col(column).cast("double").alias("loss")
    )
    points = F.filter(F.array(point("train", "loss"), point("validation", "eval_loss")), lambda p: p["loss"].isNotNull())
    return log.where(F.lit(any_training)).select(F.inline(points)).orderBy("series", "step")


def statistics(log: DataFrame) -> DataFrame:
    """First and last training loss, lowest validation loss, last step."""
    at = F.when(F.col("loss").isNotNull(), F.col("step"))
    return log.agg(
        F.min_by("loss", at).alias("first_loss"),
        F.max_by("loss", at).alias("last_loss"),
        F.min("eval_loss").alias("best_eval_loss"),
        F.max("step").alias("steps"),
    )
