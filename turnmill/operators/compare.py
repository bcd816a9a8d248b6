"""Comparison of two models' metrics, and the tables of a report.

All functions take the metric table (model, metric, value): a few dozen rows that
one aggregate over the scores has produced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row, Window, functions as F

from turnmill import config
from turnmill.operators.cleaning import with_row_id
from turnmill.functions.text import change_direction, change_text, excerpt, fixed, plain, present, rounded


def aligned(metrics: DataFrame, base: str = "baseline", tuned: str = "fine_tuned") -> DataFrame:
    """(metric, base, tuned): both models' values side by side."""
    def value(model: str) -> Column:
        return F.max(F.when(F.col("model") == model, F.col("value")))

    return metrics.groupBy("metric").agg(value(base).alias("base"), value(tuned).alias("tuned"))


def improvement(metrics: DataFrame, **models: str) -> DataFrame:
    """Adds ``delta``, tuned minus base to four digits; null if either is missing.

    Values are rounded already; the difference is taken after rounding. Generation
    time is not part of the deltas.
    """
    delta = rounded(F.col("tuned") - F.col("base"), 4)
    return aligned(metrics, **models).withColumn(
        "delta", F.when(F.col("metric") != "avg_generation_time_sec", delta)
    )


def _lookup(metrics: DataFrame, names: list[str], rows: list[tuple]) -> DataFrame:
    """A small fixed table as a DataFrame, with its order."""
    return metrics.sparkSession.createDataFrame(
        [Row(**dict(zip(["position", *names], (i, *row)))) for i, row in enumerate(rows, 1)]
    )


def _with_labels(values: DataFrame, labels: DataFrame) -> DataFrame:
    """Every labelled metric once, values null where the metric is missing."""
    return F.broadcast(labels).join(values, "metric", "left")


def summary(metrics: DataFrame) -> DataFrame:
    """Printed summary: label, both values, signed delta; missing as ``N/A``."""
    labels = _lookup(metrics, ["metric", "label"], list(config.SUMMARY_LABELS.items()))
    delta = F.col("delta")
    sign = F.when(delta >= 0, "+").otherwise("")
    return _with_labels(improvement(metrics), labels).select(
        F.col("position").cast("long").alias("position"),
        "label",
        plain(F.col("base")).alias("base"),
        plain(F.col("tuned")).alias("tuned"),
        present(delta, F.concat(sign, plain(delta))).alias("delta"),
    )


def verdict(metrics: DataFrame) -> DataFrame:
    """One row: ``success``, ``marginal`` or ``none``. A missing delta counts as 0."""
    def delta(metric: str) -> Column:
        found = F.max(F.when(F.col("metric") == metric, F.col("delta")))
        return F.coalesce(found, F.lit(0.0))

    return improvement(metrics).agg(
        delta("rouge1").alias("rouge1_delta"), delta("bleu").alias("bleu_delta")
    ).withColumn(
        "verdict",
        F.when((F.col("rouge1_delta") > 0.02) & (F.col("bleu_delta") > 0), "success")
        .when(F.col("rouge1_delta") > 0, "marginal")
        .otherwise("none"),
    )


def executive(metrics: DataFrame) -> DataFrame:
    """Headline table: formatted values, direction and text of the change."""
    rows = [(key, *row) for key, row in config.EXECUTIVE_ROWS.items()]
    labels = _lookup(metrics, ["metric", "label", "digits", "shows_change"], rows)

    def shown(value: Column) -> Column:
        return (
            F.when(value.isNull() & ~F.col("shows_change"), "—")
            .when(F.col("digits") == 4, fixed(value, 4))
            .when(F.col("digits") == 2, fixed(value, 2))
            .otherwise(plain(value))
        )

    delta = F.when(F.col("shows_change"), F.col("delta"))
    return _with_labels(improvement(metrics), labels).select(
        F.col("position").cast("long").alias("position"),
        "label",
        shown(F.col("base")).alias("base"),
        shown(F.col("tuned")).alias("tuned"),
        change_direction(delta).alias("direction"),
        F.when(F.col("shows_change"), change_text(delta)).otherwise("—").alias("change"),
    )


def series(metrics: DataFrame, keys=config.COMPARISON_KEYS) -> DataFrame:
    """Bar or radar values: every key for both models, 0 where missing."""
    labels = _lookup(metrics, ["metric"], [(k,) for k in keys])
    zero = F.lit(0.0)
    values = _with_labels(aligned(metrics), labels).select(
        "position", "metric",
        F.coalesce("base", zero).alias("baseline"), F.coalesce("tuned", zero).alias("fine_tuned"),
    )
    return values.unpivot(
        ["position", "metric"], ["baseline", "fine_tuned"], "model", "value"
    ).withColumn("position", F.col("position").cast("long"))


def improvement_series(metrics: DataFrame, keys=config.IMPROVEMENT_KEYS) -> DataFrame:
    """Deltas of the keys, 0 where missing, and the symmetric colour scale."""
    labels = _lookup(metrics, ["metric"], [(k,) for k in keys])
    deltas = _with_labels(improvement(metrics), labels).select(
        F.col("position").cast("long").alias("position"), "metric",
        F.coalesce("delta", F.lit(0.0)).alias("delta"),
    )
    every_key = Window.partitionBy()  # a handful of rows
    scale = F.greatest(
        F.abs(F.min("delta").over(every_key)), F.abs(F.max("delta").over(every_key)), F.lit(0.01)
    )
    return deltas.withColumn("scale", scale)


def guide(metrics: DataFrame) -> DataFrame:
    """What each metric means, and whether each model meets its threshold."""
    rows = [(key, *row) for key, row in config.METRIC_GUIDE.items()]
    labels = _lookup(
        metrics, ["metric", "label", "meaning", "range", "threshold", "higher_is_better"], rows
    )

    def meets(value: Column) -> Column:
        above, below = value > F.col("threshold"), value < F.col("threshold")
        return F.when(F.col("higher_is_better"), above).otherwise(below)

    return _with_labels(aligned(metrics), labels).select(
        F.col("position").cast("long").alias("position"),
        "label", "meaning", "range", "threshold",
        meets(F.col("base")).alias("base_meets"),
        meets(F.col("tuned")).alias("tuned_meets"),
    )


def examples(predictions: DataFrame, n: int = config.EXAMPLE_ROWS,
             limit: int = config.EXCERPT_CHARS) -> DataFrame:
    """The first ``n`` rows in evaluation order side by side, long texts cut with an
    ellipsis.

    The order is ``split_order``, if there, then ``row_id``; without a key, one is derived.
    The last key wanted is looked up on the order columns alone, so that texts of no more
    than ``n`` rows meet in one task.
    """
    if "row_id" not in predictions.columns:
        predictions = with_row_id(predictions)
    order = [c for c in ("split_order", "row_id") if c in predictions.columns]

    def optional(name: str) -> Column:
        found = F.col(name) if name in predictions.columns else F.lit(None).cast("string")
        return F.coalesce(found, F.lit("—"))

    firsts = predictions.select(*order).orderBy(*order).limit(n).collect()
    if len(firsts) == n:
        predictions = predictions.where(_upto([F.col(c) for c in order], list(firsts[-1])))
    picked = predictions.orderBy(*order).limit(n).select(
        *order,
        optional("intent").alias("intent"),
        optional("category").alias("category"),
        "prompt",
        *[excerpt(F.col(c), limit).alias(c) for c in ("reference", "baseline", "fine_tuned")],
    )
    # At most n rows are left, so numbering them in one task is no matter of scale.
    number = F.row_number().over(Window.orderBy(*order)).cast("long")
    return picked.withColumn("example", number).drop("split_order")


def _upto(columns: list[Column], values: list) -> Column:
    """Whether a row's columns sort no later than the values; null sorts first."""
    first, value = columns[0], values[0]
    before = F.lit(False) if value is None else first.isNull() | (first < F.lit(value))
    same = first.eqNullSafe(F.lit(value))
    return before | (same & _upto(columns[1:], values[1:]) if len(columns) > 1 else same)


def document(metrics: DataFrame, samples: DataFrame) -> DataFrame:
    """The nested result document as one row: sample count, both metric sets and the
    improvement, each a struct of metric values."""
    deltas = improvement(metrics)
    keys = list(config.METRIC_DIGITS)

    def part(column: str, leave_out=()) -> Column:
        def value(key: str) -> Column:
            return F.max(F.when(F.col("metric") == key, F.col(column))).alias(key)

        return F.struct(*[value(k) for k in keys if k not in leave_out])

    return deltas.agg(
        part("base").alias("base_model"),
        part("tuned").alias("fine_tuned"),
        part("delta", ["avg_generation_time_sec"]).alias("improvement"),
    ).select(samples.scalar().alias("eval_samples"), "base_model", "fine_tuned", "improvement")
