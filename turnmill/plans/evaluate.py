"""From prediction tables to metrics, comparison and report tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from turnmill import config
from turnmill.operators import compare, scoring, trainlog
from turnmill.scratch import stage
from turnmill.sources.metrics import write_document
from turnmill.sources.predictions import write_predictions


def evaluate(predictions: DataFrame, path: str | None = None) -> dict[str, DataFrame]:
    """Score once, then derive every table from the kept row scores.

    With a ``path`` the predictions are written below it as CSV and the result document as
    JSON.
    """
    scores = stage(scoring.scored_answers(predictions), "row_scores")
    metrics = stage(scoring.metric_rows(scoring.corpus_metrics(scores)), "metrics")
    samples = scores.agg(F.count_if(F.col("model") == config.MODELS[0]).alias("eval_samples"))
    document = compare.document(metrics, samples)
    if path is not None:
        write_predictions(predictions, f"{path}/predictions.csv")
        write_document(document, f"{path}/metrics.json")
    return {
        "row_scores": scores,
        "metrics": metrics,
        "document": document,
        "summary": compare.summary(metrics),
        "per_intent": scoring.per_intent_rouge1(scores),
    }


def report(predictions: DataFrame, metrics: DataFrame, log: DataFrame) -> dict[str, DataFrame]:
    """The tables a report and its charts are drawn from; ``predictions`` may come from
    the prediction file."""
    counts = stage(scoring.length_counts(predictions), "length_counts")
    return {
        "verdict": compare.verdict(metrics),
        "executive": compare.executive(metrics),
        "comparison": compare.series(metrics),
        "rouge_breakdown": compare.series(metrics, config.ROUGE_KEYS),
        "improvement": compare.improvement_series(metrics),
        "lengths": scoring.length_histogram(predictions, counts=counts),
        "length_means": scoring.length_means(predictions, counts=counts),
        "loss_curve": trainlog.loss_curve(log),
        "training": trainlog.statistics(log),
        "examples": compare.examples(predictions),
        "guide": compare.guide(metrics),
    }
