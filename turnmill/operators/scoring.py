"""Scores of model answers: one row per answer first, then sums."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from turnmill import config
from turnmill.functions import overlap
from turnmill.functions.text import rounded, word_count

ALL_METRICS = tuple(config.METRIC_DIGITS)


def pair_runs(runs: DataFrame, references: DataFrame, models=config.MODELS) -> DataFrame:
    """One row per example with the answers of all models side by side.

    ``runs`` holds (row_id, model, answer, sec); ``references`` the prompts and
    reference answers. Examples a model did not answer are left out. Of several answers
    of one model to one example a whole row is taken: the answer that sorts last, and of
    equal ones the slowest, so that answer and time belong together. The answers are
    brought together by one grouping on ``row_id``, which is also the join key.
    """
    runs = runs.where(F.col("model").isin(list(models)) & F.col("answer").isNotNull() & F.col("row_id").isNotNull())
    timed = "sec" in runs.columns
    one = F.struct("answer", *(["sec"] if timed else []))
    wide = runs.groupBy("row_id").agg(*[
        F.max(F.when(F.col("model") == model, one)).alias(f"_{i}") for i, model in enumerate(models)
    ])
    columns = []
    for i, model in enumerate(models):
        wide = wide.where(F.col(f"_{i}").isNotNull())
        columns.append(F.col(f"_{i}.answer").alias(model))
        if timed:
            columns.append(F.col(f"_{i}.sec").alias(f"{model}_sec"))
    return references.join(wide.select("row_id", *columns), "row_id")


def stack_answers(predictions: DataFrame, models=config.MODELS, keep=("row_id", "intent")) -> DataFrame:
    """One row per (example, model): wide answers become long, without a shuffle."""
    def of_model(model: str) -> Column:
        def optional(name: str) -> Column:
            found = F.col(f"`{name}`") if name in predictions.columns else F.lit(None)
            return found.cast("double")

        return F.struct(
            F.lit(model).alias("model"),
            F.col(f"`{model}`").alias("answer"),
            optional(f"{model}_sec").alias("sec"),
            optional(f"{model}_semantic_f1").alias("semantic_f1"),
        )

    kept = [c for c in keep if c in predictions.columns]
    return predictions.select(
        *kept,
        "reference",
        F.inline(F.array(*[of_model(m) for m in models])),
    )


def row_scores(answers: DataFrame, metrics=ALL_METRICS) -> DataFrame:
    """Scores of every answer that the asked corpus metrics need; map-only.

    Takes (model, answer, reference) and carries other columns along.
    """
    answer = F.coalesce(F.col("answer"), F.lit(""))
    reference = F.coalesce(F.col("reference"), F.lit(""))
    out: dict[str, Column] = {}
    if "exact_match" in metrics:
        out["exact"] = overlap.exact_match(answer, reference)
    if "avg_pred_length_words" in metrics:
        out["answer_words"] = word_count(answer)
    if "avg_ref_length_words" in metrics:
        out["reference_words"] = word_count(reference)
    if "approx_perplexity" in metrics:
        out["shared_words"] = overlap.shared_word_share(answer, reference)
    rouge = tuple(k for k in config.ROUGE_KEYS if k in metrics)
    if rouge:
        out["rouge"] = overlap.rouge_scores(rouge)(
            overlap.rouge_text(answer), overlap.rouge_text(reference)
        )
    if "bleu" in metrics:
        out["bleu"] = overlap.bleu_counts()(overlap.bleu_text(answer), overlap.bleu_text(reference))
    scored = answers.withColumns(out)
    kept = [c for c in answers.columns if c not in ("answer", "reference")]
    flat = [F.col(c) for c in (*kept, *(k for k in out if k not in ("rouge", "bleu")))]
    flat += [F.col(f"rouge.{k}").alias(k) for k in rouge]
    if "bleu" in metrics:
        flat += [F.col("bleu.*")]
    return scored.select(*flat)


PYTHON_TASK_BYTES = 1 << 20  # text bytes a Python scoring task is given


def spread_for_python(df: DataFrame, texts: list[Column]) -> DataFrame:
    """``df`` dealt over enough tasks for the Python work on ``texts``.

    Shuffles are sized by bytes, and AQE merges small ones; but scoring a byte of text in
    Python costs far more than moving it, so a table of a few megabytes would be scored by
    one task. The text bytes are counted (one aggregate) and the rows dealt round-robin,
    sorted first so that a retry deals them alike, over one task per ``PYTHON_TASK_BYTES``
    and at least one per core. An explicit count is kept as it is by AQE.
    """
    spark = df.sparkSession
    size = sum((F.octet_length(t) for t in texts), F.lit(0))
    total = df.agg(F.sum(size)).first()[0] or 0
    tasks = max(spark.sparkContext.defaultParallelism, -(-total // PYTHON_TASK_BYTES))
    return df.repartition(int(tasks))


def scored_answers(predictions: DataFrame, metrics=ALL_METRICS, models=config.MODELS,
                   keep=("row_id", "intent")) -> DataFrame:
    """What ``row_scores(stack_answers(...))`` gives, from wide rows.

    All models' answers of a row are scored together, so that the reference is prepared
    and sent to Python once; rows are multiplied afterwards, when only numbers are left.
    """
    reference = F.coalesce(F.col("reference"), F.lit(""))
    answers = [F.coalesce(F.col(f"`{m}`"), F.lit("")) for m in models]
    rouge = tuple(k for k in config.ROUGE_KEYS if k in metrics)
    kept = [c for c in keep if c in predictions.columns]
    wide: dict[str, Column] = {}
    if rouge or "bleu" in metrics:
        predictions = spread_for_python(predictions, [reference, *answers])
    if rouge:
        wide["_rouge"] = overlap.rouge_scores(rouge, len(models))(
            *[overlap.rouge_text(a) for a in answers], overlap.rouge_text(reference))
    if "bleu" in metrics:
        wide["_bleu"] = overlap.bleu_counts(len(models))(
            *[overlap.bleu_text(a) for a in answers], overlap.bleu_text(reference))
    if "avg_ref_length_words" in metrics:
        wide["_reference_words"] = word_count(reference)

    def optional(name: str) -> Column:
        found = F.col(f"`{name}`") if name in predictions.columns else F.lit(None)
        return found.cast("double")

    def of_model(i: int, model: str) -> Column:
        answer = answers[i]
        fields = [F.lit(model).alias("model"), optional(f"{model}_sec").alias("sec"),
                  optional(f"{model}_semantic_f1").alias("semantic_f1")]
        if "exact_match" in metrics:
            fields.append(overlap.exact_match(answer, reference).alias("exact"))
        if "avg_pred_length_words" in metrics:
            fields.append(word_count(answer).alias("answer_words"))
        if "avg_ref_length_words" in metrics:
            fields.append(F.col("_reference_words").alias("reference_words"))
        if "approx_perplexity" in metrics:
            fields.append(overlap.shared_word_share(answer, reference).alias("shared_words"))
        fields += [F.col(f"_rouge.m{i}_{k}").alias(k) for k in rouge]
        if "bleu" in metrics:
            fields += [F.col(f"_bleu.a{i}_{k}").alias(k) for k in overlap.BLEU_COUNTS]
        return F.struct(*fields)

    return predictions.withColumns(wide).select(
        *kept, F.inline(F.array(*[of_model(i, m) for i, m in enumerate(models)])))


def _corpus(metric: str) -> Column:
    """Corpus value of one metric over row scores, before rounding."""
    rows = F.count(F.lit(1))
    if metric in config.ROUGE_KEYS:
        return F.avg(metric)
    if metric == "exact_match":
        return F.sum("exact") / rows
    if metric == "avg_pred_length_words":
        return F.sum("answer_words") / rows
    if metric == "avg_ref_length_words":
        return F.sum("reference_words") / rows
    if metric == "approx_perplexity":
        return 1 / F.greatest(F.avg("shared_words"), F.lit(1e-6))
    if metric == "avg_generation_time_sec":
        return F.avg("sec")
    if metric == "bertscore_f1":
        return F.avg("semantic_f1")
    if metric == "bleu":
        possible = [
            F.sum(F.greatest(F.col("answer_size") - (n - 1), F.lit(0))) for n in overlap.ORDERS
        ]
        return overlap.bleu_from_sums(
            [F.sum(f"m{n}") for n in overlap.ORDERS], possible,
            F.sum("answer_size"), F.sum("reference_size"),
        )
    raise ValueError(f"unknown metric {metric!r}")


def corpus_metrics(scores: DataFrame, metrics=ALL_METRICS, by: str = "model") -> DataFrame:
    """Wide corpus values per model, rounded to each metric's digits.

    One aggregate: a map task sends a handful of sums, whatever its share of rows.
    """
    return scores.groupBy(by).agg(
        F.count(F.lit(1)).alias("eval_samples"),
        *[rounded(_corpus(m), config.METRIC_DIGITS[m]).alias(m) for m in metrics],
    )


def metric_rows(wide: DataFrame, metrics=ALL_METRICS) -> DataFrame:
    """Wide corpus values as (model, metric, value)."""
    return wide.unpivot(["model"], list(metrics), "metric", "value")


def metric_set(predictions: DataFrame, metrics=ALL_METRICS, models=config.MODELS) -> DataFrame:
    """(model, metric, value) of a predictions table."""
    scores = scored_answers(predictions, metrics, models, keep=())
    return metric_rows(corpus_metrics(scores, metrics), metrics)


def per_intent_rouge1(scores: DataFrame, base: str = "baseline", tuned: str = "fine_tuned",
                      min_rows: int = config.MIN_GROUP_ROWS) -> DataFrame:
    """Mean ROUGE-1 of both models per intent, smallest gain first.

    Reads row scores with ``intent``; null and empty intents and groups under
    ``min_rows`` examples are skipped.
    """
    value = {m: F.avg(F.when(F.col("model") == m, F.col("rouge1"))) for m in (base, tuned)}
    return (
        scores.where((F.col("intent") != "") & F.col("model").isin(base, tuned))
        .groupBy("intent")
        .agg(
            F.count_if(F.col("model") == base).alias("rows"),
            value[base].alias("base_rouge1"),
            value[tuned].alias("ft_rouge1"),
        )
        .where(F.col("rows") >= min_rows)
        .withColumn("delta", F.col("ft_rouge1") - F.col("base_rouge1"))
        .orderBy("delta", "intent")
    )


# ---------------------------------------------------------------------------
# Answer lengths
# ---------------------------------------------------------------------------

SERIES = ("reference", "baseline", "fine_tuned")


def length_counts(predictions: DataFrame, series=SERIES) -> DataFrame:
    """How many texts of each series have how many words; null texts are skipped.

    At most one row per series and distinct length, so that everything drawn from it
    is small.
    """
    columns = [F.struct(F.lit(s).alias("series"), F.col(s).alias("text")) for s in series]
    return (
        predictions.select(F.inline(F.array(*columns)))
        .where(F.col("text").isNotNull())
        .groupBy("series", word_count(F.col("text")).alias("words"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def length_histogram(predictions: DataFrame, bins: int = config.HISTOGRAM_BINS,
                     series=SERIES, counts: DataFrame | None = None) -> DataFrame:
    """Word-length histogram of all series over shared equal bins from 0 to the largest
    length plus 5; bins without texts are listed with 0. ``counts`` are ``length_counts``
    made before."""
    # Windows over everything see tables of bounded size only: one row per series and
    # distinct length, and one per series and bin.
    everything = Window.partitionBy()
    placed = (
        (length_counts(predictions, series) if counts is None else counts)
        .withColumn("upper", F.max("words").over(everything) + 5)
        .groupBy("series", (F.expr(f"words * {bins} div upper") + 1).alias("bin"))
        .agg(F.sum("n").alias("n"), F.max("upper").alias("upper"))
    )
    spine = predictions.sparkSession.range(1, bins + 1).select(
        F.col("id").alias("bin"), F.explode(F.array(*[F.lit(s) for s in series])).alias("series")
    )
    listed = spine.join(F.broadcast(placed), ["series", "bin"], "left").withColumn(
        "upper", F.max("upper").over(everything)
    )
    return listed.select(
        "series",
        "bin",
        ((F.col("bin") - 1) * F.col("upper") / bins).alias("low"),
        (F.col("bin") * F.col("upper") / bins).alias("high"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def length_means(predictions: DataFrame, series=SERIES, counts: DataFrame | None = None) -> DataFrame:
    """Mean word count per series; ``counts`` are ``length_counts`` made before."""
    return (
        (length_counts(predictions, series) if counts is None else counts).groupBy("series")
        .agg((F.sum(F.col("words") * F.col("n")) / F.sum("n")).alias("mean_words"))
    )
