"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from turnmill import config
from turnmill.functions import chat, markers, text
from turnmill.operators import bootstrap, cleaning, compare, health, sampling, scoring, semantic, trainlog
from turnmill.plans import curate as curate_plan
from turnmill.plans.evaluate import evaluate, report
from turnmill.scratch import scratch_path, stage
from turnmill.sources import metrics as metric_files
from turnmill.sources import predictions as prediction_files
from turnmill.sources import rows as row_files
from turnmill.sources import trainlog as log_files
from workload import fixtures as fx

REGISTRY: dict = {}


def query(function):
    REGISTRY[function.__name__] = function
    return function


# --- cleaning ---------------------------------------------------------------


@query
def f1_nonblank(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.drop_blank(fx.dirty_pairs(spark, sf))


@query
def c1_strip(spark, sf):
    return fx.dirty_pairs(spark, sf).select(
        "row_id", text.strip(F.col("instruction")).alias("instruction")
    )


def _replaced(spark, sf, **vocabulary):
    return fx.dirty_pairs(spark, sf).select(
        "row_id",
        markers.replace_markers(F.col("response"), F.col("row_id"), "response", **vocabulary)
        .alias("response"),
    )


@query
def c2_static(spark, sf):
    return _replaced(spark, sf, static=config.STATIC_MARKERS)


@query
def c3_generated(spark, sf):
    return _replaced(spark, sf, numbers=config.NUMBER_MARKERS)


@query
def c4_pool(spark, sf):
    return _replaced(spark, sf, pools=config.POOL_MARKERS)


@query
def c4_empty_pool(spark, sf):
    """A marker without choices becomes the neutral phrase."""
    return _replaced(spark, sf, pools={**config.POOL_MARKERS, "Order Number": []})


@query
def c8_no_vocabulary(spark, sf):
    """Without known markers all of them are left over."""
    params = config.CurateParams(static_markers={}, number_markers={}, pool_markers={})
    return fx.dirty_pairs(spark, sf).select(
        "row_id", markers.clean_text(F.col("response"), F.col("row_id"), "response", params).alias("response"))


@query
def c5_leftover(spark, sf):
    return fx.dirty_pairs(spark, sf).select(
        "row_id", markers.replace_leftover(F.col("response")).alias("response")
    )


@query
def c6_spaces(spark, sf):
    return fx.dirty_pairs(spark, sf).select(
        "row_id", text.collapse_spaces(F.col("response")).alias("response")
    )


@query
def c7_punct(spark, sf):
    return fx.dirty_pairs(spark, sf).select(
        "row_id", text.tighten_punctuation(F.col("response")).alias("response")
    )


@query
def c8_clean(spark, sf):
    return fx.dirty_pairs(spark, sf).select(
        "row_id",
        markers.clean_text(F.col("response"), F.col("row_id"), "response").alias("response"),
    )


@query
def c9_clean_row(spark, sf):
    return cleaning.clean_rows(cleaning.drop_blank(fx.dirty_pairs(spark, sf)))


@query
def c10_normalize(spark, sf):
    return fx.table(spark, sf, "documents").select(
        "doc_id", text.normalize(F.col("text")).alias("text")
    )


@query
def c11_words(spark, sf):
    w = text.words(F.col("text"))
    return fx.table(spark, sf, "documents").select(
        "doc_id",
        F.size(w).cast("long").alias("words"),
        F.array_join(w, "|").alias("joined"),
    )


@query
def c12_messages(spark, sf):
    m = F.col("messages")
    return cleaning.to_chat(fx.pairs(spark, sf)).select(
        "row_id",
        F.size(m).cast("long").alias("n"),
        F.array_join(F.transform(m, lambda x: x["role"]), ",").alias("roles"),
        m[0]["content"].alias("system"),
        m[1]["content"].alias("user"),
        m[2]["content"].alias("assistant"),
    )


@query
def c13_chat_columns(spark, sf):
    """Only the messages are left, as JSON text."""
    rows = cleaning.to_chat(fx.pairs(spark, sf).select("row_id", "instruction", "response"), keep=())
    return rows.select(F.lit(",".join(rows.columns)).alias("columns"), F.size("messages").cast("long").alias("n"),
                       F.col("messages")[1]["content"].alias("user"))


@query
def c14_default(spark, sf):
    rows = fx.dirty_pairs(spark, sf).drop("category").withColumn(
        "intent", F.when(F.col("intent") != "intent_3", F.col("intent"))
    )
    return cleaning.with_defaults(rows).select("row_id", "intent", "category")


@query
def c15_truncate(spark, sf):
    return fx.table(spark, sf, "documents").select(
        "doc_id", text.excerpt(F.col("text"), config.EXCERPT_CHARS).alias("excerpt")
    )


@query
def c16_preview(spark, sf):
    rows = fx.table(spark, sf, "documents")
    return rows.select(*text.previews(rows, config.PREVIEW_CHARS))


@query
def c17_json(spark, sf):
    rows = fx.pairs(spark, sf).select("row_id", "intent", "category", "k")
    return rows.select("row_id", text.row_json(rows).alias("json"))


@query
def c18_format(spark, sf):
    value = F.when(F.col("event_type") != "error", F.col("value"))
    return fx.table(spark, sf, "events").select(
        "event_id", text.fixed(value, 4).alias("four"), text.fixed(value, 2).alias("two")
    )


@query
def c19_marker(spark, sf):
    delta = F.when(F.col("event_type") != "error", (F.col("value") - 50) / 5000)
    return fx.table(spark, sf, "events").select(
        "event_id",
        text.change_direction(delta).alias("direction"),
        text.change_text(delta).alias("change"),
    )


# --- chat text --------------------------------------------------------------


@query
def c20_chat_text(spark, sf):
    rows = cleaning.to_chat(fx.pairs(spark, sf))
    return rows.select("row_id", chat.render(rows).alias("chat"))


@query
def c21_tools(spark, sf):
    rows = fx.tool_dialogs(spark, sf)
    return rows.select("row_id", chat.render(rows, tools="tools").alias("chat"))


@query
def c21_turns(spark, sf):
    """Conversations rendered turn by turn: what each turn adds, in turn order."""
    return cleaning.render_turns(fx.chat_turns(spark, sf))


@query
def c21_turns_tools(spark, sf):
    """Turns with a gap behind the first, tools listed, and an opened answer."""
    turns = fx.chat_turns(spark, sf).withColumn("turn", F.when(F.col("turn") > 1, F.col("turn") + 2).otherwise(F.col("turn")))
    tools = turns.where("turn = 1").select("conv_id", F.when(F.col("conv_id") % 3 == 0, F.array(
        F.lit('{"name": "lookup"}'), F.lit('{"name": "other"}'))).alias("tools"))
    return cleaning.render_turns(turns, tools, generation_prompt=True)


@query
def c22_prompt(spark, sf):
    override = F.when(F.col("k") % 2 == 0, F.col("category")).when(F.col("k") % 3 == 0, "")
    return fx.pairs(spark, sf).select(
        "row_id", chat.prompt(F.col("instruction"), override).alias("prompt")
    )


# --- quality filters --------------------------------------------------------


@query
def f2_quality(spark, sf):
    rows = cleaning.clean_rows(cleaning.drop_blank(fx.dirty_pairs(spark, sf)))
    return cleaning.keep_quality(rows).select("row_id", "instruction", "response")


@query
def f2_reject_reason(spark, sf):
    return fx.dirty_pairs(spark, sf).groupBy(
        F.coalesce(cleaning.reject_reason(), F.lit("kept")).alias("reason")
    ).agg(F.count(F.lit(1)).alias("rows"))


@query
def f3_contaminated(spark, sf):
    return fx.dirty_pairs(spark, sf).where(cleaning.has_marker(F.col("response"))).select("row_id")


@query
def f4_over_budget(spark, sf):
    long_text = F.length("response") > config.LONG_ANSWER_CHARS
    return fx.pairs(spark, sf).select("row_id", long_text.alias("over_budget"))


# --- order, dedup, split ----------------------------------------------------


@query
def s1_shuffle_rank(spark, sf):
    return fx.pairs(spark, sf).select("row_id", sampling.order_hash(42).alias("order_hash"))


@query
def s2_dedup(spark, sf):
    kept = sampling.dedup(fx.table(spark, sf, "documents"), 42, "text", "doc_id")
    return kept.select("doc_id", "lang", "source")


@query
def s3_dedup_then_filter(spark, sf):
    """The curated rows: repeats go first, then rows that fail the rules."""
    return curate_plan.curated(fx.dirty_pairs(spark, sf))


@query
def s4_split_exact(spark, sf):
    return curate_plan.split_rows(fx.dirty_pairs(spark, sf)).select("row_id", "split")


@query
def s5_split_hash(spark, sf):
    return sampling.split_hashed(
        fx.table(spark, sf, "documents").select("doc_id"), row_id="doc_id"
    ).select("doc_id", "bucket", "split")


@query
def s5_split_hash_small(spark, sf):
    """A holdout of four in a thousand."""
    params = config.CurateParams(holdout_share=0.004)
    return sampling.split_hashed(fx.table(spark, sf, "events").select("event_id"), params, "event_id").select(
        "event_id", "split")


@query
def s6_eval_sample(spark, sf):
    n = config.EVAL_SAMPLES
    rows = sampling.split_first(fx.table(spark, sf, "documents"), {"test": n}, row_id="doc_id")
    return sampling.in_order(rows, n, "doc_id").select("doc_id", "split", "split_order", "text")


@query
def s7_train_subset(spark, sf):
    p = config.TrainParams()
    caps = {"train": p.train_cap, "validation": p.validation_cap}
    rows = sampling.split_first(fx.table(spark, sf, "events"), caps, row_id="event_id")
    return rows.select("event_id", "split")


@query
def s8_first_example(spark, sf):
    rows = stage(curate_plan.curated(fx.dirty_pairs(spark, sf)), "curated")
    return sampling.split_first(rows, dict.fromkeys(sampling.SPLITS, 1)).select(
        "split", "row_id", "instruction", "response"
    )


@query
def s9_examples(spark, sf):
    return compare.examples(fx.predictions(spark, sf)).select("example", "row_id", "prompt")


# --- counts and health ------------------------------------------------------


@query
def a1_funnel(spark, sf):
    return health.funnel(fx.dirty_pairs(spark, sf))


@query
def a2_split_sizes(spark, sf):
    return health.split_sizes(curate_plan.split_rows(fx.dirty_pairs(spark, sf)))


def _train_chat(spark, sf):
    rows = curate_plan.split_rows(fx.dirty_pairs(spark, sf))
    return cleaning.to_chat(rows.where(F.col("split") == "train"))


@query
def a3_contamination_pct(spark, sf):
    """Over uncleaned rows, so that there is something to count."""
    return health.health(cleaning.to_chat(cleaning.drop_blank(fx.dirty_pairs(spark, sf)))).select(
        "rows", "marked_rows", "marked_percent"
    )


@query
def a4_lengths(spark, sf):
    return health.health(_train_chat(spark, sf)).select(
        "user_min", "user_avg", "user_max", "assistant_min", "assistant_avg", "assistant_max"
    )


@query
def a5_over_budget(spark, sf):
    return health.health(cleaning.to_chat(fx.pairs(spark, sf))).select("rows", "over_budget")


@query
def r13_health(spark, sf):
    """Statistics, and names and a preview of the first train row."""
    rows = curate_plan.split_rows(fx.dirty_pairs(spark, sf)).where(F.col("split") == "train")
    report = health.health(cleaning.to_chat(rows))
    first = health.first_preview(rows)
    return report.select("*", first.select("columns").scalar().alias("columns"),
                         first.select("preview").scalar().alias("preview"))


@query
def a20_steps(spark, sf):
    rows = sampling.split_exact(fx.table(spark, sf, "events").select("event_id"), row_id="event_id")
    return health.step_counts(rows)


# --- scores -----------------------------------------------------------------


def _metrics(spark, sf, metrics=scoring.ALL_METRICS):
    return scoring.metric_set(fx.predictions(spark, sf), metrics)


@query
def a6_exact_match(spark, sf):
    return _metrics(spark, sf, ("exact_match",))


@query
def a7_word_lengths(spark, sf):
    return _metrics(spark, sf, ("avg_pred_length_words", "avg_ref_length_words"))


@query
def a8_overlap_proxy(spark, sf):
    return _metrics(spark, sf, ("approx_perplexity",))


@query
def a9_rouge1(spark, sf):
    return _metrics(spark, sf, ("rouge1",))


@query
def a10_rouge2(spark, sf):
    return _metrics(spark, sf, ("rouge2",))


@query
def a11_rougeL(spark, sf):
    return _metrics(spark, sf, ("rougeL",))


@query
def a12_rougeLsum(spark, sf):
    return _metrics(spark, sf, ("rougeLsum",))


@query
def a9_rouge_intervals(spark, sf):
    """Means of the four ROUGE scores per model, with low, mid and high of resampled means;
    examples are resampled, so both models see the same draws."""
    rows = scoring.scored_answers(fx.predictions(spark, sf), config.ROUGE_KEYS, keep=("row_id",))
    return bootstrap.resampled_means(rows, "row_id", ["model"], list(config.ROUGE_KEYS))


@query
def a13_bleu(spark, sf):
    return _metrics(spark, sf, ("bleu",))


@query
def a14_semantic(spark, sf):
    return _metrics(spark, sf, ("bertscore_f1",))


@query
def a14_semantic_rows(spark, sf):
    """Precision, recall and f1 of every answer by greedy token alignment, with idf over the
    references."""
    predictions = fx.predictions(spark, sf)
    answers = scoring.stack_answers(predictions, keep=("row_id",))
    return semantic.greedy_alignment(answers, fx.table(spark, sf, "embeddings"), predictions.select("reference"))


@query
def a14_semantic_score(spark, sf):
    """The semantic score of each model: the mean f1 of its answers."""
    rows = a14_semantic_rows(spark, sf)
    return rows.groupBy("model").agg(
        F.round(F.avg("f1"), semantic.DIGITS).alias("semantic_f1"), F.count("*").alias("answers")
    )


@query
def a15_latency(spark, sf):
    return _metrics(spark, sf, ("avg_generation_time_sec",))


@query
def row_scores(spark, sf):
    """Scores of every single answer, the table that corpus values are summed from."""
    rows = scoring.scored_answers(fx.predictions(spark, sf), scoring.ALL_METRICS, keep=("row_id",))
    return rows.select(
        "row_id", "model", "exact", "answer_words", "reference_words",
        *[F.round(c, 6).alias(c) for c in ("shared_words", *config.ROUGE_KEYS)],
        "m1", "m2", "m3", "m4", "answer_size", "reference_size",
    )


@query
def a16_per_intent(spark, sf):
    table = scoring.per_intent_rouge1(scoring.scored_answers(fx.predictions(spark, sf), ("rouge1",)))
    return table.select(
        "intent", "rows", *[F.round(c, 6).alias(c) for c in ("base_rouge1", "ft_rouge1", "delta")]
    )


@query
def a17_histogram(spark, sf):
    table = scoring.length_histogram(fx.predictions(spark, sf))
    return table.select(
        "series", "bin", F.round("low", 6).alias("low"), F.round("high", 6).alias("high"), "n"
    )


@query
def a18_series_means(spark, sf):
    return scoring.length_means(fx.predictions(spark, sf)).select(
        "series", F.round("mean_words", 6).alias("mean_words")
    )


# --- pairing ----------------------------------------------------------------


@query
def j1_pair_ref(spark, sf):
    answers = fx.runs(spark, sf).select("row_id", "model", "answer")
    references = fx.pairs(spark, sf).select("row_id", F.col("response").alias("reference"))
    return answers.join(references, "row_id")


@query
def j2_repeated_runs(spark, sf):
    """Every third answer once more, shorter and with another time: whole rows win."""
    runs = fx.runs(spark, sf)
    again = runs.where(markers.draw(F.col("row_id")) % 3 == 0).select(
        "row_id", "model", F.substring("answer", 1, 10).alias("answer"), (F.col("sec") + 100).alias("sec"))
    models = {"baseline": "model.v1-base", "fine_tuned": "model.v1-tuned"}
    named = F.when(F.col("model") == "baseline", models["baseline"]).otherwise(models["fine_tuned"])
    references = fx.pairs(spark, sf).select("row_id", F.col("response").alias("reference"))
    paired = scoring.pair_runs(runs.union(again).withColumn("model", named), references, tuple(models.values()))
    return paired.select("row_id", "reference", *[
        F.col(f"`{name}{end}`").alias(f"{short}{end}") for short, name in models.items() for end in ("", "_sec")])


@query
def j2_side_by_side(spark, sf):
    references = fx.pairs(spark, sf).select(
        "row_id", F.col("instruction").alias("prompt"), F.col("response").alias("reference")
    )
    return scoring.pair_runs(fx.runs(spark, sf), references)


# --- comparison and report tables -------------------------------------------


@query
def r1_metric_set(spark, sf):
    return _metrics(spark, sf)


@query
def r2_improvement(spark, sf):
    return compare.improvement(_metrics(spark, sf))


@query
def r3_result(spark, sf):
    """The result document, flattened."""
    wide = scoring.corpus_metrics(
        scoring.scored_answers(fx.predictions(spark, sf), scoring.ALL_METRICS, keep=()), scoring.ALL_METRICS)
    wide = stage(wide, "corpus")
    samples = wide.agg(F.max("eval_samples").alias("eval_samples"))
    document = compare.document(scoring.metric_rows(wide, scoring.ALL_METRICS), samples)
    return document.select("eval_samples", *[
        F.col(f"{part}.{m}").alias(f"{part}_{m}")
        for part in ("base_model", "fine_tuned", "improvement") for m in scoring.ALL_METRICS
        if part != "improvement" or m != "avg_generation_time_sec"
    ])


@query
def r4_summary(spark, sf):
    return compare.summary(_metrics(spark, sf, tuple(config.SUMMARY_LABELS)))


@query
def r5_verdict(spark, sf):
    return compare.verdict(_metrics(spark, sf, ("rouge1", "bleu")))


@query
def r6_executive(spark, sf):
    return compare.executive(_metrics(spark, sf, tuple(config.EXECUTIVE_ROWS)))


@query
def r7_bars(spark, sf):
    return compare.series(_metrics(spark, sf, config.COMPARISON_KEYS))


@query
def r8_rouge_series(spark, sf):
    return compare.series(_metrics(spark, sf, config.ROUGE_KEYS), config.ROUGE_KEYS)


@query
def r9_heat_scale(spark, sf):
    return compare.improvement_series(_metrics(spark, sf, config.IMPROVEMENT_KEYS))


@query
def r11_examples(spark, sf):
    return compare.examples(fx.predictions(spark, sf))


@query
def r12_thresholds(spark, sf):
    return compare.guide(_metrics(spark, sf, tuple(config.METRIC_GUIDE)))


@query
def f6_dropna(spark, sf):
    """Texts per series that are not null."""
    rows = fx.predictions(spark, sf).withColumn(
        "fine_tuned", F.when(F.col("category") != "CAT_1", F.col("fine_tuned"))
    )
    return scoring.length_counts(rows).groupBy("series").agg(F.sum("n").alias("texts"))


@query
def f7_intent_guard(spark, sf):
    table = scoring.per_intent_rouge1(scoring.scored_answers(fx.predictions(spark, sf), ("rouge1",)))
    return table.agg(F.sum("rows").alias("rows"), F.count(F.lit(1)).alias("intents"))


@query
def f8_min_group(spark, sf):
    """Intents narrowed to a conversation, so that many hold a single example: those
    are skipped."""
    rows = fx.predictions(spark, sf).withColumn(
        "intent", F.concat("intent", F.lit("/"), F.substring_index("row_id", "-", 1))
    )
    scores = scoring.row_scores(scoring.stack_answers(rows), ("rouge1",))
    return scoring.per_intent_rouge1(scores).select("intent", "rows")


# --- training log -----------------------------------------------------------


@query
def f5_log_kind(spark, sf):
    return trainlog.with_kind(fx.train_log(spark, sf))


@query
def a19_train_stats(spark, sf):
    return trainlog.statistics(fx.train_log(spark, sf))


@query
def r10_loss_curve(spark, sf):
    return trainlog.loss_curve(fx.train_log(spark, sf))


@query
def r10_loss_curve_both(spark, sf):
    """Curves of a log whose records at evaluation steps hold both losses."""
    return trainlog.loss_curve(fx.train_log_both(spark, sf))


# --- files ------------------------------------------------------------------


@query
def io3_raw_roundtrip(spark, sf):
    """Write raw splits, read one back by its folder."""
    path = scratch_path(spark, "raw_splits")
    row_files.write_splits(curate_plan.split_rows(fx.dirty_pairs(spark, sf)), path)
    return row_files.read_splits(spark, path, "train").select(
        "row_id", "instruction", "response", "intent", "category"
    )


@query
def io2_chat_roundtrip(spark, sf):
    """The whole curation plan: both sinks written, chat splits read back."""
    chat_path, raw_path = scratch_path(spark, "chat"), scratch_path(spark, "raw")
    curate_plan.curate(fx.dirty_pairs(spark, sf), chat_path, raw_path)
    m = F.col("messages")
    return row_files.read_splits(spark, chat_path).select(
        "split", "row_id", m[1]["content"].alias("user"), m[2]["content"].alias("assistant")
    )


@query
def io5_csv_roundtrip(spark, sf):
    path = scratch_path(spark, "predictions.csv")
    prediction_files.write_predictions(fx.predictions(spark, sf), path)
    return prediction_files.read_predictions(spark, path).select(*config.PREDICTION_SCHEMA.fieldNames())


@query
def io1_rows_without_key(spark, sf):
    """Raw rows without a key from CSV with its columns in another order."""
    path = scratch_path(spark, "raw.csv")
    rows = fx.dirty_pairs(spark, sf).select("category", "response", "intent", "instruction")
    rows.write.options(header=True, quote='"', escape='"', ignoreLeadingWhiteSpace=False,
                       ignoreTrailingWhiteSpace=False).csv(path)
    raw = row_files.read_rows(spark, path, "csv")
    return raw.select("instruction", "response", "intent", "category", F.length("row_id").cast("long").alias("key_length"))


@query
def io6_report_from_csv(spark, sf):
    """The report's examples from a prediction file that has no key."""
    path = scratch_path(spark, "predictions.csv")
    columns = config.PREDICTION_SCHEMA.fieldNames()
    prediction_files.write_predictions(fx.predictions(spark, sf), path, columns)
    predictions = prediction_files.read_predictions(spark, path)
    tables = report(predictions, _metrics(spark, sf), fx.train_log(spark, sf))
    texts = tables["lengths"].agg(F.sum("n").cast("long")).scalar()
    return tables["examples"].agg(F.count(F.lit(1)).alias("examples"), F.max("example").alias("last")).select(
        "examples", "last", texts.alias("texts"))


@query
def plan_evaluate(spark, sf):
    """The evaluation plan: its summary, read back from the files it writes."""
    path = scratch_path(spark, "evaluation")
    evaluate(fx.predictions(spark, sf), path)
    document = metric_files.read_document(spark, f"{path}/metrics.json")
    return metric_files.document_metrics(document)


@query
def io7_metrics_roundtrip(spark, sf):
    path = scratch_path(spark, "metrics.json")
    keys = ("rouge1", "bleu", "exact_match", "avg_pred_length_words")
    metrics = _metrics(spark, sf, keys)
    samples = fx.predictions(spark, sf).agg(F.count(F.lit(1)).alias("eval_samples"))
    metric_files.write_document(compare.document(metrics, samples), path)
    return metric_files.document_metrics(metric_files.read_document(spark, path))


def _written_log(spark, sf):
    path = scratch_path(spark, "training_log.json")
    fx.train_log(spark, sf).write.json(path)
    return path


@query
def io8_log_read(spark, sf):
    log = log_files.read_log(spark, _written_log(spark, sf), lines=True)
    return log.select("step", "loss", "eval_loss", "train_loss")


@query
def io9_state_read(spark, sf):
    """Trainer states of several runs, each a file with its own history of records."""
    path = scratch_path(spark, "trainer_state.json")
    record = F.struct("step", "loss", "eval_loss", "train_loss")
    # At most 31 records have their step in one run's range, so the lists stay short.
    states = fx.train_log(spark, sf).groupBy(F.expr("step div 310")).agg(
        F.collect_list(record).alias("log_history")
    )
    states.select("log_history").write.json(path)
    return log_files.read_state(spark, path, lines=True).select(
        "step", "loss", "eval_loss", "train_loss"
    )
