"""Inputs of the registered queries, derived by Spark from the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

TAIL = " order {{Order Number}} or {{Order Number}} , pay {{Currency Symbol}}5  at {{Odd Field}} ! {{}} "
TAIL_MARKERS = (
    "Tracking Number", "Invoice Number", "Account Number", "Refund Amount",
    "Delivery City", "Product Name", "Account Email", "Delivery Date", "Promo Code",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every user turn that an assistant turn answers.

    Turns are numbered without gaps, so the next turn is found by an equi-join on
    (conv_id, turn): a conversation of any length spreads over all tasks.
    """
    turns = table(spark, sf_dir, "conversations")
    asked = turns.where(F.col("role") == "user").select(
        "conv_id", "turn", F.col("text").alias("instruction")
    )
    answered = turns.where(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("response")
    )
    # A join by shuffle at every size. AQE may merge its output into few tasks; the Python
    # scoring deals its rows by text bytes itself (scoring.spread_for_python).
    return asked.join(answered.hint("shuffle_hash"), ["conv_id", "turn"]).select(
        F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("row_id"),
        "instruction",
        "response",
        F.concat(F.lit("intent_"), (F.col("conv_id") % 7).cast("string")).alias("intent"),
        F.concat(F.lit("CAT_"), (F.col("conv_id") % 3).cast("string")).alias("category"),
        (F.col("conv_id") * 31 + F.col("turn")).alias("k"),
    )


def dirty_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs with nulls, blanks, short texts and markers, and a lower-case copy of each."""
    k = F.col("k")
    tail_marker = F.element_at(F.array(*[F.lit(m) for m in TAIL_MARKERS]), (k % 9 + 1).cast("int"))
    instruction = (
        F.when(k % 11 == 0, F.lit(None).cast("string"))
        .when(k % 11 == 1, "   ")
        .when(k % 11 == 2, " Hi ")
        .otherwise(F.concat(F.lit("  "), F.col("instruction"), F.lit(" ")))
    )
    response = F.when(k % 13 != 5, F.concat(
        F.col("response"), F.lit(TAIL), F.lit("{{"), tail_marker, F.lit("}}")
    ))

    def row(row_id: Column, instruction: Column, response: Column) -> Column:
        return F.struct(
            row_id.alias("row_id"), instruction.alias("instruction"), response.alias("response")
        )

    return pairs(spark, sf_dir).select(
        "intent",
        "category",
        F.inline(F.array(
            row(F.col("row_id"), instruction, response),
            row(F.concat("row_id", F.lit("-copy")), F.lower("instruction"), F.col("response")),
        )),
    ).select("row_id", "instruction", "response", "intent", "category")


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers of two models: cut to half and to four fifths of the reference's words,
    and every seventh tuned answer equal to it up to case and spacing."""
    k = F.col("k")

    def share(part: float) -> Column:
        w = F.expr("filter(split(response, '\\\\s+'), x -> x != '')")
        return F.array_join(F.slice(w, 1, F.ceil(F.size(w) * F.lit(part)).cast("int")), " ")

    def hundredths(n: int, by: float) -> Column:
        return (k % n) / F.lit(by)

    return pairs(spark, sf_dir).select(
        "row_id",
        F.col("instruction").alias("prompt"),
        F.col("response").alias("reference"),
        share(0.5).alias("baseline"),
        F.when(k % 7 == 0, F.concat(F.lit(" "), F.lower("response")))
        .otherwise(share(0.8)).alias("fine_tuned"),
        F.when(k % 17 == 3, F.lit(None).cast("string")).when(k % 19 == 4, "")
        .otherwise(F.col("intent")).alias("intent"),
        "category",
        hundredths(97, 10.0).alias("baseline_sec"),
        hundredths(89, 10.0).alias("fine_tuned_sec"),
        hundredths(89, 100.0).alias("baseline_semantic_f1"),
        hundredths(83, 100.0).alias("fine_tuned_semantic_f1"),
    )


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same answers as two model runs would leave them: one row per answer."""
    return predictions(spark, sf_dir).select("row_id", F.inline(F.array(*[
        F.struct(
            F.lit(m).alias("model"), F.col(m).alias("answer"), F.col(f"{m}_sec").alias("sec")
        ) for m in ("baseline", "fine_tuned")
    ])))


def train_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a log record: sign-ups are validation records, all others training
    records; one summary record closes the log."""
    step = (F.col("event_id") + 1) * 10
    number = F.bround(F.lit(0.6) + F.col("value") / F.lit(100.0), 6)
    is_eval = F.col("event_type") == "signup"
    events = table(spark, sf_dir, "events")
    null = F.lit(None).cast("double")
    records = events.select(
        step.alias("step"),
        F.when(~is_eval, number).alias("loss"),
        F.when(is_eval, number).alias("eval_loss"),
        null.alias("train_loss"),
    )
    closing = events.agg(F.max(step).alias("step"), F.round(F.avg("value"), 6).alias("train_loss"))
    return records.unionByName(closing.select(
        "step", null.alias("loss"), null.alias("eval_loss"), "train_loss"
    ))


def train_log_both(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The training log in which every fifth training record also holds a validation loss,
    as records written at an evaluation step do."""
    both = F.col("loss").isNotNull() & (F.col("step") % 50 == 10)
    return train_log(spark, sf_dir).withColumn("eval_loss", F.when(both, F.col("loss")).otherwise(F.col("eval_loss")))


def chat_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation turns; every fourth conversation calls tools and gets tool answers."""
    uses_tools = F.col("conv_id") % 4 == 0
    call = F.struct(
        F.lit("lookup").alias("name"),
        F.concat(F.lit('{"turn": '), F.col("turn").cast("string"), F.lit("}")).alias("arguments"),
    )
    return table(spark, sf_dir, "conversations").select(
        "conv_id",
        "turn",
        F.when(uses_tools & (F.col("role") == "user") & (F.col("turn") > 1), "tool")
        .otherwise(F.col("role")).alias("role"),
        F.col("text").alias("content"),
        F.when(uses_tools & (F.col("role") == "assistant"), F.array(call)).alias("tool_calls"),
    )


def tool_dialogs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each pair as a dialogue with a tool call and two tool answers in a row; every
    second one opens with a system message and every third one lists tools."""
    k = F.col("k")
    calls = F.array(F.struct(F.struct(
        F.lit("lookup").alias("name"),
        F.concat(F.lit('{"key": '), k.cast("string"), F.lit("}")).alias("arguments"),
    ).alias("function")))

    def message(role: str, content: Column, tool_calls: Column | None = None) -> Column:
        empty = F.when(F.lit(False), calls)
        return F.struct(
            F.lit(role).alias("role"), content.alias("content"),
            (empty if tool_calls is None else tool_calls).alias("tool_calls"),
        )

    body = F.array(
        message("user", F.col("instruction")),
        message("assistant", F.when(k % 5 != 0, F.lit("One moment.")), calls),
        message("tool", F.concat(F.lit("found "), k.cast("string"))),
        message("tool", F.col("category")),
        message("assistant", F.col("response")),
    )
    opening = F.array(message("system", F.lit("Be brief.")))
    tools = F.array(F.lit('{"name": "lookup"}'), F.lit('{"name": "other"}'))
    return pairs(spark, sf_dir).select(
        "row_id",
        F.when(k % 2 == 0, F.concat(opening, body)).otherwise(body).alias("messages"),
        F.when(k % 3 == 0, tools).alias("tools"),
    )
