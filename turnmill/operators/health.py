"""Counts and length statistics of curated data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from turnmill import config
from turnmill.functions.text import is_blank, previews
from turnmill.operators.cleaning import clean_rows, has_marker, reject_reason
from turnmill.operators.sampling import dedup_key, order_hash


def funnel(df: DataFrame, params: config.CurateParams | None = None) -> DataFrame:
    """Row counts after each curation stage, in one pass and without moving texts.

    Rows are grouped by key digest; a group carries its size, its count of rows with
    markers left, and whether the row that dedup keeps passes the quality rules.
    """
    p = params or config.CurateParams()
    instruction, response = F.col("instruction"), F.col("response")
    blank = is_blank(instruction) | is_blank(response)
    loaded = clean_rows(df.select("row_id", "instruction", "response", blank.alias("blank")), p)
    rows = loaded.select(
        F.when(~F.col("blank"), F.unhex(F.sha2(dedup_key(), 256))).alias("key"),
        (~F.col("blank") & has_marker(response)).cast("long").alias("marked"),
        F.struct(
            order_hash(p.seed).alias("h"),
            "row_id",
            reject_reason(p).isNull().alias("passes"),
        ).alias("place"),
    )
    groups = rows.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("marked").alias("marked"),
        F.min("place")["passes"].alias("passes"),
    )
    real = F.col("key").isNotNull()
    total = groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("loaded"),
        F.coalesce(F.sum(F.when(real, F.col("n"))), F.lit(0)).alias("not_blank"),
        F.coalesce(F.sum("marked"), F.lit(0)).alias("with_markers"),
        F.count_if(real).alias("after_dedup"),
        F.count_if(real & F.col("passes")).alias("after_quality"),
    )
    return total.withColumns({
        "removed_blank": F.col("loaded") - F.col("not_blank"),
        "removed_repeats": F.col("not_blank") - F.col("after_dedup"),
        "removed_quality": F.col("after_dedup") - F.col("after_quality"),
    })


def split_sizes(df: DataFrame) -> DataFrame:
    """Rows per split and in total (``split`` is ``total``)."""
    return (
        df.rollup("split").agg(F.count(F.lit(1)).alias("rows"), F.grouping("split").alias("g"))
        .select(F.when(F.col("g") == 1, "total").otherwise(F.col("split")).alias("split"), "rows")
    )


def step_counts(df: DataFrame, params: config.TrainParams | None = None) -> DataFrame:
    """Optimiser steps one pass over the capped training split takes."""
    p = params or config.TrainParams()
    batch = p.batch_size * p.accumulation
    used = F.least(F.count_if(F.col("split") == "train"), F.lit(p.train_cap))
    return df.agg(used.alias("train_rows")).select(
        "train_rows",
        F.lit(batch).cast("long").alias("effective_batch"),
        F.ceil(F.col("train_rows") / batch).cast("long").alias("steps"),
    )


def _lengths(name: str, length: Column) -> list[Column]:
    return [
        F.min(length).cast("long").alias(f"{name}_min"),
        F.floor(F.try_divide(F.sum(length), F.count(length))).cast("long").alias(f"{name}_avg"),
        F.max(length).cast("long").alias(f"{name}_max"),
    ]


def first_preview(rows: DataFrame, row_id: str = "row_id", chars: int = config.PREVIEW_CHARS) -> DataFrame:
    """The column names, and the first row's values cut to a preview, as one row of texts.
    "First" is split order where there is one, else the key's."""
    order = [c for c in ("split_order", row_id) if c in rows.columns]
    names = [c for c in rows.columns if c not in ("split", "split_order")]
    one = rows.orderBy(*order).limit(1).select(*names)
    return one.select(*previews(one, chars)).select(
        F.lit(",".join(names)).alias("columns"),
        F.to_json(F.struct(*[F.col(f"`{n}`") for n in names])).alias("preview"))


def health(chat: DataFrame, long_chars: int = config.LONG_ANSWER_CHARS) -> DataFrame:
    """Marker contamination, message lengths and over-budget answers of chat rows."""
    user = F.col("messages")[1]["content"]
    answer = F.col("messages")[2]["content"]
    texts = chat.select(
        F.length(user).alias("user_len"),
        F.length(answer).alias("answer_len"),
        has_marker(answer).alias("marked"),
    )
    marked = F.count_if("marked")
    return texts.agg(
        F.count(F.lit(1)).alias("rows"),
        marked.alias("marked_rows"),
        F.floor(F.try_divide(100 * marked, F.count(F.lit(1)))).cast("long").alias("marked_percent"),
        *_lengths("user", F.col("user_len")),
        *_lengths("assistant", F.col("answer_len")),
        F.count_if(F.col("answer_len") > long_chars).alias("over_budget"),
    )
