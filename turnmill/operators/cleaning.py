"""Row filters and cleaning steps; all of them map-only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from turnmill import config
from turnmill.functions import chat, markers
from turnmill.functions.text import is_blank, strip


def with_row_id(df: DataFrame) -> DataFrame:
    """Give rows without a key one that is the same on every read: a hash of all
    columns. Identical rows share it."""
    columns = F.to_json(F.struct(*[F.col(f"`{c}`") for c in sorted(df.columns)]))
    names = [c for c in df.columns if c != "row_id"]
    return df.select(F.sha2(columns, 256).alias("row_id"), *[F.col(f"`{c}`") for c in names])


def with_defaults(df: DataFrame, columns=("intent", "category"), default: str = "") -> DataFrame:
    """Add optional columns that are missing; values present stay, nulls included."""
    missing = {c: F.lit(default) for c in columns if c not in df.columns}
    return df.withColumns(missing) if missing else df


def drop_blank(df: DataFrame) -> DataFrame:
    """Keep rows whose instruction and response both hold text."""
    return df.where(~is_blank(F.col("instruction")) & ~is_blank(F.col("response")))


def clean_rows(df: DataFrame, params: config.CurateParams | None = None) -> DataFrame:
    """Clean instruction and response; every other column is carried along."""
    return df.withColumns({
        c: markers.clean_text(F.col(c), F.col("row_id"), c, params)
        for c in ("instruction", "response")
    })


def reject_reason(params: config.CurateParams | None = None) -> Column:
    """Why a row fails the quality rules: empty, too_short, too_long; null if it passes."""
    p = params or config.CurateParams()
    instruction, response = F.col("instruction"), F.col("response")
    total = len(p.system_prompt) + F.length(instruction) + F.length(response)
    return (
        F.when(is_blank(instruction) | is_blank(response), "empty")
        .when(F.length(strip(instruction)) < p.min_instruction_chars, "too_short")
        .when(total > p.max_total_chars, "too_long")
    )


def keep_quality(df: DataFrame, params: config.CurateParams | None = None) -> DataFrame:
    return df.where(reject_reason(params).isNull())


def has_marker(text: Column) -> Column:
    """True if template markers are left in the text."""
    return F.contains(text, F.lit("{{"))


def to_chat(df: DataFrame, keep=("split", "row_id"), system: str = config.SYSTEM_PROMPT) -> DataFrame:
    """Message lists only; source columns are dropped."""
    kept = [c for c in keep if c in df.columns]
    return df.select(
        *kept, chat.messages(F.col("instruction"), F.col("response"), system).alias("messages")
    )


def render_turns(turns: DataFrame, tools: DataFrame | None = None, generation_prompt: bool = False) -> DataFrame:
    """Chat text of conversations kept as one row per turn: (conv_id, turn, chat_text).

    A conversation's text is its rows' texts in turn order. A turn's text needs the roles
    of turns ``turn - 1`` and ``turn + 1`` only, found by equi-joins on (conv_id, turn): a
    conversation of any length spreads over all tasks and is never gathered in one. Its
    first and last turn are the smallest and largest number, whatever gaps there are; a
    turn at a gap has no neighbour there. ``tools`` holds (conv_id, tools), an array with
    one JSON text per tool; ``generation_prompt`` opens an assistant block behind the last
    turn. Rows without ``conv_id`` or ``turn`` belong to no conversation and are left out.
    """
    turns = turns.where("conv_id is not null and turn is not null")
    roles = turns.select("conv_id", "turn", "role")
    before = roles.select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("role").alias("before"))
    after = roles.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("role").alias("after"))
    ends = turns.groupBy("conv_id").agg(F.min("turn").alias("_first"), F.max("turn").alias("_last"))
    role, content = F.col("role"), F.col("content")
    first, last = F.col("turn") == F.col("_first"), F.col("turn") == F.col("_last")
    calls = F.col("tool_calls") if "tool_calls" in turns.columns else None
    rows = turns.join(before, ["conv_id", "turn"], "left").join(after, ["conv_id", "turn"], "left").join(ends, "conv_id")
    listed = None
    if tools is not None:
        rows = rows.join(tools.select("conv_id", F.col("tools").alias("_tools")), "conv_id", "left")
        listed = F.coalesce("_tools", F.array().cast("array<string>"))
    own = chat.segment(role, content, F.col("before"), F.col("after"), first, calls)
    header = F.when(first, chat.system_header(role, content, listed)).otherwise(F.lit(""))
    parts = [header, own]
    if generation_prompt:
        parts.append(F.when(last, "<|im_start|>assistant\n").otherwise(F.lit("")))
    return rows.select("conv_id", "turn", F.concat(*parts).alias("chat_text"))
