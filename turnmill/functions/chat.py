"""Message lists and rendered chat text.

A message is a struct of ``role`` and ``content`` and, where tools are used, a
nullable ``tool_calls`` array of structs of ``name`` and ``arguments`` (JSON text),
either directly or below a field ``function``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from turnmill import config
from turnmill.functions.text import strip


def _message(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def messages(instruction: Column, response: Column, system: str = config.SYSTEM_PROMPT) -> Column:
    """System, user and assistant message of one row."""
    return F.array(
        _message("system", F.lit(system)),
        _message("user", strip(instruction)),
        _message("assistant", strip(response)),
    )


def block(role: Column | str, content: Column) -> Column:
    """One rendered message."""
    role = F.lit(role) if isinstance(role, str) else role
    return F.concat(
        F.lit("<|im_start|>"), role, F.lit("\n"), F.coalesce(content, F.lit("")),
        F.lit("<|im_end|>\n"),
    )


def system_header(first_role: Column, first_content: Column, tools: Column | None = None) -> Column:
    """Opening system block: the first message if it is one, else the default text,
    with one JSON line per tool where there are tools."""
    text = F.when(first_role == "system", F.coalesce(first_content, F.lit(""))).otherwise(
        F.lit(config.DEFAULT_SYSTEM_TEXT)
    )
    plain = block("system", text)
    if tools is None:
        return plain
    lines = F.array_join(F.transform(tools, lambda tool: F.concat(F.lit("\n"), tool)), "")
    with_tools = F.concat(
        F.lit("<|im_start|>system\n"), text,
        F.lit(config.TOOLS_INTRO), lines, F.lit(config.TOOLS_OUTRO),
    )
    return F.when(F.size(tools) > 0, with_tools).otherwise(plain)


def call_blocks(calls: Column, nested: bool = False) -> Column:
    """Rendered tool calls of an assistant message."""

    def one(call: Column) -> Column:
        call = call["function"] if nested else call
        return F.concat(
            F.lit('\n<tool_call>\n{"name": "'), call["name"],
            F.lit('", "arguments": '), call["arguments"], F.lit("}\n</tool_call>"),
        )

    return F.array_join(F.transform(calls, one), "")


def segment(
    role: Column,
    content: Column,
    previous_role: Column,
    next_role: Column,
    is_first: Column,
    calls: Column | None = None,
    nested_calls: bool = False,
) -> Column:
    """Text one message adds to its conversation, after the system header.

    It depends on the neighbours' roles only: tool answers in a row share one user
    block. A system message at the start is part of the header and adds nothing.
    """
    content = F.coalesce(content, F.lit(""))
    plain = block(role, content)
    if calls is None:
        has_calls = F.lit(False)
        called = F.lit("")
    else:
        has_calls = F.coalesce(F.size(calls) > 0, F.lit(False))
        called = F.concat(
            F.lit("<|im_start|>assistant"),
            F.when(content != "", F.concat(F.lit("\n"), content)).otherwise(F.lit("")),
            call_blocks(calls, nested_calls),
            F.lit("<|im_end|>\n"),
        )
    answered = F.concat(
        F.when(previous_role.eqNullSafe("tool"), F.lit("")).otherwise(F.lit("<|im_start|>user")),
        F.lit("\n<tool_response>\n"), content, F.lit("\n</tool_response>"),
        F.when(next_role.eqNullSafe("tool"), F.lit("")).otherwise(F.lit("<|im_end|>\n")),
    )
    return (
        F.when((role == "user") | ((role == "system") & ~is_first), plain)
        .when((role == "assistant") & ~has_calls, plain)
        .when(role == "assistant", called)
        .when(role == "tool", answered)
        .otherwise(F.lit(""))
    )


def render(
    df: DataFrame,
    column: str = "messages",
    tools: str | None = None,
    generation_prompt: bool = False,
) -> Column:
    """Chat text of a column of message arrays.

    ``tools`` names an array column with one JSON text per tool. Whether messages
    carry tool calls is read off the schema.
    """
    fields = df.schema[column].dataType.elementType
    has_calls = "tool_calls" in fields.fieldNames()
    nested = has_calls and "function" in fields["tool_calls"].dataType.elementType.fieldNames()
    all_messages = F.col(column)
    first = F.get(all_messages, F.lit(0))

    def one(message: Column, i: Column) -> Column:
        return segment(
            message["role"],
            message["content"],
            F.when(i > 0, F.get(all_messages, i - 1)["role"]),
            F.get(all_messages, i + 1)["role"],
            i == 0,
            message["tool_calls"] if has_calls else None,
            nested,
        )

    parts = [
        system_header(first["role"], first["content"], F.col(tools) if tools else None),
        F.array_join(F.transform(all_messages, one), ""),
    ]
    if generation_prompt:
        parts.append(F.lit("<|im_start|>assistant\n"))
    return F.concat(*parts)


def prompt(user_text: Column, system: Column | None = None) -> Column:
    """Text a model is asked to continue; an empty override means the default."""
    default = F.lit(config.SYSTEM_PROMPT)
    text = default if system is None else F.when(F.length(system) > 0, system).otherwise(default)
    return F.concat(block("system", text), block("user", user_text), F.lit("<|im_start|>assistant\n"))
