from pyspark.sql import functions as F

from turnmill import config
from turnmill.functions import chat
from turnmill.operators import cleaning

DEFAULT = f"<|im_start|>system\n{config.DEFAULT_SYSTEM_TEXT}<|im_end|>\n"
SCHEMA = ("i long, tools array<string>, messages array<struct<role string, content string, "
          "tool_calls array<struct<name string, arguments string>>>>")


def rendered(spark, messages, tools=None, **options):
    df = spark.createDataFrame([(0, tools, messages)], SCHEMA)
    return df.select(chat.render(df, tools="tools", **options)).first()[0]


def test_plain_conversation(spark):
    got = rendered(spark, [("system", "S", None), ("user", "U", None), ("assistant", "A", [])])
    assert got == (
        "<|im_start|>system\nS<|im_end|>\n<|im_start|>user\nU<|im_end|>\n"
        "<|im_start|>assistant\nA<|im_end|>\n"
    )


def test_default_system_and_later_system_message(spark):
    got = rendered(spark, [("user", "U", None), ("system", "S2", None)], generation_prompt=True)
    assert got == (
        DEFAULT + "<|im_start|>user\nU<|im_end|>\n<|im_start|>system\nS2<|im_end|>\n"
        "<|im_start|>assistant\n"
    )


def test_tool_calls_and_two_answers_in_a_row(spark):
    got = rendered(spark, [
        ("user", "U", None),
        ("assistant", "", [("f", "{}"), ("g", '{"a": 1}')]),
        ("tool", "T1", None), ("tool", "T2", None),
        ("assistant", "wait", [("f", "{}")]),
        ("tool", "T3", None),
    ])
    assert got == (
        DEFAULT + "<|im_start|>user\nU<|im_end|>\n"
        '<|im_start|>assistant\n<tool_call>\n{"name": "f", "arguments": {}}\n</tool_call>'
        '\n<tool_call>\n{"name": "g", "arguments": {"a": 1}}\n</tool_call><|im_end|>\n'
        "<|im_start|>user\n<tool_response>\nT1\n</tool_response>\n<tool_response>\nT2\n</tool_response><|im_end|>\n"
        '<|im_start|>assistant\nwait\n<tool_call>\n{"name": "f", "arguments": {}}\n</tool_call><|im_end|>\n'
        "<|im_start|>user\n<tool_response>\nT3\n</tool_response><|im_end|>\n"
    )


def test_tools_header(spark):
    got = rendered(spark, [("system", "S", None)], ['{"name": "f"}', '{"name": "g"}'])
    assert got.startswith("<|im_start|>system\nS\n\n# Tools\n\n")
    assert '<tools>\n{"name": "f"}\n{"name": "g"}\n</tools>\n\nFor each' in got
    assert got.endswith('"arguments": <args-json-object>}\n</tool_call><|im_end|>\n')
    assert rendered(spark, [("system", "S", None)], []) == "<|im_start|>system\nS<|im_end|>\n"


def test_turns_concatenate_to_the_conversation(spark):
    messages = [
        ("user", "U", None), ("assistant", "x", [("f", "{}")]),
        ("tool", "T1", None), ("tool", "T2", None), ("assistant", "A", None),
    ]
    turns = spark.createDataFrame(
        [(7, t, *m) for t, m in enumerate(messages)],
        "conv_id long, turn long, role string, content string, "
        "tool_calls array<struct<name string, arguments string>>",
    )
    rows = cleaning.render_turns(turns).orderBy("turn").collect()
    assert "".join(r["chat_text"] for r in rows) == rendered(spark, messages)


def test_prompt(values):
    got = values(["S", "", None], chat.prompt(F.lit("U"), F.col("x")))
    tail = "<|im_end|>\n<|im_start|>user\nU<|im_end|>\n<|im_start|>assistant\n"
    assert got == [f"<|im_start|>system\n{s}{tail}" for s in ("S", config.SYSTEM_PROMPT, config.SYSTEM_PROMPT)]


def test_messages_are_stripped(spark):
    df = spark.createDataFrame([("1", " U ", "\tA ")], "row_id string, instruction string, response string")
    row = cleaning.to_chat(df).first()
    assert [tuple(m) for m in row["messages"]] == [
        ("system", config.SYSTEM_PROMPT), ("user", "U"), ("assistant", "A")]
    assert cleaning.to_chat(df, keep=()).columns == ["messages"]


def test_turns_with_gaps_tools_and_an_opened_answer(spark):
    turns = spark.createDataFrame(
        [(1, 1, "user", "a"), (1, 2, "assistant", "b"), (1, 4, "user", "c"), (None, 1, "user", "x")],
        "conv_id long, turn long, role string, content string")
    tools = spark.createDataFrame([(1, ["T"])], "conv_id long, tools array<string>")
    got = [r.chat_text for r in cleaning.render_turns(turns, tools, True).orderBy("turn").collect()]
    assert len(got) == 3 and sum("<|im_start|>system" in t for t in got) == 1 and "T" in got[0]
    assert got[2].endswith("<|im_start|>assistant\n") and not got[1].endswith("assistant\n")
