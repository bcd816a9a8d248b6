import random
import re

import pytest
from pyspark.sql import functions as F

from turnmill import config
from turnmill.functions import markers

X, KEY = F.col("x"), F.col("i").cast("string")


def test_leftover(values):
    inputs = ["{{Odd Field}}", "{{a\nb}}", "{{}}", "{{c}d}}", "x {{ y"]
    phrase = "your reference number"
    assert values(inputs, markers.replace_leftover(X)) == [phrase, phrase, "{{}}", "{{c}d}}", "x {{ y"]


def test_static_equals_one_replace_after_another(values):
    rng = random.Random(3)
    names = [*config.STATIC_MARKERS, "Unknown", "app", ""]
    inputs = ["", "no marker", "{{{App}}}", "{{{{App}}}}", "{{Order {{App}}}}", None] + [
        "".join(rng.choice(["{{", "}}", " $ ", "{{" + rng.choice(names) + "}}"]) for _ in range(8))
        for _ in range(100)
    ]

    def expected(text):
        for name, value in config.STATIC_MARKERS.items():
            text = text.replace("{{" + name + "}}", value)
        return text

    got = values(inputs, markers.replace_markers(X, KEY, "x", static=config.STATIC_MARKERS))
    assert got == [None if s is None else expected(s) for s in inputs]


def test_generated_values(values):
    names = [*config.NUMBER_MARKERS, *config.POOL_MARKERS]
    inputs = ["|".join("{{" + n + "}}" for n in names) * 2] * 300
    replace = markers.replace_markers(
        X, KEY, "x", numbers=config.NUMBER_MARKERS, pools=config.POOL_MARKERS
    )
    got = values(inputs, replace)
    assert got == values(inputs, replace)  # repeatable
    assert len(set(got)) == len(got)  # rows with the same text draw different values
    seen = {name: set() for name in names}
    for row in got:
        for part, name in zip(row.split("|"), names):
            seen[name].add(part)
    for name, pool in config.POOL_MARKERS.items():
        if name != names[-1]:
            assert seen[name] <= set(pool) and len(seen[name]) == len(pool)
    for name, (prefix, low, high) in config.NUMBER_MARKERS.items():
        for value in seen[name]:
            found = re.search(re.escape(prefix) + r"(\d+)$", value)
            assert found and low <= int(found.group(1)) <= high


def test_every_occurrence_draws_anew(values):
    text, = values(["{{Order Number}} {{Order Number}}"], markers.clean_text(X, KEY, "x"))
    first, second = text.split(" ")
    assert first != second


def test_clean_text(values):
    inputs = ["  Call {{Customer Support Phone Number}} , pay {{Currency Symbol}}5  now !  ", "plain"]
    want = ["Call 1-800-555-0199, pay $5 now!", "plain"]
    cleaned = values(inputs, markers.clean_text(X, KEY, "x"))
    assert cleaned == want
    assert values(cleaned, markers.clean_text(X, KEY, "x")) == want


def test_values_that_could_form_a_marker_are_refused():
    with pytest.raises(ValueError):
        markers._check(["Number"], ["Order Number"])
    with pytest.raises(ValueError):
        markers._check(["{{x}}"], ["App"])


def test_no_markers_configured_keeps_the_text(values):
    got = values(["a {{}} tail {{Order Number}} text"], markers.replace_markers(F.col("x"), F.lit("1"), "x"))
    assert got == ["a {{}} tail {{Order Number}} text"]


def test_empty_pool_and_empty_value(values):
    got = values(["a {{P}} b"], markers.replace_markers(F.col("x"), F.lit("1"), "x", pools={"P": []}))
    assert got == [f"a {config.LEFTOVER_TEXT} b"]
    with pytest.raises(ValueError):
        markers.replace_markers(F.col("x"), F.lit("1"), "x", static={"P": ""})
