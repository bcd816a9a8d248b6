import hashlib
import math
import random

import pytest
from pyspark.sql import functions as F

from turnmill import config
from turnmill.operators import cleaning, health, sampling
from turnmill.plans import curate as plan

RAW = "row_id string, instruction string, response string, intent string, category string"


def md5(text):
    return hashlib.md5(text.encode()).hexdigest()


def raw_rows(n=400, seed=5):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        instruction = rng.choice([
            None, "  ", "Hi", f"  Question {rng.randrange(60)} ", f"QUESTION {rng.randrange(60)}",
            f"Where is {{{{Order Number}}}} {rng.randrange(5)}",
        ])
        response = rng.choice([None, "", "Answer.", "x" * 900, "Call {{App}} , or {{Odd}} {{}}"])
        rows.append((f"r{i}", instruction, response, "i", "c"))
    return rows


def test_system_prompt_length():
    assert len(config.SYSTEM_PROMPT) == 131


def test_quality_limits(spark):
    rows = [
        ("a", "😀abc", "ok", None, None), ("b", "😀abcd", "ok", None, None),
        ("c", "hello", "y" * (950 - 131 - 5), None, None),
        ("d", "hello", "y" * (950 - 131 - 4), None, None),
        ("e", "hello", " ", None, None), ("f", None, "x", None, None),
        ("g", "   ab   ", "x", None, None),
    ]
    df = spark.createDataFrame(rows, RAW)
    got = dict(df.select("row_id", cleaning.reject_reason()).collect())
    assert got == {"a": "too_short", "b": None, "c": None, "d": "too_long",
                   "e": "empty", "f": "empty", "g": "too_short"}
    assert {r[0] for r in cleaning.keep_quality(df).collect()} == {"b", "c"}


def test_dedup_keeps_the_first_in_shuffled_order(spark):
    rows = [(f"r{i}", f" Key {i % 7} " if i % 2 else f"kEY {i % 7}", str(i), "", "") for i in range(200)]
    want = {}
    for r in sorted(rows, key=lambda r: (md5(f"42|{r[0]}"), r[0])):
        want.setdefault(r[1].strip().lower(), r[0])
    for parts in (1, 8):
        df = spark.createDataFrame(rows[::-1], RAW).repartition(parts)
        assert sorted(r["row_id"] for r in sampling.dedup(df).collect()) == sorted(want.values())


def test_survivor_that_fails_takes_its_key_along(spark):
    pair = [("p", "same question", "y" * 900, "", ""), ("q", "Same Question", "short answer", "", "")]
    first = min(pair, key=lambda r: md5(f"42|{r[0]}"))[0]
    rows = pair if first == "p" else [(b[0], *a[1:]) for a, b in zip(pair, pair[::-1])]
    # The row that comes first in shuffled order is the one that is too long.
    assert plan.curated(spark.createDataFrame(rows, RAW)).count() == 0


@pytest.mark.parametrize("small", [20_000, 1])
@pytest.mark.parametrize("n", [0, 1, 2, 7, 500])
def test_exact_split(spark, monkeypatch, small, n):
    monkeypatch.setattr(sampling, "_SMALL", small)
    monkeypatch.setattr(sampling, "_DIGITS", 1 if small == 1 else 3)
    ids = [f"k{i}" for i in range(n)]
    df = spark.createDataFrame([(i,) for i in ids], "row_id string").repartition(3)
    out = sampling.split_exact(df)
    got = {r["row_id"]: r["split"] for r in out.collect()}
    ranked = sorted(ids, key=lambda i: (md5(f"43|{i}"), i))
    holdout = math.ceil(0.2 * n)
    test = math.ceil(0.5 * holdout)
    want = {i: "test" if k < test else "validation" if k < holdout else "train" for k, i in enumerate(ranked)}
    assert got == want
    caps = {"train": 30, "validation": 5, "test": 0}
    first = {r["row_id"] for r in sampling.first_of_splits(out, caps).collect()}
    assert first == {i for split, cap in caps.items() for i in [j for j in ranked if want[j] == split][:cap]}


def test_split_with_repeated_ids_places_them_together(spark):
    df = spark.createDataFrame([("same",)] * 50 + [(f"k{i}",) for i in range(50)], "row_id string")
    assert sampling.split_exact(df).where("row_id = 'same'").select("split").distinct().count() == 1


def test_plan_is_the_same_for_any_partitioning(spark):
    rows = raw_rows()
    results = []
    for parts, order in ((1, 1), (8, -1)):
        df = spark.createDataFrame(rows[::order], RAW).repartition(parts)
        results.append(sorted(map(tuple, plan.split_rows(df).collect())))
    assert results[0] == results[1] and results[0]


def test_funnel_equals_the_stages(spark):
    df = spark.createDataFrame(raw_rows(), RAW)
    got = health.funnel(df).first().asDict()
    kept = cleaning.drop_blank(df)
    cleaned = cleaning.clean_rows(kept)
    unique = sampling.dedup(cleaned)
    assert got["loaded"] == df.count()
    assert got["not_blank"] == kept.count()
    assert got["with_markers"] == cleaned.where(cleaning.has_marker(F.col("response"))).count() > 0
    assert got["after_dedup"] == unique.count()
    assert got["after_quality"] == cleaning.keep_quality(unique).count() == plan.curated(df).count()
    empty = health.funnel(df.limit(0)).first()
    assert set(empty) == {0}


def test_health_and_steps(spark):
    rows = [("1", "ab", "x" * 801, "", ""), ("2", "abcd", "{{x", "", ""), ("3", "abc", "y" * 800, "", "")]
    got = health.health(cleaning.to_chat(spark.createDataFrame(rows, RAW))).first().asDict()
    assert got == {
        "rows": 3, "marked_rows": 1, "marked_percent": 33, "user_min": 2, "user_avg": 3, "user_max": 4,
        "assistant_min": 3, "assistant_avg": 1604 // 3, "assistant_max": 801, "over_budget": 1,
    }
    splits = spark.range(9000).select(F.lit("train").alias("split"))
    assert tuple(health.step_counts(splits).first()) == (5000, 16, 313)


def test_optional_columns_and_row_ids(spark):
    df = spark.createDataFrame([("a", "b", None)], "instruction string, response string, intent string")
    full = cleaning.with_row_id(cleaning.with_defaults(df))
    row = full.first()
    assert row["intent"] is None and row["category"] == ""
    again = cleaning.with_row_id(cleaning.with_defaults(df.select("response", "intent", "instruction")))
    assert again.first()["row_id"] == row["row_id"]


def test_small_holdout_shares_leave_no_split_empty(spark):
    rows = spark.range(100000).select(F.col("id").cast("string").alias("row_id"))
    for share in (0.01, 0.004):
        params = config.CurateParams(holdout_share=share)
        n = {r["split"]: r["count"] for r in sampling.split_hashed(rows, params).groupBy("split").count().collect()}
        for split in ("validation", "test"):
            assert abs(n[split] - 100000 * share / 2) < 5 * (100000 * share / 2) ** 0.5
