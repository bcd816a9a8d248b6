"""Semantic score by greedy token alignment against a plain NumPy version."""

import hashlib
import math

import numpy as np
import pytest

from turnmill.operators import semantic


def plain(rows, vectors, corpus=None):
    buckets = max(v for v, _ in vectors) + 1
    table = {}
    for vec_id, e in vectors:
        if e is None or not e or any(x is None or not math.isfinite(x) for x in e) or not any(e):
            continue
        u = np.array(e, float) / np.linalg.norm(np.array(e, float))
        table[vec_id] = u if vec_id not in table else min(table[vec_id], u, key=list)

    def toks(t):
        return [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", (t or "").lower()) if w]

    def vec(t):
        return table.get(int(hashlib.md5(t.encode()).hexdigest()[:8], 16) % buckets)

    idf = None
    if corpus is not None:
        m = len(corpus)
        df = {}
        for text in corpus:
            for t in set(toks(text)):
                df[t] = df.get(t, 0) + 1
        idf = lambda t: math.log((m + 1) / (df.get(t, 0) + 1))
    out = []
    for key, answer, reference in rows:
        a, r = toks(answer), toks(reference)
        if not a or not r:
            out.append((key, 0.0, 0.0, 0.0))
            continue

        def sim(x, y):
            vx, vy = vec(x), vec(y)
            return 0.0 if vx is None or vy is None else float(vx @ vy)

        w = (lambda t: 1.0) if idf is None else idf
        sa, sr = sum(w(t) for t in a), sum(w(t) for t in r)
        p = sum(w(t) * max(sim(t, y) for y in r) for t in a) / sa if sa else 0.0
        rc = sum(w(t) * max(sim(t, x) for x in a) for t in r) / sr if sr else 0.0
        f = 2 * p * rc / (p + rc) if p + rc else 0.0
        out.append((key, round(p, 6), round(rc, 6), round(f, 6)))
    return sorted(out, key=str)


VECTORS = [(0, [1.0, 0.0, 0.0]), (1, [0.0, 2.0, 0.0]), (2, [1.0, 1.0, 0.0]), (3, None), (4, [0.0, 0.0, 0.0]),
           (5, [float("nan"), 1.0, 0.0]), (6, [0.5, -1.0, 2.0]), (6, [0.4, 1.0, 2.0]), (8, [-1.0, 0.2, 0.1])]
ROWS = [("a", "The cat sat", "the cat sat"), ("b", None, "x y"), ("c", "   ", None), ("d", "one two three four", "five six"),
        ("e", "same same same", "same"), ("e", "same same same", "same"), ("f", "Ünïcode wörds ß", "ünïcode WÖRDS")]


@pytest.mark.parametrize("with_idf", [False, True])
def test_alignment_equals_plain_version(spark, with_idf):
    answers = spark.createDataFrame(ROWS, "row_id string, answer string, reference string")
    vectors = spark.createDataFrame(VECTORS, "vec_id long, embedding array<float>")
    corpus = answers.select("reference") if with_idf else None
    got = semantic.greedy_alignment(answers, vectors, corpus, keys=("row_id",))
    want = plain(ROWS, [(v, None if e is None else [float(np.float32(x)) for x in e]) for v, e in VECTORS],
                 [r for _, _, r in ROWS] if with_idf else None)
    assert sorted(map(tuple, got.collect()), key=str) == want


def test_empty_answers(spark):
    answers = spark.createDataFrame([], "row_id string, answer string, reference string")
    vectors = spark.createDataFrame(VECTORS, "vec_id long, embedding array<float>")
    assert semantic.greedy_alignment(answers, vectors, keys=("row_id",)).count() == 0


@pytest.mark.parametrize("listed, numbers", [(0, 0), (4, 6), (100, 3), (2, 100)])
def test_rare_tokens_and_lacking_vectors_are_joined(spark, listed, numbers):
    """What tasks do not hold reaches the rows by joins, with the same scores."""
    answers = spark.createDataFrame(ROWS, "row_id string, answer string, reference string")
    vectors = spark.createDataFrame(VECTORS, "vec_id long, embedding array<float>")
    got = semantic.greedy_alignment(answers, vectors, answers.select("reference"), ("row_id",), listed, numbers)
    want = plain(ROWS, [(v, None if e is None else [float(np.float32(x)) for x in e]) for v, e in VECTORS],
                 [r for _, _, r in ROWS])
    assert sorted(map(tuple, got.collect()), key=str) == want


def test_vectors_of_frequent_tokens_are_not_shuffled(spark):
    """Rows are scored where they stand: the last step has no exchange, however many rows there are."""
    answers = spark.createDataFrame(ROWS * 50, "row_id string, answer string, reference string")
    vectors = spark.createDataFrame(VECTORS, "vec_id long, embedding array<float>")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = semantic.greedy_alignment(answers, vectors, answers.select("reference"), keys=("row_id",))
        assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert got.count() == 50 * len(ROWS)


def test_vectors_of_different_lengths_are_alike_to_nothing(spark):
    answers = spark.createDataFrame([("a", "x y z", "x y z")], "row_id string, answer string, reference string")
    vectors = spark.createDataFrame([(i, [1.0] * (1 + i % 2)) for i in range(50)], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in semantic.greedy_alignment(answers, vectors, keys=("row_id",)).collect()] == [("a", 1.0, 1.0, 1.0)]
