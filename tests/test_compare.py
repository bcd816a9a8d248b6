import pytest

from turnmill import config
from turnmill.operators import compare

# Two models' values as one stored run had them, and its deltas.
BASE = {"rouge1": 0.3485, "rouge2": 0.1035, "rougeL": 0.2152, "rougeLsum": 0.2234, "bleu": 0.0536,
        "bertscore_f1": None, "exact_match": 0.0, "approx_perplexity": 4.8,
        "avg_pred_length_words": 58.2, "avg_ref_length_words": 84.5, "avg_generation_time_sec": 7.506}
TUNED = {"rouge1": 0.5034, "rouge2": 0.2358, "rougeL": 0.3417, "rougeLsum": 0.3506, "bleu": 0.1984,
         "bertscore_f1": None, "exact_match": 0.0, "approx_perplexity": 2.97,
         "avg_pred_length_words": 77.2, "avg_ref_length_words": 84.5, "avg_generation_time_sec": 11.971}
DELTA = {"rouge1": 0.1549, "rouge2": 0.1323, "rougeL": 0.1265, "rougeLsum": 0.1272, "bleu": 0.1448,
         "bertscore_f1": None, "exact_match": 0.0, "approx_perplexity": -1.83,
         "avg_pred_length_words": 19.0, "avg_ref_length_words": 0.0, "avg_generation_time_sec": None}


def table(spark, base, tuned):
    rows = [(m, k, v) for m, vs in (("baseline", base), ("fine_tuned", tuned)) for k, v in vs.items()]
    return spark.createDataFrame(rows, config.METRIC_SCHEMA)


@pytest.fixture
def metrics(spark):
    return table(spark, BASE, TUNED)


def test_improvement(metrics):
    got = {r["metric"]: r["delta"] for r in compare.improvement(metrics).collect()}
    assert got == DELTA


def test_metric_of_one_model_only(spark):
    got = compare.improvement(table(spark, {"bleu": 0.1}, {})).first()
    assert tuple(got) == ("bleu", 0.1, None, None)


def test_summary(metrics):
    rows = {r["label"]: tuple(r)[2:] for r in compare.summary(metrics).orderBy("position").collect()}
    assert list(rows) == list(config.SUMMARY_LABELS.values())
    assert rows["ROUGE-1"] == ("0.3485", "0.5034", "+0.1549")
    assert rows["BERTScore F1"] == ("N/A", "N/A", "N/A")
    assert rows["Exact Match"] == ("0.0", "0.0", "+0.0")
    assert rows["Approx Perplexity (low=better)"] == ("4.8", "2.97", "-1.83")
    assert rows["Avg Generation Time (sec)"] == ("7.506", "11.971", "N/A")


def test_executive(metrics):
    rows = {r["label"]: tuple(r)[2:] for r in compare.executive(metrics).collect()}
    assert rows["ROUGE-1"] == ("0.3485", "0.5034", "up", "+0.1549")
    assert rows["Exact Match"] == ("0.0000", "0.0000", "flat", "0.0000")
    assert rows["Approx Perplexity"] == ("4.80", "2.97", "down", "-1.8300")
    assert rows["BERTScore F1"] == ("N/A", "N/A", None, "N/A")
    assert rows["Avg Response Length (words)"] == ("58.2", "77.2", None, "—")


@pytest.mark.parametrize("rouge1, bleu, want", [
    (0.3, 0.2, "success"), (0.12, 0.2, "marginal"), (0.3, 0.1, "marginal"),
    (0.1, 0.2, "none"), (0.05, 0.2, "none"), (None, 0.2, "none"), (0.3, None, "marginal"),
])
def test_verdict(spark, rouge1, bleu, want):
    # From 0.1 each: a gain of exactly 0.02 is not a success yet, and missing counts as 0.
    metrics = table(spark, {"rouge1": 0.1, "bleu": 0.1}, {"rouge1": rouge1, "bleu": bleu})
    assert compare.verdict(metrics).first()["verdict"] == want


def test_series(metrics):
    got = {(r["metric"], r["model"]): r["value"] for r in compare.series(metrics).collect()}
    assert got == {(k, m): v[k] for k in config.COMPARISON_KEYS
                   for m, v in (("baseline", BASE), ("fine_tuned", TUNED))}
    heat = {r["metric"]: (r["delta"], r["scale"]) for r in compare.improvement_series(metrics).collect()}
    assert heat == {k: (DELTA[k] or 0.0, 0.1549) for k in config.IMPROVEMENT_KEYS}


def test_scale_has_a_floor(spark):
    metrics = table(spark, {"bleu": 0.1}, {"bleu": 0.1})
    assert {r["scale"] for r in compare.improvement_series(metrics).collect()} == {0.01}


def test_guide(metrics):
    rows = {r["label"]: (r["base_meets"], r["tuned_meets"]) for r in compare.guide(metrics).collect()}
    assert rows == {
        "ROUGE-1": (True, True), "ROUGE-2": (True, True), "ROUGE-L": (False, True), "BLEU": (True, True),
        "BERTScore F1": (None, None), "Exact Match": (False, False), "Perplexity": (True, True)}


def test_examples(spark):
    rows = [(f"{i:02d}", "p", "r" * 301, "b" * 300, "f", None) for i in range(10)]
    df = spark.createDataFrame(
        rows, "row_id string, prompt string, reference string, baseline string, fine_tuned string, intent string")
    got = compare.examples(df).orderBy("example").collect()
    assert [(r["example"], r["row_id"]) for r in got] == [(i + 1, f"{i:02d}") for i in range(8)]
    assert got[0]["reference"] == "r" * 300 + "..." and got[0]["baseline"] == "b" * 300
    assert got[0]["intent"] == got[0]["category"] == "—"
