"""What the physical plans must and must not hold."""

import re

import pytest

from turnmill.plans import evaluate as evaluation
from turnmill.operators import sampling, scoring
from workload import fixtures as fx
from workload.queries import REGISTRY

SF = "/root/testdata/sf0.001"
KERNEL_QUERIES = {
    "a9_rouge1", "a10_rouge2", "a11_rougeL", "a12_rougeLsum", "a13_bleu", "row_scores", "a16_per_intent",
    "r1_metric_set", "r2_improvement", "r3_result", "r4_summary", "r5_verdict", "r6_executive", "r7_bars",
    "io6_report_from_csv", "plan_evaluate", "r8_rouge_series", "r9_heat_scale", "r12_thresholds", "f7_intent_guard", "f8_min_group",
    # ROUGE kernels under resampling, and one matrix product per answer for the semantic score.
    "a9_rouge_intervals", "a14_semantic_rows", "a14_semantic_score",
}


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(REGISTRY) - KERNEL_QUERIES))
def test_everything_but_overlap_scores_stays_in_the_jvm(spark, name):
    plan = physical(REGISTRY[name](spark, SF))
    assert "Python" not in plan and "CartesianProduct" not in plan and "BroadcastNestedLoop" not in plan


@pytest.mark.parametrize("name", ["a9_rouge_intervals", "a14_semantic_rows"])
def test_new_python_queries_pair_nothing(spark, name):
    plan = physical(REGISTRY[name](spark, SF))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoop" not in plan


def test_dedup_limits_groups_before_the_exchange(spark):
    plan = physical(sampling.dedup(fx.dirty_pairs(spark, SF)))
    before, after = plan.index("Partial"), plan.index("Final")
    assert after < plan.index("Exchange hashpartitioning(_key") < before
    assert "SinglePartition" not in plan


def test_split_assignment_moves_no_row(spark):
    rows = spark.read.parquet(f"{SF}/events.parquet")
    plan = physical(sampling.training_subset(sampling.split_exact(rows, row_id="event_id"), row_id="event_id"))
    assert "Exchange" not in plan and "Window" not in plan


def test_scores_are_one_aggregate_over_a_map(spark):
    plan = physical(scoring.metric_set(spark.createDataFrame(
        [("1", "r", "b", "f")], "row_id string, reference string, baseline string, fine_tuned string")))
    # One deal of the rows by text bytes before Python, then one aggregate.
    assert plan.count("Exchange") == 2 and plan.count("RoundRobinPartitioning") == 1
    assert plan.count("ArrowEvalPython") == 1


def test_scan_reads_only_what_is_used(spark):
    plan = physical(fx.pairs(spark, SF).select("row_id"))
    assert "PushedFilters: [IsNotNull(role), EqualTo(role,user)" in plan
    assert not re.search(r"ReadSchema: struct<[^>]*text", plan)


def test_evaluation_and_report(spark):
    predictions = fx.predictions(spark, SF)
    out = evaluation.evaluate(predictions)
    n = predictions.count()
    assert out["row_scores"].count() == 2 * n
    assert out["document"].first()["eval_samples"] == n
    report = evaluation.report(predictions, out["metrics"], fx.train_log(spark, SF))
    assert {name: df.count() for name, df in report.items()} == {
        "verdict": 1, "executive": 9, "comparison": 10, "rouge_breakdown": 8, "improvement": 6,
        "lengths": 102, "length_means": 3, "loss_curve": 1000, "training": 1, "examples": 8, "guide": 7}


def test_one_lookup_finds_subset_and_splits(spark, monkeypatch):
    looked_up = []
    original = sampling._locate
    monkeypatch.setattr(sampling, "_locate", lambda *a: looked_up.append(1) or original(*a))
    REGISTRY["s7_train_subset"](spark, SF)
    assert len(looked_up) == 1


@pytest.mark.parametrize("name", ["s4_split_exact", "s6_eval_sample", "s7_train_subset", "s8_first_example"])
def test_splits_neither_deal_out_nor_range_sort(spark, name):
    plan = physical(REGISTRY[name](spark, SF))
    assert "RoundRobinPartitioning" not in plan and "rangepartitioning" not in plan


def test_reference_is_prepared_once(spark):
    plan = REGISTRY["r1_metric_set"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
