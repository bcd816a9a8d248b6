import json
from types import SimpleNamespace

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from test_compare import BASE, DELTA, TUNED, table
from turnmill import config, scratch
from turnmill.operators import compare, trainlog
from turnmill.plans.curate import curate
from turnmill.sources import metrics as metric_files
from turnmill.sources import predictions as prediction_files
from turnmill.sources import rows as row_files
from turnmill.sources import trainlog as log_files

RECORDS = [
    {"loss": 2.3305505752563476, "grad_norm": 0.09, "epoch": 0.032, "step": 10},
    {"loss": 1.39, "epoch": 0.064, "step": 20},
    {"loss": 0.6370705604553223, "epoch": 0.992, "step": 310},
    {"eval_loss": 0.645247757434845, "eval_runtime": 1886.5709, "epoch": 1.0, "step": 313},
    {"train_runtime": 29281.3, "total_flos": 5888024421267456.0, "train_loss": 0.79, "epoch": 1.0, "step": 313},
]


def test_predictions_csv(spark, tmp_path):
    rows = [
        (' lead, "quoted"\nline\r\n', "ref\n\nx ", "b\\", "", None, "None"),
        ("p", "NA", "null", "nan", "intent", "é😀"),
    ]
    df = spark.createDataFrame(rows, config.PREDICTION_SCHEMA)
    path = str(tmp_path / "predictions")
    prediction_files.write_predictions(df, path)
    got = sorted(map(tuple, prediction_files.read_predictions(spark, path).collect()), key=str)
    want = [tuple(v or None for v in row) for row in rows]
    assert got == sorted(want, key=str)


def test_missing_inputs(spark, tmp_path):
    gone = str(tmp_path / "gone")
    predictions = prediction_files.read_predictions(spark, gone)
    assert predictions.count() == 0 and predictions.schema == config.PREDICTION_SCHEMA
    assert log_files.read_log(spark, gone).count() == 0
    with pytest.raises(AnalysisException):
        metric_files.read_document(spark, gone)


def test_document(spark, tmp_path):
    samples = spark.range(1).select(F.lit(50).cast("long").alias("eval_samples"))
    path = str(tmp_path / "metrics")
    metric_files.write_document(compare.document(table(spark, BASE, TUNED), samples), path)
    text = "".join(p.read_text() for p in (tmp_path / "metrics").glob("part-*"))
    stored = json.loads(text)
    assert stored["eval_samples"] == 50
    for part, values in (("base_model", BASE), ("fine_tuned", TUNED), ("improvement", DELTA)):
        # Generation time is no improvement: the key is not in that part.
        assert stored[part] == {k: "N/A" if v is None else v for k, v in values.items()
                                if part != "improvement" or k != "avg_generation_time_sec"}
    back = metric_files.document_metrics(metric_files.read_document(spark, path))
    assert {(r["model"], r["metric"]): r["value"] for r in back.collect()} == {
        (m, k): v for m, vs in (("baseline", BASE), ("fine_tuned", TUNED)) for k, v in vs.items()}


def test_log_and_state(spark, tmp_path):
    log_path, state_path = tmp_path / "log.json", tmp_path / "state.json"
    log_path.write_text(json.dumps(RECORDS, indent=2))
    state_path.write_text(json.dumps({"epoch": 1.0, "log_history": RECORDS[:-1]}, indent=2))
    log = log_files.read_log(spark, str(log_path))
    kinds = [r["kind"] for r in trainlog.with_kind(log).orderBy("step", "train_loss").collect()]
    assert sorted(kinds) == ["eval", "summary", "train", "train", "train"]
    stats = trainlog.statistics(log).first()
    assert tuple(stats) == (2.3305505752563476, 0.6370705604553223, 0.645247757434845, 313)
    state = log_files.read_state(spark, str(state_path))
    assert sorted(map(str, state.collect())) == sorted(map(str, log.where("train_loss is null").collect()))
    curve = [tuple(r) for r in trainlog.loss_curve(log).collect()]
    assert trainlog.loss_curve(log.where("loss is null")).count() == 0
    assert [(s, n) for s, n, _ in curve] == [("train", 10), ("train", 20), ("train", 310), ("validation", 313)]


def test_splits_are_pruned(spark, tmp_path):
    df = spark.createDataFrame([("1", "train"), ("2", "test")], "row_id string, split string")
    path = str(tmp_path / "splits")
    row_files.write_splits(df, path)
    one = row_files.read_splits(spark, path, "test")
    assert [r["row_id"] for r in one.collect()] == ["2"]
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan


def test_read_rows(spark, tmp_path):
    path = str(tmp_path / "raw.json")
    (tmp_path / "raw.json").write_text('{"row_id": "1", "instruction": "i", "response": "r", "extra": 1}\n')
    row = row_files.read_rows(spark, path, "json").first()
    assert row.asDict() == {"row_id": "1", "instruction": "i", "response": "r", "intent": None, "category": None}



def session(setting, master):
    conf = SimpleNamespace(get=lambda key, default: setting if key == "spark.checkpoint.dir" else default)
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master, applicationId="app"))


def test_scratch_folder_is_the_named_one():
    path = scratch.scratch_path(session("hdfs://shared/", "yarn"), "numbers")
    assert path.startswith("hdfs://shared/turnmill-") and path.endswith("/numbers")
    with pytest.raises(ValueError):
        scratch.shared_dir(session(None, "yarn"))
    assert scratch.shared_dir(session(None, "local[4]")) == scratch.shared_dir(session(None, "local[4]"))


def test_stage(spark):
    df = scratch.stage(spark.range(3), "numbers")
    assert sorted(r["id"] for r in df.collect()) == [0, 1, 2]
    assert "Range" not in df._jdf.queryExecution().executedPlan().toString()


def test_csv_columns_are_found_by_name(spark, tmp_path):
    (tmp_path / "raw.csv").write_text('category,response,instruction\nc,"use a ""card""\nplease",how do I pay\n')
    row = row_files.read_rows(spark, str(tmp_path / "raw.csv"), "csv").first().asDict()
    key = row.pop("row_id")
    assert row == {"instruction": "how do I pay", "response": 'use a "card"\nplease', "intent": None, "category": "c"}
    assert len(key) == 64


def test_rows_without_a_key_go_through_the_curation(spark, tmp_path):
    rows = [(f"how do I pay number {i}", "with {{Order Number}} and a card", "i", "c") for i in range(30)]
    path = str(tmp_path / "raw")
    spark.createDataFrame(rows, "instruction string, response string, intent string, category string").write.parquet(path)
    raw = row_files.read_rows(spark, path)
    assert raw.select("row_id").distinct().count() == 30
    curate(raw, str(tmp_path / "chat"), str(tmp_path / "splits"))
    assert row_files.read_splits(spark, str(tmp_path / "splits")).count() == 30


def test_bad_rows_are_refused(spark, tmp_path):
    spark.createDataFrame([(None, "i", "r")], "row_id string, instruction string, response string"
                          ).write.parquet(str(tmp_path / "null_key"))
    with pytest.raises(Exception, match="row_id is null"):
        row_files.read_rows(spark, str(tmp_path / "null_key")).collect()
    (tmp_path / "raw.csv").write_text("prompt,response\na,b\n")
    with pytest.raises(ValueError, match="instruction"):
        row_files.read_rows(spark, str(tmp_path / "raw.csv"), "csv")


def test_predictions_keep_key_and_order(spark, tmp_path):
    schema = "row_id string, split_order string, prompt string, reference string, baseline string, fine_tuned string," \
             " intent string, category string"
    rows = [(str(i), f"{i % 3}", f"p{i}", "r", "b", "t", "i", "c") for i in range(20)]
    path = str(tmp_path / "predictions")
    prediction_files.write_predictions(spark.createDataFrame(rows, schema), path)
    back = prediction_files.read_predictions(spark, path)
    assert sorted(map(tuple, back.collect())) == sorted(rows)
    shown = [r.prompt for r in compare.examples(back).orderBy("example").collect()]
    assert shown == [r[2] for r in sorted(rows, key=lambda r: (r[1], r[0]))[:8]]
    shuffled = [c for c in reversed(schema.replace(" string", "").replace(" ", "").split(","))]
    other = str(tmp_path / "shuffled")
    prediction_files.write_predictions(spark.createDataFrame(rows, schema), other, shuffled)
    assert sorted(map(tuple, prediction_files.read_predictions(spark, other).select(back.columns).collect())) == sorted(rows)


def test_examples_of_a_file_without_a_key(spark):
    df = spark.createDataFrame([(f"p{i}", "r", "b", "t", "i", "c") for i in range(20)], config.PREDICTION_SCHEMA)
    assert compare.examples(df).count() == 8
    assert compare.examples(df.limit(3)).count() == 3


def test_a_record_with_both_losses_is_a_point_of_both_curves(spark):
    from turnmill.operators import trainlog
    log = spark.createDataFrame(
        [(10, 1.5, None), (20, 1.2, 1.4), (30, None, 1.3), (40, None, None)], "step long, loss double, eval_loss double")
    got = [tuple(r) for r in trainlog.loss_curve(log).collect()]
    assert got == [("train", 10, 1.5), ("train", 20, 1.2), ("validation", 20, 1.4), ("validation", 30, 1.3)]
    only_eval = spark.createDataFrame([(10, None, 1.0)], "step long, loss double, eval_loss double")
    assert trainlog.loss_curve(only_eval).count() == 0
