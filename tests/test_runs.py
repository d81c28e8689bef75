from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from tabloom.operators.features import FeatureConfig
from tabloom.operators.split import split_report
from tabloom.plans import learn, prepare
from tabloom.sources import documents, runs, tables
from tabloom.streaming.score import score_stream


def manifest(spark, root, name, payload):
    documents.write_document(spark, f"{root}/{name}/manifest.json", payload)


def test_newer_manifest_wins(spark, tmp_path):
    root = str(tmp_path)
    manifest(spark, root, "a", {"created_utc": "2025-01-02T00:00:00+00:00"})
    manifest(spark, root, "b", {"created_utc": "2025-01-01T00:00:00+00:00"})
    assert runs.latest_prepared(spark, root).endswith("/a")
    assert runs.latest_prepared_by_name(spark, root).endswith("/b")


def test_manifest_without_time_uses_the_file_and_ties_take_the_first(spark, tmp_path):
    root = str(tmp_path)
    manifest(spark, root, "a", {"created_utc": "2025-01-02T00:00:00+00:00"})
    manifest(spark, root, "b", {"created_utc": "2025-01-02T01:00:00+01:00"})
    assert runs.latest_prepared(spark, root).endswith("/a")
    manifest(spark, root, "c", {"rows": 1})
    os.makedirs(f"{root}/d")
    with open(f"{root}/d/manifest.json", "w") as f:
        f.write("{broken")
    os.utime(f"{root}/d/manifest.json", (0, 0))
    assert runs.latest_prepared(spark, root).endswith("/c")


def test_nothing_found_is_an_error(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        runs.latest_prepared(spark, str(tmp_path))
    with pytest.raises(FileNotFoundError):
        runs.latest_model(spark, str(tmp_path), "x")
    with pytest.raises(FileNotFoundError):
        runs.complete_runs(spark, str(tmp_path), "x")
    with pytest.raises(FileNotFoundError):
        documents.read_document(spark, str(tmp_path / "absent.json"))
    with pytest.raises(FileNotFoundError):
        tables.read_prepared(spark, str(tmp_path))


def test_config_documents(spark, tmp_path):
    path = str(tmp_path / "config.json")
    documents.write_document(spark, path, {"target_col": "y", "drop_cols": ["a"], "transform": {"port_cols": ["p"]}})
    assert documents.read_config(spark, path) == FeatureConfig("y", "row_id", ("a",), (), ("p",))
    for bad in ({"row_id_col": "r"}, {"target_col": "y", "transform": []}):
        documents.write_document(spark, path, bad)
        with pytest.raises(ValueError):
            documents.read_config(spark, path)
    assert runs.update_manifest(spark, path, {"time_split": {"rows": 3}})["time_split"] == {"rows": 3}
    assert documents.read_document(spark, path)["target_col"] == "y"


def test_snapshot_is_immutable_unless_forced(spark, tmp_path):
    df = spark.createDataFrame([(1,)], "a int")
    kwargs = dict(dataset="owner/name x", date="2025-12-29", source="here")
    folder = tables.snapshot(df, str(tmp_path), **kwargs)
    assert folder.endswith("owner_name_x/snapshot_date=2025-12-29")
    assert documents.read_document(spark, f"{folder}/provenance.json")["dataset"] == "owner/name x"
    with pytest.raises(RuntimeError, match="holds a snapshot"):
        tables.snapshot(df, str(tmp_path), **kwargs)
    tables.snapshot(df.union(df), str(tmp_path), force=True, **kwargs)
    assert spark.read.parquet(f"{folder}/data").count() == 2


def test_csv_keeps_values(spark, tmp_path):
    df = spark.createDataFrame([(' a "q" , x\n', "2024-01-01 00:00:00.123456", None)], "s string, t string, n int").withColumn("t", F.col("t").cast("timestamp"))
    path = tables.write_table(df, str(tmp_path / "t.csv"))
    assert tables.read_raw_csv(spark, path, schema=df.schema, multi_line=True).collect() == df.collect()


def test_blank_prediction_rows_are_dropped(spark):
    df = spark.createDataFrame([("a", "1.0", "2"), ("b", None, "1"), ("c", "2.6", "")], "row_id string, y_true string, y_pred string")
    assert [tuple(r) for r in tables.clean_predictions(df).collect()] == [("a", 1, 2)]


def raw_events(spark, n=400):
    rows = spark.range(n).select(
        F.expr("timestamp'2024-01-01' + make_interval(0, 0, 0, 0, 0, cast(id AS int) * 7)").alias("Timestamp"),
        (F.col("id") * 137 % 70000).alias("Source Port"),
        (F.col("id") * 7 % 90).cast("double").alias("Packet Length"),
        F.when(F.col("id") % 5 == 0, None).otherwise(F.concat(F.lit(" p"), F.col("id") % 3)).alias("Protocol"),
        F.when(F.col("id") * 7 % 90 > 60, "DDoS").when(F.col("id") * 7 % 90 > 25, "Intrusion").otherwise("Malware").alias("Attack Type"),
    )
    return rows


def test_prepare_train_infer_and_compare(spark, tmp_path):
    root = str(tmp_path)
    raw = tables.write_table(raw_events(spark), f"{root}/raw.csv")
    made = prepare.prepare_dataset(spark, raw, f"{root}/prepared/v1", config_path=f"{root}/config.json")
    cleaned = tables.read_prepared(spark, made.folder)
    assert cleaned.count() == 400 and cleaned.columns[0] == "row_id" and cleaned.agg(F.max("row_id")).first()[0] == "row_000399"
    first = cleaned.orderBy("row_id").first()
    assert first["Source Port"] == 0.0 and first["Protocol"] is None
    split = tables.read_table(spark, made.split)
    assert {r["split"]: r["rows"] for r in split_report(split).collect()} == {"train": 280, "val": 60, "test": 60}
    assert documents.read_config(spark, f"{root}/config.json").timestamp_cols == ("Timestamp",)
    path = prepare.create_time_split(spark, made.folder)
    assert path.endswith("split_time_70_15_15.csv")
    report = documents.read_document(spark, made.manifest)["time_split"]["report"]
    assert report == {"rows": 400, "train_rows": 280, "val_rows": 60, "test_rows": 60, "train_target": 280, "val_target": 340}

    for slug, params in (("random_forest", {"trees": 5, "max_depth": 6}), ("xgboost", {"rounds": 20, "max_depth": 2, "rate": 0.3})):
        saved = learn.train_classifier(spark, prepared_root=f"{root}/prepared", runs_root=f"{root}/runs", slug=slug, prefix="attack_type", **params)
        assert set(saved) == {"model", "metrics", "test_predictions", "manifest"}
        metrics = documents.read_document(spark, saved["metrics"])
        assert metrics["test"]["accuracy"] > 0.5 and metrics["test"]["classification_report"]["macro avg"]["support"] == 60.0
    done = learn.infer(spark, prepared_root=f"{root}/prepared", runs_root=f"{root}/runs", output_root=f"{root}/inference", slug="random_forest", prefix="attack_type", limit=7)
    rows = tables.read_table(spark, done["predictions"]).collect()
    assert len(rows) == 7 and {"row_id", "y_pred", "y_pred_label", "pred_proba_max", "y_true_label"} == set(rows[0].asDict())
    board = learn.saved_run_leaderboard(spark, f"{root}/runs", "attack_type").collect()
    assert sorted(r["model"] for r in board) == ["random_forest", "xgboost"]
    assert board[0]["test_macro_f1"] >= board[1]["test_macro_f1"]

    # A saved file without test metrics: they come from the predictions.
    latest = runs.latest_model(spark, f"{root}/runs", "attack_type_random_forest")
    run_dir = latest.rsplit("/", 1)[0]
    before = {r["model"]: r["test_accuracy"] for r in board}
    documents.write_document(spark, f"{run_dir}/attack_type_random_forest_metrics.json", {"val": {}})
    again = {r["model"]: r for r in learn.saved_run_leaderboard(spark, f"{root}/runs", "attack_type").collect()}
    assert again["random_forest"]["test_accuracy"] == pytest.approx(before["random_forest"]) and again["random_forest"]["val_accuracy"] is None

    # The saved model scores a stream with the same code.
    config = documents.read_config(spark, made.config)
    model = runs.load_model(spark, latest)
    events = spark.readStream.schema(cleaned.schema).parquet(made.cleaned)
    query = score_stream(model, events, config, ["DDoS", "Intrusion", "Malware"], output=f"{root}/scored", checkpoint=f"{root}/cp")
    query.awaitTermination(120)
    assert spark.read.parquet(f"{root}/scored").count() == 400


def test_broken_model_names_the_versions(spark, tmp_path):
    path = str(tmp_path / "m_model")
    spark.createDataFrame([('{"class": "no.such.Class", "sparkVersion": "1.0"}',)], "value string").coalesce(1).write.text(f"{path}/metadata")
    with pytest.raises(RuntimeError, match="saved by Spark 1.0"):
        runs.load_model(spark, path)
    with pytest.raises(FileNotFoundError):
        runs.load_model(spark, str(tmp_path / "none"))


def test_csv_fallback_has_types(spark, tmp_path):
    rows = [("row_1", "1", "1.5", "true", "2024-01-01", None, "a\nb"), ("row_2", None, "2", "false", "x", None, "7")]
    df = spark.createDataFrame(rows, "row_id string, i string, d string, b string, t string, n string, s string")
    tables.write_table(df, f"{tmp_path}/cleaned.csv")
    found = tables.read_prepared(spark, str(tmp_path))
    assert dict(found.dtypes) == {"row_id": "string", "i": "bigint", "d": "double", "b": "boolean", "t": "string", "n": "string", "s": "string"}
    assert sorted(map(tuple, found.collect())) == [("row_1", 1, 1.5, True, "2024-01-01", None, "a\nb"), ("row_2", None, 2.0, False, "x", None, "7")]


def test_manifest_blocks(spark, tmp_path):
    path = f"{tmp_path}/manifest.json"
    assert runs.update_manifest(spark, path, {"time_split": {}}) is None and not documents.path_exists(spark, path)
    documents.write_document(spark, path, {"rows": 1, "artifacts": {"split": "s"}})
    runs.update_manifest(spark, path, {"artifacts": {"split_time": "t"}, "time_split": {"strategy": "x"}})
    assert documents.read_document(spark, path) == {"rows": 1, "artifacts": {"split": "s", "split_time": "t"}, "time_split": {"strategy": "x"}}
