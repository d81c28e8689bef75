"""Training, inference, the regression bake-off, the saved-run leaderboard and learning curves."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from tabloom.functions.labels import encode_label
from tabloom.operators.clean import col
from tabloom.operators.encode import Encoder, fit_encoder
from tabloom.operators.features import FeatureConfig, feature_table
from tabloom.operators.metrics import classification_metrics, classification_report, regression_metrics
from tabloom.operators.selection import fold_of
from tabloom.operators.slices import leaderboard
from tabloom.operators.split import join_split, only_split
from tabloom.plans.models import JOB_CLASSIFIERS, ModelSpec, REPORT_REGRESSORS, Training, model_spec, predictions_table
from tabloom.session import stash
from tabloom.sources.documents import CLASSES_FILE, read_class_map, read_config, run_stamp, utc_now_iso
from tabloom.sources.runs import complete_runs, latest_model, latest_prepared, latest_run_per_model, load_model, metric_rows, write_inference, write_run
from tabloom.sources.tables import clean_predictions, read_prepared, read_table


def labelled_features(df: DataFrame, config: FeatureConfig, classes: Sequence[str], *, keep: Sequence[str] = ("split",)) -> DataFrame:
    """Feature columns with the row id, the kept columns and the integer label."""
    table = feature_table(df, config, keep=[config.row_id_col, *keep, config.target_col])
    return table.withColumn("label", encode_label(col(config.target_col), classes).cast("double")).drop(config.target_col)


def encode_table(table: DataFrame, *, id_col: str, fit_on: str = "train", scale: bool = False, **options: Any) -> tuple[DataFrame, Encoder]:
    """Fit the encoder on one split and apply it to all: (id, split, label, features)."""
    encoder = fit_encoder(only_split(table, fit_on), skip=[id_col, "split", "label"], scale=scale, **options)
    return encoder.transform(table).select(col(id_col), "split", "label", "features"), encoder


def metrics_document(scored: DataFrame, model: str, params: dict[str, Any]) -> dict[str, Any]:
    """Accuracy, F1 family and per-class report for val and test from one pass over the predictions."""
    both = scored.filter(F.col("split").isin("val", "test")).select("split", F.col("label").cast("int").alias("y_true"), F.col("prediction").cast("int").alias("y_pred"))
    out: dict[str, Any] = {"created_utc": utc_now_iso(), "model": model, "params": params}
    counts = both.persist()
    for r in classification_metrics(counts, "y_true", "y_pred", ["split"]).collect():
        out[r["split"]] = {k: r[k] for k in ("accuracy", "macro_f1", "weighted_f1")} | {"classification_report": {}}
    for r in classification_report(counts, "y_true", "y_pred", ["split"]).collect():
        row = r["precision"] if r["label"] == "accuracy" else {"precision": r["precision"], "recall": r["recall"], "f1-score": r["f1"], "support": float(r["support"])}
        out[r["split"]]["classification_report"][r["label"]] = row
    counts.unpersist()
    return out


def train_classifier(spark: SparkSession, *, prepared_root: str, runs_root: str, slug: str, prefix: str, config_path: str | None = None, **params: Any) -> dict[str, str]:
    """Fit one of the job classifiers on the newest prepared folder and save model, metrics, predictions and manifest."""
    folder = latest_prepared(spark, prepared_root)
    config = read_config(spark, config_path or f"{folder}/baseline_feature_config.json")
    class_map_path = f"{folder}/{CLASSES_FILE}"
    classes = tuple(read_class_map(spark, class_map_path).first()["classes"])
    joined = join_split(read_prepared(spark, folder), read_table(spark, f"{folder}/split.csv"), row_id_col=config.row_id_col, label_col=config.target_col)
    features = stash(labelled_features(joined, config, classes))
    encoded, encoder = encode_table(features, id_col=config.row_id_col)
    train = only_split(encoded, "train").persist()
    spec = model_spec(slug, JOB_CLASSIFIERS)
    model = spec.train(train, Training(classes=classes, id_col=config.row_id_col), **params)
    stamp = run_stamp()
    manifest = {
        "created_utc": utc_now_iso(),
        "run_stamp": stamp,
        "model": slug,
        "prepared_dataset": folder,
        "split": f"{folder}/split.csv",
        "class_map": class_map_path,
        "target_col": config.target_col,
    }
    run, whole = (f"{runs_root}/{stamp}", f"{prefix}_{slug}"), PipelineModel([*encoder.model.stages, model])
    # A saved forest scores with its saved trees, so it is saved first and grown once.
    paths = write_run(spark, *run, model=whole, manifest=manifest)
    scored = model.transform(encoded.filter(F.col("split") != "train")).persist()
    metrics = metrics_document(scored, slug, {**spec.params, **params})
    predictions = only_split(scored, "test").select(col(config.row_id_col), F.col("label").cast("int").alias("y_true"), F.col("prediction").cast("int").alias("y_pred"))
    paths |= write_run(spark, *run, metrics=metrics, predictions=predictions, manifest=manifest)
    scored.unpersist()
    train.unpersist()
    return paths


def score(model: PipelineModel, df: DataFrame, config: FeatureConfig, classes: Sequence[str]) -> DataFrame:
    """Predictions for a table with the config's columns. Stateless, so it also takes a streaming table."""
    truth = [config.target_col] if config.target_col in df.columns else []
    scored = model.transform(feature_table(df, config, keep=[config.row_id_col, *truth]))
    return predictions_table(scored, row_id_col=config.row_id_col, classes=classes, truth_col=config.target_col)


def infer(
    spark: SparkSession, *, prepared_root: str, runs_root: str, output_root: str, slug: str, prefix: str, split: str = "test", model_path: str | None = None, config_path: str | None = None, limit: int | None = None
) -> dict[str, str]:
    """Score one split of the newest prepared folder with the newest (or a given) model and save the predictions."""
    path = model_path or latest_model(spark, runs_root, f"{prefix}_{slug}")
    model = load_model(spark, path)
    folder = latest_prepared(spark, prepared_root)
    config = read_config(spark, config_path or f"{folder}/baseline_feature_config.json")
    classes = list(read_class_map(spark, f"{folder}/{CLASSES_FILE}").first()["classes"])
    joined = join_split(read_prepared(spark, folder), read_table(spark, f"{folder}/split.csv"), row_id_col=config.row_id_col, label_col=config.target_col)
    rows = only_split(joined, split).drop("split")
    if limit is not None:
        rows = rows.orderBy(col(config.row_id_col)).limit(limit)
    predictions = score(model, rows, config, classes)
    stamp = run_stamp()
    manifest = {"created_utc": utc_now_iso(), "run_stamp": stamp, "model_path": path, "prepared_dataset": folder, "split": split, "limit": limit, "target_col": config.target_col}
    return write_inference(spark, f"{output_root}/{stamp}", f"{prefix}_{slug}_{split}", predictions=predictions, manifest=manifest)


def regression_bakeoff(
    encoded: DataFrame, scaled: DataFrame, *, id_col: str, specs: Sequence[ModelSpec] = REPORT_REGRESSORS, overrides: dict[str, dict[str, Any]] | None = None
) -> DataFrame:
    """Leaderboard of regressors fitted on train: (model, val_*, test_*), best test RMSE first.

    encoded and scaled are (id, split, label, features) tables without and with scaling; models that need scaling
    take the second.
    """
    overrides = overrides or {}
    parts: DataFrame | None = None
    for spec in specs:
        table = scaled if spec.needs_scaling else encoded
        model = spec.train(only_split(table, "train"), Training(id_col=id_col), **overrides.get(spec.slug, {}))
        held = model.transform(table.filter(F.col("split") != "train")).select("split", "label", "prediction")
        rows = regression_metrics(held, "label", "prediction", ["split"]).withColumn("model", F.lit(spec.slug))
        parts = rows if parts is None else parts.unionByName(rows)
    wide = parts.groupBy("model").agg(*(F.max(F.when(F.col("split") == s, F.col(m))).alias(f"{s}_{m}") for s in ("val", "test") for m in ("mae", "rmse", "r2")))
    return leaderboard(wide, "test_rmse", largest=False)


def saved_run_leaderboard(spark: SparkSession, runs_root: str, prefix: str) -> DataFrame:
    """Newest complete run per model; test metrics missing from the saved file are computed from its predictions."""
    runs = stash(latest_run_per_model(complete_runs(spark, runs_root, prefix)))
    saved = metric_rows(spark, runs_root, prefix, runs)
    name = rf"/([^/]+)/{prefix}_(.+?)_test_predictions\.csv"
    files = (
        spark.read.schema("row_id string, y_true double, y_pred double")
        .option("header", True)
        .csv(f"{runs_root}/*/{prefix}_*_test_predictions.csv")
        .select(F.regexp_extract("_metadata.file_path", name, 1).alias("run_dir"), F.regexp_extract("_metadata.file_path", name, 2).alias("model"), "y_true", "y_pred")
    )
    # One row per model.
    rows = clean_predictions(files.join(F.broadcast(runs), ["run_dir", "model"], "left_semi"))
    fresh = classification_metrics(rows, "y_true", "y_pred", ["model"]).select("model", *(F.col(m).alias(f"_{m}") for m in ("accuracy", "macro_f1", "weighted_f1")))
    filled = {f"test_{m}": F.coalesce(f"test_{m}", f"_{m}") for m in ("accuracy", "macro_f1", "weighted_f1")}
    board = saved.join(fresh, "model").withColumns(filled).drop(*(f"_{m}" for m in ("accuracy", "macro_f1", "weighted_f1")))
    return leaderboard(board, "test_macro_f1", largest=True)


def learning_curve(
    train: DataFrame, spec: ModelSpec, *, id_col: str, sizes: Sequence[float] = (0.2, 0.4, 0.6, 0.8, 1.0), folds: int = 3, seed: int = 42, **params: Any
) -> DataFrame:
    """(size, train_rows, train_rmse, val_rmse): mean over folds. Smaller train sets are nested in larger ones.

    train has the id, the label and raw features; encoder and scaling are fitted anew on the rows each model sees.
    """
    digest = F.md5(F.concat_ws(":", F.lit(f"curve{seed}"), col(id_col).cast("string")))
    place = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(float(16**8))
    table = stash(train.withColumns({"_fold": fold_of(id_col, folds, seed), "_place": place}))
    parts: DataFrame | None = None
    for size in sizes:
        for f in range(folds):
            inside = (F.col("_fold") != f) & (F.col("_place") < size)
            both = table.filter(inside | (F.col("_fold") == f)).withColumn("split", F.when(F.col("_fold") == f, "val").otherwise("train")).drop("_fold", "_place")
            encoded = stash(encode_table(both, id_col=id_col, scale=spec.needs_scaling)[0])
            model = spec.train(only_split(encoded, "train"), Training(id_col=id_col), **params)
            rows = regression_metrics(model.transform(encoded), "label", "prediction", ["split"]).withColumns({"size": F.lit(float(size)), "fold": F.lit(f)})
            parts = rows if parts is None else parts.unionByName(rows)
    is_train = F.col("split") == "train"
    return parts.groupBy("size").agg(
        F.round(F.avg(F.when(is_train, F.col("rows")))).cast("bigint").alias("train_rows"),
        F.avg(F.when(is_train, F.col("rmse"))).alias("train_rmse"),
        F.avg(F.when(~is_train, F.col("rmse"))).alias("val_rmse"),
    )
