"""Fitted models on the given tables. Linear fits have closed-form SQL twins; the others are checked by row."""

from __future__ import annotations

from functools import partial
from typing import Any

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from tabloom.catalog import Registry, load
from tabloom.catalog.features import CONFIG, ported_events
from tabloom.catalog.splits import EVENT_SPLIT, EVENT_TIME_SPLIT, event_split
from tabloom.functions.labels import json_or
from tabloom.operators import split
from tabloom.operators.dbscan import dbscan
from tabloom.operators.encode import fit_encoder
from tabloom.operators.metrics import cluster_agreement, cluster_summary
from tabloom.operators.selection import select_features
from tabloom.plans import explore
from tabloom.plans.learn import encode_table, labelled_features
from tabloom.plans.models import (
    CLASSIFIERS,
    CLUSTERERS,
    JOB_CLASSIFIERS,
    REGRESSORS,
    REPORT_REGRESSORS,
    ModelSpec,
    Training,
    class_probabilities,
    coefficient_table,
    importance_table,
    model_spec,
    predictions_table,
    top_features,
)
from tabloom.session import stash

registry = Registry()

CLASSES = ("click", "error", "purchase", "signup", "view")
CONTEXT = Training(classes=CLASSES, id_col="event_id")


def encoded_events(spark: SparkSession, sf_dir: str, *, scale: bool) -> tuple[DataFrame, tuple[str, ...]]:
    """(event_id, split, label, features) of all events: calendar, port and value features against the event type."""
    df = split.attach_split(ported_events(spark, sf_dir), event_split(spark, sf_dir), row_id_col="event_id", require_all=False)
    encoded, encoder = encode_table(labelled_features(df, CONFIG, CLASSES), id_col="event_id", scale=scale)
    return stash(encoded), encoder.names


def held_out(spec: ModelSpec, spark: SparkSession, sf_dir: str, **params: Any) -> DataFrame:
    table, _ = encoded_events(spark, sf_dir, scale=spec.needs_scaling)
    model = spec.train(split.only_split(table, "train"), CONTEXT, **params)
    scored = model.transform(table.filter(F.col("split") != "train"))
    return scored.select("event_id", "split", F.col("label").cast("int").alias("y_true"), F.col("prediction").cast("int").alias("y_pred"))


for _spec in CLASSIFIERS:
    registry.add(f"classify_{_spec.slug}")(partial(held_out, _spec))
registry.add("classify_job_random_forest")(partial(held_out, model_spec("random_forest", JOB_CLASSIFIERS)))


@registry.add(
    "boosted_rounds",
    f"""WITH t AS (SELECT event_type, count(*) AS n FROM ({EVENT_SPLIT}) WHERE split = 'train' GROUP BY event_type),
    base AS (SELECT sum(n)::BIGINT AS rows, round(-sum(n * ln(n / total)) / any_value(total), 6) AS loss FROM (SELECT n, sum(n) OVER () AS total FROM t))
    SELECT r::INT AS round, rows, loss AS first_loss, true AS falls FROM base, range(1, 601) x(r)""",
)
def boosted_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rounds of the job's boosted model: training rows, the loss before the first round, and whether each lowers it."""
    table, _ = encoded_events(spark, sf_dir, scale=False)
    train = split.only_split(table, "train")
    losses = model_spec("xgboost", JOB_CLASSIFIERS).train(train, CONTEXT).losses
    falls = spark.createDataFrame([(k, round(losses[0], 6), losses[k] < losses[k - 1]) for k in range(1, len(losses))], "round int, first_loss double, falls boolean")
    return falls.withColumn("rows", F.lit(train.count()))


@registry.add("selected_features")
def selected_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features of labelled documents in the order forward selection takes them for their quality, with the accuracy."""
    df = load(spark, sf_dir, "documents").select("doc_id", "n_chars", "lang", "source").join(load(spark, sf_dir, "labels"), "doc_id")
    encoder = fit_encoder(df, skip=["doc_id", "quality"], scale=True)
    rows = encoder.transform(df).withColumn("label", F.col("quality").cast("double")).select("doc_id", "features", "label")
    chosen = select_features(rows, id_col="doc_id", label_col="label", classes=2, width=len(encoder.names))
    named = [(k, encoder.names[i], s) for k, (i, s) in enumerate(zip(chosen.kept, chosen.scores), 1)]
    table = spark.createDataFrame(named, "step int, feature string, accuracy double")
    return table.withColumn("rows", F.lit(rows.count()))


@registry.add("probabilities")
def probabilities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted label, largest class probability and true label of every held-out event."""
    table, _ = encoded_events(spark, sf_dir, scale=True)
    model = model_spec("logistic_regression", CLASSIFIERS).train(split.only_split(table, "train"), CONTEXT)
    scored = model.transform(table.filter(F.col("split") != "train"))
    return predictions_table(scored, row_id_col="event_id", classes=CLASSES)


@registry.add("one_vs_rest_probabilities")
def one_vs_rest_probabilities(spark: SparkSession, sf_dir: str) -> DataFrame:
    table, _ = encoded_events(spark, sf_dir, scale=True)
    model = model_spec("svm", CLASSIFIERS).train(split.only_split(table, "train"), CONTEXT)
    scored = model.transform(table.filter(F.col("split") != "train"))
    return scored.select("event_id", F.array_max(class_probabilities(scored)).alias("pred_proba_max"))


@registry.add("top_coefficients")
def top_coefficients(spark: SparkSession, sf_dir: str) -> DataFrame:
    table, names = encoded_events(spark, sf_dir, scale=True)
    model = model_spec("lasso_regression", CLASSIFIERS).train(split.only_split(table, "train"), CONTEXT)
    return top_features(coefficient_table(table, names, model.coefficientMatrix.toArray().tolist()), "l2", 20)


@registry.add("top_importances")
def top_importances(spark: SparkSession, sf_dir: str) -> DataFrame:
    table, names = encoded_events(spark, sf_dir, scale=False)
    model = model_spec("decision_trees", CLASSIFIERS).train(split.only_split(table, "train"), CONTEXT)
    return top_features(importance_table(table, names, model.featureImportances.toArray()), "importance", 20)


def timed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with their JSON number and chronological split; the regression target is value."""
    df = load(spark, sf_dir, "events")
    rows = df.withColumn("split", split.split_by_cuts(df, "ts", split.time_cuts(df, "ts")))
    return rows.select("event_id", "split", "event_type", "user_id", json_or(F.col("props"), "$.k", "double", 0.0).alias("k"), F.col("value").alias("label"))


def regress(spec: ModelSpec, spark: SparkSession, sf_dir: str, **params: Any) -> DataFrame:
    encoded, _ = encode_table(timed_events(spark, sf_dir), id_col="event_id", scale=spec.needs_scaling)
    table = stash(encoded)
    model = spec.train(split.only_split(table, "train"), Training(id_col="event_id"), **params)
    scored = model.transform(table.filter(F.col("split") != "train"))
    return scored.select("event_id", "split", F.col("label").alias("y_true"), F.col("prediction").alias("y_pred"))


for _slug in ("knn_regression", "random_forest_regression", "gradient_boosting_regression", "xgboost_regression"):
    registry.add(f"regress_{_slug}")(partial(regress, model_spec(_slug, REGRESSORS)))
registry.add("regress_report_knn")(partial(regress, model_spec("knn_regression", REPORT_REGRESSORS)))

# One scaled feature z: slopes are cov(z, y), shrunk by the penalty.
ONE_FEATURE = f"""WITH t AS (SELECT s.split, e.event_id, e.value AS y, CAST(json_extract_string(e.props, '$.k') AS DOUBLE) AS k FROM events e JOIN (SELECT event_id, split FROM ({EVENT_TIME_SPLIT})) s USING (event_id)),
m AS (SELECT avg(k) AS mk, stddev_pop(k) AS sk, avg(y) AS my, covar_pop(k, y) / stddev_pop(k) AS c, count(*) AS n FROM t WHERE split = 'train')
SELECT event_id, split, round(my + ({{slope}}) * (k - mk) / sk, 4) AS y_pred FROM t, m WHERE split <> 'train'"""


def one_feature_fit(spec: ModelSpec, spark: SparkSession, sf_dir: str, **params: Any) -> DataFrame:
    rows = timed_events(spark, sf_dir).select("event_id", "split", "label", "k")
    table = stash(encode_table(rows, id_col="event_id", scale=True)[0])
    model = spec.train(split.only_split(table, "train"), Training(id_col="event_id"), **params)
    scored = model.transform(table.filter(F.col("split") != "train"))
    return scored.select("event_id", "split", F.round("prediction", 4).alias("y_pred"))


for _slug, _slope, _params in (
    ("linear_regression", "c", {}),
    ("ridge_regression", "c * n / (n + 1000.0)", {"alpha": 1000.0}),
    ("lasso_regression", "sign(c) * greatest(abs(c) - 0.2, 0)", {"alpha": 0.2}),
    ("elasticnet_regression", "sign(c) * greatest(abs(c) - 0.1, 0) / (1 + 0.1)", {"alpha": 0.2}),
):
    registry.add(f"regress_{_slug}", ONE_FEATURE.format(slope=_slope))(partial(one_feature_fit, model_spec(_slug, REGRESSORS), **_params))


@registry.add(
    "least_squares_line",
    "SELECT l_returnflag, round(regr_intercept(l_extendedprice, l_quantity), 3) AS intercept, round(regr_slope(l_extendedprice, l_quantity), 3) AS slope FROM lineitem GROUP BY 1",
)
def least_squares_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One line per return flag, one aggregate."""
    df = load(spark, sf_dir, "lineitem")
    fit = [F.round(f("l_extendedprice", "l_quantity"), 3).alias(n) for f, n in ((F.regr_intercept, "intercept"), (F.regr_slope, "slope"))]
    return df.groupBy("l_returnflag").agg(*fit)


def embedding_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "embeddings").select("vec_id", F.col("label").cast("double").alias("label"), array_to_vector(F.col("embedding").cast("array<double>")).alias("features"))


EMBEDDING = Training(classes=tuple(map(str, range(10))), id_col="vec_id")


@registry.add("kmeans_clusters")
def kmeans_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = embedding_rows(spark, sf_dir)
    model = model_spec("k_means_clustering", CLUSTERERS).train(rows, EMBEDDING)
    return model.transform(rows).select("vec_id", F.col("label").cast("int").alias("label"), F.col("prediction").alias("cluster"))


@registry.add("hierarchical_clusters")
def hierarchical_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = embedding_rows(spark, sf_dir)
    model = model_spec("hierarchical_agglomerative_clustering", CLUSTERERS).train(rows, EMBEDDING)
    return model.transform(rows).select("vec_id", F.col("label").cast("int").alias("label"), F.col("prediction").alias("cluster"))


@registry.add("cluster_report")
def cluster_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Agreement, number of clusters and rows of the K-means clustering."""
    found = kmeans_clusters(spark, sf_dir)
    agreement = cluster_agreement(found, "label", "cluster").first()
    return cluster_summary(found, "cluster").withColumns({"ari": F.lit(agreement["ari"]), "nmi": F.lit(agreement["nmi"])})


@registry.add("cluster_points")
def cluster_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = vector_to_array(F.col("point"))
    return explore.cluster_points(embedding_rows(spark, sf_dir)).select("vec_id", v[0].alias("x"), v[1].alias("y"))


@registry.add("density_clusters_two_columns")
def density_clusters_two_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Density clusters of scaled events on two numeric columns, with sizes."""
    rows = load(spark, sf_dir, "events").select("event_id", (F.col("user_id") / 10.0).alias("x"), (F.col("value") / 20.0).alias("y"))
    found = dbscan(rows, id_col="event_id", dims=["x", "y"], eps=0.5, min_points=10)
    return found.groupBy("cluster", "core").agg(F.count("*").alias("rows"))
