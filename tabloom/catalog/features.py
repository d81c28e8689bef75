"""Config-driven features, imputation, encoding and weights."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from tabloom.catalog import Registry, load
from tabloom.functions.labels import json_or
from tabloom.operators import encode, features

registry = Registry()

CONFIG = features.FeatureConfig("event_type", "event_id", drop_cols=("props", "absent"), timestamp_cols=("ts",), port_cols=("port",))


def ported_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with a port column made from their JSON."""
    return load(spark, sf_dir, "events").withColumn("port", json_or(F.col("props"), "$.k", "int", 0) * 710 - 100)


PORTED = "(SELECT *, CAST(json_extract_string(props, '$.k') AS INT) * 710 - 100 AS port FROM events)"
DERIVED = """hour(ts)::INT AS ts_hour, (isodow(ts) - 1)::INT AS ts_dayofweek, month(ts)::INT AS ts_month, (isodow(ts) >= 6)::INT AS ts_is_weekend,
(port BETWEEN 0 AND 1023)::INT AS port_is_well_known, (port BETWEEN 1024 AND 49151)::INT AS port_is_registered, (port BETWEEN 49152 AND 65535)::INT AS port_is_dynamic"""


@registry.add("feature_table", f"SELECT event_id, user_id, value, port, {DERIVED} FROM {PORTED}")
def feature_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.feature_table(ported_events(spark, sf_dir), CONFIG, keep=["event_id"])


@registry.add("features_and_label", f"SELECT event_id, event_type, user_id, value, port, {DERIVED} FROM {PORTED}")
def features_and_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.features_and_label(ported_events(spark, sf_dir), CONFIG, keep=["event_id"])


@registry.add("features_for_other_target", f"SELECT event_id, value, user_id, port, {DERIVED} FROM {PORTED}")
def features_for_other_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.features_and_label(ported_events(spark, sf_dir), CONFIG.with_target("value"), keep=["event_id"])


GAPPY = "(SELECT event_id, CASE WHEN value >= 5 THEN value END AS value, nullif(user_id, 7) AS user_id, nullif(event_type, 'error') AS event_type FROM events)"


def gappy_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "events").select(
        "event_id",
        F.when(F.col("value") >= 5, F.col("value")).alias("value"),
        F.nullif(F.col("user_id"), F.lit(7)).alias("user_id"),
        F.nullif(F.col("event_type"), F.lit("error")).alias("event_type"),
    )


FILLS = f"""(SELECT quantile_cont(value, 0.5) AS v, quantile_cont(user_id, 0.5) AS u FROM {GAPPY}),
(SELECT event_type AS e FROM {GAPPY} WHERE event_type IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, event_type LIMIT 1)"""


@registry.add(
    "imputed_columns",
    f"SELECT event_id, round(coalesce(value, v), 6) AS value, coalesce(user_id, u)::DOUBLE AS user_id, coalesce(event_type, e) AS event_type FROM {GAPPY}, {FILLS}",
)
def imputed_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = gappy_events(spark, sf_dir)
    middle = encode.medians(df, ["value", "user_id"])
    common = encode.modes(encode.category_counts(df, ["event_type"])).first()["value"]
    return df.select(
        "event_id",
        F.round(encode.imputed(F.col("value"), middle["value"]), 6).alias("value"),
        encode.imputed(F.col("user_id"), middle["user_id"]).alias("user_id"),
        encode.imputed(F.col("event_type"), common).alias("event_type"),
    )


@registry.add(
    "scaled_columns",
    f"""SELECT event_id, round((a - avg(a) OVER ()) / stddev_pop(a) OVER (), 6) AS value, round((b - avg(b) OVER ()) / stddev_pop(b) OVER (), 6) AS user_id
FROM (SELECT event_id, coalesce(value, v) AS a, coalesce(user_id, u) AS b FROM {GAPPY}, {FILLS})""",
)
def scaled_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoder = encode.fit_encoder(gappy_events(spark, sf_dir), skip=["event_id", "event_type"], scale=True)
    v = vector_to_array(F.col("features"))
    return encoder.transform(gappy_events(spark, sf_dir)).select("event_id", F.round(v[0], 6).alias("value"), F.round(v[1], 6).alias("user_id"))


@registry.add(
    "one_hot_columns",
    f"""SELECT event_id, (k = 'click')::INT::DOUBLE AS is_click, (k = 'purchase')::INT::DOUBLE AS is_purchase, (k = 'signup')::INT::DOUBLE AS is_signup, (k = 'view')::INT::DOUBLE AS is_view
FROM (SELECT event_id, CASE WHEN event_type IS NULL THEN 'never seen' ELSE event_type END AS k FROM {GAPPY})""",
)
def one_hot_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = gappy_events(spark, sf_dir).select("event_id", "event_type")
    encoder = encode.fit_encoder(df, skip=["event_id"])
    unseen = df.withColumn("event_type", F.coalesce("event_type", F.lit("never seen")))
    v = vector_to_array(F.col("features"))
    return encoder.transform(unseen).select("event_id", *(v[i].alias(f"is_{n.removeprefix('event_type_')}") for i, n in enumerate(encoder.names)))


@registry.add(
    "encoded_table",
    f"""SELECT event_id, round(a, 6) AS value, b::DOUBLE AS user_id, (k = 'click')::INT::DOUBLE AS click, (k = 'purchase')::INT::DOUBLE AS purchase, (k = 'signup')::INT::DOUBLE AS signup,
(k = 'view')::INT::DOUBLE AS "view" FROM (SELECT event_id, coalesce(value, v) AS a, coalesce(user_id, u) AS b, coalesce(event_type, e) AS k FROM {GAPPY}, {FILLS})""",
)
def encoded_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = gappy_events(spark, sf_dir)
    encoder = encode.fit_encoder(df, skip=["event_id"])
    v = vector_to_array(F.col("features"))
    return encoder.transform(df).select("event_id", *(F.round(v[i], 6).alias(n.removeprefix("event_type_")) for i, n in enumerate(encoder.names)))


@registry.add(
    "missing_as_category",
    f"SELECT event_id, (event_type IS NULL)::INT::DOUBLE AS missing, coalesce(event_type = 'click', false)::INT::DOUBLE AS click FROM {GAPPY}",
)
def missing_as_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = gappy_events(spark, sf_dir).select("event_id", "event_type")
    encoder = encode.fit_encoder(df, skip=["event_id"], missing_as_category=True)
    v = vector_to_array(F.col("features"))
    place = {n.removeprefix("event_type_"): i for i, n in enumerate(encoder.names)}
    return encoder.transform(df).select("event_id", v[place[encode.MISSING_CATEGORY]].alias("missing"), v[place["click"]].alias("click"))


@registry.add(
    "encoded_feature_names",
    """SELECT name, count FROM (SELECT 'event_type_' || event_type AS name, count(*)::DOUBLE AS count FROM events GROUP BY 1 UNION ALL SELECT 'value', round(sum(value), 2) FROM events)""",
)
def encoded_feature_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feature names with the sum of each encoded column."""
    df = load(spark, sf_dir, "events").select("event_id", "value", "event_type")
    encoder = encode.fit_encoder(df, skip=["event_id"])
    v = vector_to_array(F.col("features"))
    pairs = F.array(*(F.struct(F.lit(n).alias("name"), v[i].alias("x")) for i, n in enumerate(encoder.names)))
    return encoder.transform(df).select(F.inline(pairs)).groupBy("name").agg(F.round(F.sum("x"), 2).alias("count"))


@registry.add(
    "balanced_class_weights",
    "SELECT quality, round(sum(n) OVER () / (count(*) OVER () * n), 6) AS weight FROM (SELECT quality, count(*) AS n FROM labels GROUP BY 1)",
)
def balanced_class_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode.balanced_weights(load(spark, sf_dir, "labels"), "quality").withColumn("weight", F.round("weight", 6))


@registry.add(
    "weighted_rows",
    """SELECT doc_id, quality, round((SELECT count(*) FROM labels) / (2.0 * count(*) OVER (PARTITION BY quality)), 6) AS weight FROM labels""",
)
def weighted_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode.with_balanced_weights(load(spark, sf_dir, "labels"), "quality").select("doc_id", "quality", F.round("weight", 6).alias("weight"))


@registry.add(
    "principal_component_variance",
    """SELECT round(var_samp(l_quantity) + var_samp(l_discount), 6) AS total FROM lineitem""",
)
def principal_component_variance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sample variances of all components add up to those of the columns."""
    df = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity", "l_discount")
    encoded = encode.fit_encoder(df, skip=["l_orderkey"]).transform(df)
    projected = encode.fit_pca(encoded, components=2).transform(encoded)
    v = vector_to_array(F.col("pca"))
    return projected.agg(F.round(F.var_samp(v[0]) + F.var_samp(v[1]), 6).alias("total"))


@registry.add("explained_variance")
def explained_variance(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = load(spark, sf_dir, "embeddings").select("vec_id", array_to_vector(F.col("embedding").cast("array<double>")).alias("features"))
    return encode.fit_pca(df, components=50).explained_variance(df)
