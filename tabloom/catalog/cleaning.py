"""Cleaning, typing and keying."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tabloom.catalog import Registry, load
from tabloom.catalog.scalars import RAW_TEXT, raw_events
from tabloom.operators import clean, metrics, profile, slices
from tabloom.plans.prepare import TableSpec, clean_table

registry = Registry()


@registry.add("trimmed_column_names", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def trimmed_column_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.trim_column_names(load(spark, sf_dir, "supplier").toDF(" s_suppkey", "s_name ", " s_nationkey ", "s_acctbal"))


@registry.add(
    "cleaned_table",
    f"""SELECT event_id, CASE WHEN event_type <> 'view' THEN ts END AS seen, CASE WHEN event_type <> 'purchase' THEN value END AS amount,
CASE WHEN trim(raw) IN ('', 'nan', 'None') THEN NULL ELSE trim(raw) END AS kind
FROM (SELECT *, {RAW_TEXT} AS raw FROM events) WHERE trim(raw) NOT IN ('', 'nan', 'None')""",
)
def cleaned_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    raw = raw_events(spark, sf_dir).select(
        "event_id",
        F.when(kind == "view", "soon").otherwise(F.col("ts").cast("string")).alias(" seen"),
        F.when(kind == "purchase", "??").otherwise(F.col("value").cast("string")).alias("amount "),
        F.col("raw").alias("kind"),
    )
    cleaned = clean_table(raw, TableSpec(target_col="kind", time_cols=("seen",), number_cols=("amount",)))
    return cleaned.withColumn("seen", F.col("seen").cast("timestamp_ntz"))


@registry.add(
    "complete_rows",
    """SELECT o_orderkey, status, priority FROM (SELECT o_orderkey, nullif(o_orderstatus, 'F') AS status, nullif(o_orderpriority, '5-LOW') AS priority FROM orders)
WHERE status IS NOT NULL""",
)
def complete_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = load(spark, sf_dir, "orders").select(
        "o_orderkey", F.nullif(F.col("o_orderstatus"), F.lit("F")).alias("status"), F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("priority")
    )
    return clean.drop_empty_rows(clean.drop_missing_target(df, "status"))


@registry.add(
    "empty_rows_dropped",
    """SELECT status, priority, count(*) AS n FROM (SELECT nullif(o_orderstatus, 'F') AS status, nullif(o_orderpriority, '5-LOW') AS priority FROM orders)
WHERE status IS NOT NULL OR priority IS NOT NULL GROUP BY 1, 2""",
)
def empty_rows_dropped(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = load(spark, sf_dir, "orders").select(
        F.nullif(F.col("o_orderstatus"), F.lit("F")).alias("status"), F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("priority")
    )
    return clean.drop_empty_rows(df).groupBy("status", "priority").agg(F.count("*").alias("n"))


@registry.add(
    "invalid_times_dropped",
    """SELECT event_id, ts, (SELECT count(*) FROM events WHERE event_type = 'error') AS dropped FROM events WHERE event_type <> 'error'""",
)
def invalid_times_dropped(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = load(spark, sf_dir, "events").select("event_id", F.when(F.col("event_type") != "error", F.col("ts")).alias("ts"))
    kept, dropped = clean.drop_invalid_times(df, "ts")
    return kept.withColumn("dropped", F.lit(dropped).cast("bigint"))


@registry.add(
    "row_ids",
    """SELECT format('row_{:06d}', row_number() OVER (ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey) - 1) AS row_id,
l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate FROM lineitem""",
)
def row_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
    return clean.add_row_id(df, ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"])


@registry.add(
    "resolved_columns",
    "SELECT o_orderkey, o_orderdate AS day, o_orderpriority AS priority FROM orders",
)
def resolved_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = load(spark, sf_dir, "orders")
    day = clean.resolve_column(df, ["Order Date", "O Order-Date"])
    priority = clean.resolve_column(df, ["o_orderPRIORITY", "Priority"])
    return df.select("o_orderkey", clean.col(day).alias("day"), clean.col(priority).alias("priority"))


@registry.add(
    "numeric_column_means",
    """SELECT round(avg(p_partkey), 6) AS p_partkey, round(avg(p_size), 6) AS p_size, round(avg(p_retailprice), 6) AS p_retailprice FROM part""",
)
def numeric_column_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = load(spark, sf_dir, "part")
    numeric, _ = clean.numeric_and_categorical(df)
    return df.agg(*(F.round(F.avg(c), 6).alias(c) for c in numeric))


@registry.add(
    "filled_labels",
    """SELECT status, priority, count(*) AS count FROM (SELECT coalesce(nullif(CASE o_orderstatus WHEN 'F' THEN NULL WHEN 'O' THEN 'Unknown' ELSE o_orderstatus END, 'Unknown'), 'No Data') AS status,
coalesce(nullif(o_orderpriority, '5-LOW'), 'No Data') AS priority FROM orders) GROUP BY 1, 2""",
)
def filled_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.when(F.col("o_orderstatus") == "O", "Unknown").when(F.col("o_orderstatus") == "P", "P")
    df = load(spark, sf_dir, "orders").select(status.alias("status"), F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("priority"))
    return slices.count_by(df, ["status", "priority"], missing="No Data", merge_unknown=True)


@registry.add(
    "missing_after_coercion",
    """SELECT count(*) FILTER (event_type = 'error') AS ts, count(*) FILTER (value < 5) AS value FROM events""",
)
def missing_after_coercion(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = load(spark, sf_dir, "events").select(
        F.when(F.col("event_type") != "error", F.col("ts").cast("string")).alias("ts"), F.when(F.col("value") >= 5, F.col("value").cast("string")).otherwise("low").alias("value")
    )
    return profile.null_counts(clean.coerce_types(df, time_cols=["ts"], number_cols=["value"]), ["ts", "value"])


@registry.add(
    "residuals",
    """SELECT event_id, round(value - m, 6) AS residual, round(abs(value - m), 6) AS abs_error
FROM (SELECT event_id, value, avg(value) OVER (PARTITION BY event_type) AS m FROM events)""",
)
def residuals(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = load(spark, sf_dir, "events")
    means = df.groupBy("event_type").agg(F.avg("value").alias("m"))
    out = metrics.with_residuals(df.join(means, "event_type"), "value", "m")
    return out.select("event_id", F.round("residual", 6).alias("residual"), F.round("abs_error", 6).alias("abs_error"))


@registry.add("table_shape", "SELECT count(*) AS rows, 11 AS cols FROM lineitem")
def table_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.table_shape(load(spark, sf_dir, "lineitem"))
