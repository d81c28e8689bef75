"""Time-ordered and stratified splits, and the joins that use them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tabloom.catalog import Registry, load
from tabloom.functions.calendar import calendar_fields, is_weekend
from tabloom.operators import clean, metrics, slices, split

registry = Registry()


def time_split_sql(table: str, time: str, columns: str) -> str:
    return f"""WITH g AS (SELECT {time} AS t, count(*) AS n FROM {table} GROUP BY 1),
c AS (SELECT t, sum(n) OVER (ORDER BY t) - n AS before FROM g),
k AS (SELECT floor(count(*) * 0.7::DOUBLE) AS tt, floor(count(*) * (0.7::DOUBLE + 0.15::DOUBLE)) AS vt FROM {table}),
r AS (SELECT t, before, (before = 0 OR before < tt) AS in_train, vt FROM c, k),
f AS (SELECT min(t) FILTER (NOT in_train) AS first_after FROM r),
s AS (SELECT t, CASE WHEN in_train THEN 'train' WHEN t = first_after OR before < vt THEN 'val' ELSE 'test' END AS split FROM r, f)
SELECT {columns} FROM {table} JOIN s ON {time} = s.t"""


EVENT_TIME_SPLIT = time_split_sql("events", "ts", "event_id, ts, split")


@registry.add("time_split_events", EVENT_TIME_SPLIT)
def time_split_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.time_split(load(spark, sf_dir, "events"), time_col="ts", row_id_col="event_id")[0]


@registry.add("time_split_orders", time_split_sql("orders", "o_orderdate", "o_orderkey, o_orderdate, split"))
def time_split_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.time_split(load(spark, sf_dir, "orders"), time_col="o_orderdate", row_id_col="o_orderkey")[0]


@registry.add(
    "time_split_report",
    time_split_sql("lineitem", "l_shipdate", "split, count(*) AS rows, min(l_shipdate) AS first_day, max(l_shipdate) AS last_day") + " GROUP BY 1",
)
def time_split_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_shipdate")
    rows, _ = split.time_split(df, time_col="l_shipdate", row_id_col="l_orderkey")
    days = rows.groupBy("split").agg(F.min("l_shipdate").alias("first_day"), F.max("l_shipdate").alias("last_day"))
    return split.split_report(rows).join(days, "split")


@registry.add(
    "time_split_flagship",
    f"""SELECT split, event_type, dayofweek, is_weekend, count(*) AS n, round(avg(value), 6) AS mean_value FROM (SELECT split, event_type, (isodow(e.ts) - 1)::INT AS dayofweek,
(isodow(e.ts) >= 6)::INT AS is_weekend, value FROM events e JOIN ({EVENT_TIME_SPLIT}) s USING (event_id)) GROUP BY ALL""",
)
def time_split_flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = load(spark, sf_dir, "events")
    cuts = split.time_cuts(df, "ts")
    ts = F.col("ts")
    rows = df.select(split.split_by_cuts(df, "ts", cuts).alias("split"), "event_type", *calendar_fields(ts, ("dayofweek",)), is_weekend(ts).alias("is_weekend"), "value")
    return rows.groupBy("split", "event_type", "dayofweek", "is_weekend").agg(F.count("*").alias("n"), F.round(F.avg("value"), 6).alias("mean_value"))


def stratified_sql(table: str, key: str, label: str) -> str:
    return f"""WITH c AS (SELECT {label} AS y, count(*) AS n FROM {table} GROUP BY 1), k AS (SELECT sum(n)::BIGINT AS total, floor(sum(n) * 0.7::DOUBLE)::BIGINT AS train FROM c),
a AS (SELECT y, n, n * train // total AS whole, n * train % total AS rem, train, total FROM c, k),
b AS (SELECT y, n, whole + (row_number() OVER (ORDER BY rem DESC, y) <= train - sum(whole) OVER ())::BIGINT AS in_train, train, total FROM a),
d AS (SELECT y, in_train, n - in_train AS rest, total - train AS left_total, floor((total - train) * (0.15::DOUBLE / (0.15::DOUBLE + 0.15::DOUBLE)))::BIGINT AS val FROM b),
e AS (SELECT y, in_train, rest * val // left_total AS whole, rest * val % left_total AS rem, val FROM d),
q AS (SELECT y, in_train, whole + (row_number() OVER (ORDER BY rem DESC, y) <= val - sum(whole) OVER ())::BIGINT AS in_val FROM e),
r AS (SELECT {key} AS id, {label} AS y, row_number() OVER (PARTITION BY {label} ORDER BY md5('42:' || {key}), {key}) AS rn FROM {table})
SELECT id AS {key}, y AS {label}, CASE WHEN rn <= in_train THEN 'train' WHEN rn <= in_train + in_val THEN 'val' ELSE 'test' END AS split FROM r JOIN q USING (y)"""


EVENT_SPLIT = stratified_sql("events", "event_id", "event_type")


def event_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.stratified_split(load(spark, sf_dir, "events"), label_col="event_type", row_id_col="event_id")


@registry.add("stratified_split_events", EVENT_SPLIT)
def stratified_split_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_split(spark, sf_dir)


@registry.add("stratified_split_orders", stratified_sql("orders", "o_orderkey", "o_orderpriority"))
def stratified_split_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.stratified_split(load(spark, sf_dir, "orders"), label_col="o_orderpriority", row_id_col="o_orderkey")


@registry.add("labels_per_split", f"SELECT split, event_type, count(*) AS count FROM ({EVENT_SPLIT}) GROUP BY 1, 2")
def labels_per_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.label_table(event_split(spark, sf_dir), "event_type")


@registry.add(
    "label_shares_per_split",
    f"SELECT split, event_type, count(*) AS count, round(count(*) / sum(count(*)) OVER (PARTITION BY split), 6) AS share FROM ({EVENT_SPLIT}) GROUP BY 1, 2",
)
def label_shares_per_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = slices.count_by(event_split(spark, sf_dir), ["split", "event_type"])
    return slices.with_share(counts, ["split"]).withColumn("share", F.round("share", 6))


@registry.add(
    "split_join",
    f"SELECT event_id, event_type, value, split FROM events JOIN (SELECT event_id, split FROM ({EVENT_SPLIT})) USING (event_id)",
)
def split_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = load(spark, sf_dir, "events").select("event_id", "event_type", "value")
    return split.join_split(df, event_split(spark, sf_dir), row_id_col="event_id", label_col="event_type")


@registry.add("split_left_join", f"SELECT event_id, user_id, split FROM events LEFT JOIN (SELECT event_id, split FROM ({EVENT_TIME_SPLIT})) USING (event_id)")
def split_left_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = load(spark, sf_dir, "events")
    rows, _ = split.time_split(df, time_col="ts", row_id_col="event_id")
    return split.attach_split(df.select("event_id", "user_id"), rows, row_id_col="event_id")


@registry.add("one_split", f"SELECT event_id, event_type, split FROM ({EVENT_SPLIT}) WHERE split = 'val'")
def one_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.only_split(event_split(spark, sf_dir), "val")


@registry.add(
    "label_mismatches",
    "SELECT count(*) AS rows, count(*) FILTER (quality <> toxic) AS mismatches FROM labels",
)
def label_mismatches(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = load(spark, sf_dir, "labels")
    return split.label_mismatches(df.select("doc_id", "quality"), df.select("doc_id", F.col("toxic").alias("quality")), row_id_col="doc_id", label_col="quality")


@registry.add(
    "labelled_documents",
    "SELECT doc_id, lang, n_chars, quality, toxic FROM documents JOIN labels USING (doc_id)",
)
def labelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars").join(load(spark, sf_dir, "labels"), "doc_id")


@registry.add(
    "tagged_union",
    f"""SELECT event_id, event_type, split FROM ({EVENT_SPLIT})""",
)
def tagged_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = event_split(spark, sf_dir)
    return split.tagged_union({name: split.only_split(rows, name).drop("split") for name in split.SPLITS})


@registry.add("fixed_sample", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY md5('7:' || o_orderkey), o_orderkey LIMIT 200")
def fixed_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.fixed_sample(load(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), 200, id_col="o_orderkey", seed=7)


@registry.add(
    "complete_pairs",
    "SELECT event_id, amount, user_id FROM (SELECT event_id, CASE WHEN value >= 5 THEN value END AS amount, nullif(user_id, 7) AS user_id FROM events) WHERE amount IS NOT NULL AND user_id IS NOT NULL",
)
def complete_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = load(spark, sf_dir, "events").select("event_id", F.when(F.col("value") >= 5, F.col("value")).alias("amount"), F.nullif(F.col("user_id"), F.lit(7)).alias("user_id"))
    clean.require_columns(df, ["amount", "user_id"])
    return df.dropna(subset=["amount", "user_id"])
