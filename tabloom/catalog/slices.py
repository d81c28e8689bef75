"""Group, pivot and top-k tables, and the exploration tables built from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tabloom.catalog import Registry, load
from tabloom.catalog.scalars import AGENT, agents_table
from tabloom.operators import slices
from tabloom.operators.ordered import rolling_mean
from tabloom.operators.split import fixed_sample
from tabloom.plans import explore

registry = Registry()

PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


def filtered_counts(column: str, values: list, *, quote: bool = True) -> str:
    """SQL cells of a pivot."""
    literal = (lambda v: f"'{v}'") if quote else str
    return ", ".join(f'count(*) FILTER ({column} = {literal(v)}) AS "{v}"' for v in values)


@registry.add("counts_by_two_keys", "SELECT nullif(o_orderstatus, 'F') AS status, o_orderpriority, count(*) AS count FROM orders GROUP BY 1, 2")
def counts_by_two_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = load(spark, sf_dir, "orders").select(F.nullif(F.col("o_orderstatus"), F.lit("F")).alias("status"), "o_orderpriority")
    return slices.count_by(df, ["status", "o_orderpriority"])


@registry.add("value_counts", "SELECT coalesce(nullif(p_type, 'PROMO'), 'Unknown') AS p_type, count(*) AS count FROM part GROUP BY 1 ORDER BY count DESC, p_type")
def value_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return slices.value_counts(load(spark, sf_dir, "part").withColumn("p_type", F.nullif(F.col("p_type"), F.lit("PROMO"))), "p_type")


@registry.add("pivot_counts", f"SELECT p_brand, {filtered_counts('p_type', TYPES)} FROM part GROUP BY 1")
def pivot_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = slices.count_by(load(spark, sf_dir, "part"), ["p_brand", "p_type"])
    return slices.pivot_counts(counts, "p_brand", "p_type", values=TYPES)


@registry.add(
    "ranked_counts",
    """WITH c AS (SELECT p_brand, p_name, count(*) AS count FROM part GROUP BY ALL),
    r AS (SELECT p_brand, row_number() OVER (ORDER BY sum(count) DESC, p_brand) - 1 AS row_place FROM c GROUP BY 1),
    k AS (SELECT p_name, row_number() OVER (ORDER BY sum(count) DESC, p_name) - 1 AS column_place FROM c GROUP BY 1)
    SELECT p_brand, p_name, count, row_place, column_place FROM c JOIN r USING (p_brand) JOIN k USING (p_name)""",
)
def ranked_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Brands by part names, more names than a wide table could have columns."""
    return slices.ranked_counts(slices.count_by(load(spark, sf_dir, "part"), ["p_brand", "p_name"]), "p_brand", "p_name")


@registry.add("pivot_ordered_by_total", f"SELECT p_brand, {filtered_counts('p_type', TYPES)}, count(*) AS total FROM part GROUP BY 1 ORDER BY total DESC, p_brand")
def pivot_ordered_by_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return slices.cross_counts(load(spark, sf_dir, "part"), "p_brand", "p_type")


@registry.add(
    "row_shares",
    "SELECT l_returnflag, l_linestatus, count(*) AS count, round(count(*) / sum(count(*)) OVER (PARTITION BY l_returnflag), 6) AS share FROM lineitem GROUP BY 1, 2",
)
def row_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = slices.count_by(load(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus"])
    return slices.with_share(counts, ["l_returnflag"]).withColumn("share", F.round("share", 6))


@registry.add("top_values", "SELECT l_suppkey, count(*) AS count FROM lineitem GROUP BY 1 ORDER BY count DESC, l_suppkey LIMIT 10")
def top_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return slices.top_values(load(spark, sf_dir, "lineitem"), "l_suppkey", 10)


@registry.add(
    "rows_in_top_values",
    """SELECT o_orderkey, o_custkey, o_totalprice FROM orders SEMI JOIN (SELECT o_custkey FROM orders GROUP BY 1 ORDER BY count(*) DESC, o_custkey LIMIT 25) USING (o_custkey)""",
)
def rows_in_top_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return slices.keep_top(load(spark, sf_dir, "orders"), "o_custkey", 25).select("o_orderkey", "o_custkey", "o_totalprice")


@registry.add(
    "top_values_and_other",
    """WITH c AS (SELECT p_name, count(*) AS n FROM part GROUP BY 1), r AS (SELECT *, row_number() OVER (ORDER BY n DESC, p_name) AS rn FROM c)
SELECT CASE WHEN rn <= 15 THEN p_name ELSE '(other)' END AS p_name, sum(n)::BIGINT AS count FROM r GROUP BY 1""",
)
def top_values_and_other(spark: SparkSession, sf_dir: str) -> DataFrame:
    return slices.other_bucket(slices.count_by(load(spark, sf_dir, "part"), ["p_name"]), "p_name", 15)


@registry.add(
    "top_items_per_group",
    """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY p_type ORDER BY count DESC, p_name)::INT AS rank FROM (SELECT p_type, p_name, count(*) AS count FROM part GROUP BY 1, 2)) WHERE rank <= 15""",
)
def top_items_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return slices.top_per_group(slices.count_by(load(spark, sf_dir, "part"), ["p_type", "p_name"]), "p_type", "p_name", 15)


@registry.add(
    "counts_for_label_list",
    """SELECT (i - 1)::INT AS position, ['view', 'refund', 'click', 'login'][i] AS event_type,
(SELECT count(*) FROM events WHERE event_type = ['view', 'refund', 'click', 'login'][i]) AS count FROM range(1, 5) t(i)""",
)
def counts_for_label_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return slices.full_label_counts(load(spark, sf_dir, "events"), "event_type", ["view", "refund", "click", "login"])


@registry.add("class_index", "SELECT event_type AS class, (row_number() OVER (ORDER BY event_type) - 1)::INT AS index FROM (SELECT DISTINCT event_type FROM events)")
def class_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return slices.class_index(load(spark, sf_dir, "events"), "event_type")


@registry.add(
    "multi_key_sort",
    "SELECT o_orderpriority, o_orderdate, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1, 2 ORDER BY o_orderpriority, n DESC, o_orderdate",
)
def multi_key_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = load(spark, sf_dir, "orders").groupBy("o_orderpriority", "o_orderdate").agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))
    return days.orderBy("o_orderpriority", F.desc("n"), "o_orderdate")


@registry.add("first_rows", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F' ORDER BY o_orderkey LIMIT 100")
def first_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "orders").filter("o_orderstatus = 'F'").select("o_orderkey", "o_orderstatus").orderBy("o_orderkey").limit(100)


@registry.add(
    "rolling_mean",
    """SELECT event_id, ts, value, round(CASE WHEN count(value) OVER w >= 20 THEN avg(value) OVER w END, 6) AS rolling_mean FROM events
WINDOW w AS (ORDER BY ts, event_id ROWS BETWEEN 199 PRECEDING AND CURRENT ROW)""",
)
def rolling(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = load(spark, sf_dir, "events").select("event_id", "ts", "value")
    return rolling_mean(df, ["ts", "event_id"], "value").withColumn("rolling_mean", F.round("rolling_mean", 6))


YEARS = list(range(1995, 2002))


@registry.add("label_by_year", f"SELECT o_orderpriority AS label, {filtered_counts('year(o_orderdate)', YEARS, quote=False)}, count(*) AS total FROM orders GROUP BY 1 ORDER BY total DESC, label")
def label_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explore.label_by_period(load(spark, sf_dir, "orders"), "o_orderpriority", "o_orderdate", "year")


@registry.add("label_by_month", f"SELECT month(o_orderdate)::INT AS period, {filtered_counts('o_orderpriority', PRIORITIES)} FROM orders GROUP BY 1 ORDER BY period")
def label_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explore.label_by_period(load(spark, sf_dir, "orders"), "o_orderpriority", "o_orderdate", "month")


@registry.add("browser_totals", f"SELECT coalesce(split_part({AGENT}, '/', 1), 'Unknown') AS browser, count(*) AS count FROM documents GROUP BY 1 ORDER BY count DESC, browser")
def browser_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explore.browser_totals(agents_table(spark, sf_dir), "agent")


DEVICE = f"""coalesce(nullif(regexp_extract(a, '(?i)Windows', 0), ''), nullif(regexp_extract(a, '(?i)Linux', 0), ''),
nullif(regexp_extract(a, '(?i)Android', 0), ''), nullif(regexp_extract(a, '(?i)iPad', 0), ''), nullif(regexp_extract(a, '(?i)iPod', 0), ''),
nullif(regexp_extract(a, '(?i)iPhone', 0), ''), nullif(regexp_extract(a, '(?i)Macintosh', 0), ''), 'Unknown')"""


@registry.add(
    "device_shares",
    f"""SELECT device_os, count, round(count * 100.0 / sum(count) OVER (), 1)::DOUBLE AS percent FROM (SELECT {DEVICE} AS device_os, count(*) AS count
FROM (SELECT {AGENT} AS a FROM documents) GROUP BY 1 ORDER BY count DESC, device_os LIMIT 25)""",
)
def device_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explore.device_shares(agents_table(spark, sf_dir), "agent")


LANGS = ["de", "en", "es", "fr"]


@registry.add(
    "source_by_language",
    f"""SELECT "row", {filtered_counts('"column"', LANGS)}, count(*) AS total FROM (SELECT source AS "row", lang AS "column" FROM documents) GROUP BY 1 ORDER BY total DESC, "row\"""",
)
def source_by_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explore.paired_counts(load(spark, sf_dir, "documents"), F.col("source"), F.col("lang"))


@registry.add(
    "pivot_with_named_gaps",
    f"""SELECT "row", {filtered_counts('"column"', ['No Data', 'en', 'es', 'fr'])}, count(*) AS total FROM (SELECT CASE WHEN source IN ('src1', 'src2') THEN 'No Data' ELSE source END AS "row",
CASE WHEN lang = 'de' THEN 'No Data' ELSE lang END AS "column" FROM documents) GROUP BY 1 ORDER BY total DESC, "row\"""",
)
def pivot_with_named_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    row = F.when(F.col("source") == "src1", "Unknown").when(F.col("source") != "src2", F.col("source"))
    return explore.paired_counts(load(spark, sf_dir, "documents"), row, F.nullif(F.col("lang"), F.lit("de")), missing="No Data", merge_unknown=True)


@registry.add(
    "devices_per_source",
    f"""WITH c AS (SELECT source, {DEVICE} AS device, count(*) AS n FROM (SELECT source, lower({AGENT}) AS a FROM documents) GROUP BY 1, 2),
t AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY n DESC, device) AS rn FROM c)
SELECT source, {', '.join(f"coalesce(sum(n) FILTER (device = '{d}'), 0)::BIGINT AS {d}" for d in ('linux', 'macintosh', 'Unknown', 'windows', 'ipad', 'iphone'))}
FROM t WHERE rn <= 15 GROUP BY 1 ORDER BY 1""",
)
def devices_per_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explore.devices_per_source(agents_table(spark, sf_dir).withColumn("agent", F.lower("agent")), "source", "agent")


@registry.add(
    "top_values_by_label",
    """WITH t AS (SELECT coalesce(p_name, 'Unknown') AS value FROM part GROUP BY 1 ORDER BY count(*) DESC, value LIMIT 25)
SELECT p_name AS value, p_type AS label, count(*) AS count FROM part WHERE p_name IN (SELECT value FROM t) GROUP BY 1, 2""",
)
def top_values_by_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explore.top_values_by_label(load(spark, sf_dir, "part"), "p_name", "p_type", k=25)


@registry.add(
    "top_values_pivot",
    f"""WITH s AS (SELECT coalesce(nullif(p_name, 'red widget'), 'No Detection') AS value, p_type FROM part), t AS (SELECT value FROM s GROUP BY 1 ORDER BY count(*) DESC, value LIMIT 25)
SELECT value, {filtered_counts('p_type', TYPES)}, count(*) AS total FROM s WHERE value IN (SELECT value FROM t) GROUP BY 1 ORDER BY total DESC, value""",
)
def top_values_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = load(spark, sf_dir, "part").withColumn("p_name", F.nullif(F.col("p_name"), F.lit("red widget")))
    return explore.top_values_pivot(df, "p_name", "p_type", k=25, missing="No Detection", merge_unknown=True)


@registry.add(
    "top_category_by_label",
    f"""WITH t AS (SELECT c_nationkey FROM customer GROUP BY 1 ORDER BY count(*) DESC, c_nationkey LIMIT 10)
SELECT c_nationkey, {filtered_counts('c_mktsegment', ['AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY'])}, count(*) AS total
FROM customer SEMI JOIN t USING (c_nationkey) GROUP BY 1 ORDER BY total DESC, c_nationkey""",
)
def top_category_by_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return slices.top_by_label(load(spark, sf_dir, "customer"), "c_nationkey", "c_mktsegment", 10)


@registry.add("class_balance", "SELECT event_type, count(*) AS count, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM events GROUP BY 1")
def class_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explore.class_balance(load(spark, sf_dir, "events"), "event_type").withColumn("share", F.round("share", 6))


@registry.add(
    "scatter_sample",
    "SELECT event_id, user_id, value FROM events ORDER BY md5('42:' || event_id), event_id LIMIT 8000",
)
def scatter_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixed_sample(load(spark, sf_dir, "events").select("event_id", "user_id", "value"), 8000, id_col="event_id")


@registry.add("label_union", "SELECT DISTINCT event_type FROM (SELECT event_type FROM events WHERE value > 10 UNION ALL SELECT event_type FROM events WHERE value <= 10) ORDER BY 1")
def label_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = load(spark, sf_dir, "events")
    return slices.label_union(df.filter("value > 10"), df.filter("value <= 10"), label="event_type")
