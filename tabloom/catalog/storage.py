"""Sources, sinks and the run registry: tables written to a fresh folder and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tabloom.catalog import Registry, load
from tabloom.catalog.splits import EVENT_SPLIT, event_split
from tabloom.functions.calendar import format_stamp, parse_stamp
from tabloom.operators.profile import audit_config, feature_audit
from tabloom.operators.slices import class_index
from tabloom.sources import documents, runs, tables

registry = Registry()


@registry.add("raw_csv_scan", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def raw_csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = load(spark, sf_dir, "supplier")
    path = tables.write_table(df, f"{documents.fresh_dir(spark)}/supplier.csv")
    return tables.read_raw_csv(spark, path, schema=df.schema)


@registry.add("multi_line_csv_scan", "SELECT doc_id, text, lang FROM documents")
def multi_line_csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with line breaks and quotes survive the trip."""
    df = load(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    path = tables.write_table(df, f"{documents.fresh_dir(spark)}/documents.csv")
    return tables.read_raw_csv(spark, path, schema=df.schema, multi_line=True)


@registry.add("prepared_table_scan", "SELECT * FROM part")
def prepared_table_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = documents.fresh_dir(spark)
    tables.write_table(load(spark, sf_dir, "part"), f"{folder}/cleaned.parquet")
    return tables.read_prepared(spark, folder)


@registry.add("split_table_scan", EVENT_SPLIT)
def split_table_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tables.write_table(event_split(spark, sf_dir), f"{documents.fresh_dir(spark)}/split.csv")
    return tables.read_table(spark, path, schema="event_id bigint, event_type string, split string")


@registry.add("partitioned_split_scan", f"SELECT event_id, event_type, split FROM ({EVENT_SPLIT}) WHERE split = 'test'")
def partitioned_split_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written by split, so reading one split prunes the others."""
    path = tables.write_table(event_split(spark, sf_dir), f"{documents.fresh_dir(spark)}/split.parquet", partition_by=("split",))
    return tables.read_table(spark, path).filter(F.col("split") == "test")


@registry.add(
    "class_map_scan",
    "SELECT e.event_id, 'event_type' AS target, m.i AS index FROM events e JOIN (SELECT event_type, (row_number() OVER (ORDER BY event_type) - 1)::INT AS i FROM (SELECT DISTINCT event_type FROM events)) m USING (event_type)",
)
def class_map_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = load(spark, sf_dir, "events")
    classes = [r["class"] for r in class_index(df, "event_type").orderBy("index").collect()]
    path = f"{documents.fresh_dir(spark)}/classes.json"
    documents.write_document(spark, path, documents.class_map_document("event_type", classes))
    mapping = documents.read_class_map(spark, path)
    target, index = mapping.select("target").scalar(), mapping.select("class_to_index").scalar()
    return df.select("event_id", target.alias("target"), F.element_at(index, F.col("event_type")).alias("index"))


@registry.add(
    "config_round_trip",
    "SELECT c_custkey, c_nationkey, c_acctbal, c_mktsegment FROM customer",
)
def config_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audit a table, save the config it suggests, read it back and drop the columns it names; all others stay."""
    df = load(spark, sf_dir, "customer")
    suggested = audit_config(feature_audit(df, target_col="c_mktsegment"), target_col="c_mktsegment", row_id_col="c_custkey").first()
    path = f"{documents.fresh_dir(spark)}/config.json"
    documents.write_document(spark, path, suggested.asDict(recursive=True))
    config = documents.read_config(spark, path)
    return df.drop(*config.drop_cols)


@registry.add("dated_snapshot", "SELECT * FROM nation")
def dated_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = documents.fresh_dir(spark)
    folder = tables.snapshot(load(spark, sf_dir, "nation"), root, dataset="demo/nation table", date="2024-01-31", source=sf_dir)
    return spark.read.parquet(f"{folder}/data")


@registry.add(
    "clean_predictions",
    """SELECT event_id, round(user_id + 0.2)::INT AS y_true, round(value)::INT AS y_pred FROM events WHERE event_type <> 'error' AND value >= 5""",
)
def clean_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = load(spark, sf_dir, "events").select(
        "event_id",
        F.when(F.col("event_type") != "error", (F.col("user_id") + 0.2).cast("string")).alias("y_true"),
        F.when(F.col("value") >= 5, F.col("value").cast("string")).otherwise("").alias("y_pred"),
    )
    return tables.clean_predictions(df)


STAMPED = "(SELECT event_type AS model, strftime(ts, '%Y%m%d_%H%M%S') AS run_dir, value FROM events)"


def stamped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run registry made from events: the type is the model, the time is the run stamp."""
    return load(spark, sf_dir, "events").select(F.col("event_type").alias("model"), format_stamp(F.col("ts")).alias("run_dir"), "value")


@registry.add("latest_run_per_model", f"SELECT model, max(run_dir) AS run_dir FROM {STAMPED} WHERE value >= 5 GROUP BY 1")
def latest_run_per_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.latest_run_per_model(stamped(spark, sf_dir).filter("value >= 5"))


@registry.add("newest_run", f"SELECT max(run_dir) AS run_dir, max(strptime(run_dir, '%Y%m%d_%H%M%S')) AS \"at\" FROM {STAMPED}")
def newest_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    latest = runs.newest(stamped(spark, sf_dir), "run_dir", parse_stamp(F.col("run_dir")))
    return latest.select("run_dir", F.col("at").cast("timestamp_ntz").alias("at"))


@registry.add("newest_prepared_folder", "SELECT r_name AS folder FROM region ORDER BY r_regionkey DESC LIMIT 1")
def newest_prepared_folder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One manifest per region, dated by its key; the newest one is found from the files."""
    root = documents.fresh_dir(spark)
    regions = load(spark, sf_dir, "region").collect()
    for r in regions:
        documents.write_document(spark, f"{root}/{r['r_name']}/manifest.json", {"created_utc": f"2025-01-{r['r_regionkey'] + 1:02d}T00:00:00+00:00"})
    found = runs.newest(runs.prepared_manifests(spark, root), "folder", F.col("created"))
    return found.select(F.regexp_extract("folder", "([^/]+)$", 1).alias("folder"))


@registry.add("newest_prepared_by_name", "SELECT max(r_name) AS folder FROM region")
def newest_prepared_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One prepared folder per region, all made at one time; the last name is taken."""
    root = documents.fresh_dir(spark)
    names = [r[0] for r in load(spark, sf_dir, "region").select("r_name").collect()]
    for name in names:
        documents.write_document(spark, f"{root}/{name}/manifest.json", {"created_utc": "2025-01-01T00:00:00+00:00"})
    return spark.createDataFrame([(runs.latest_prepared_by_name(spark, root).rsplit("/", 1)[1],)], "folder string")


@registry.add(
    "typed_csv_fallback",
    "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%f') AS o_orderdate, o_orderpriority FROM orders",
)
def typed_csv_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A prepared folder without Parquet: numbers come back as numbers, times stay text."""
    folder = documents.fresh_dir(spark)
    tables.write_table(load(spark, sf_dir, "orders"), f"{folder}/cleaned.csv")
    return tables.read_prepared(spark, folder)
