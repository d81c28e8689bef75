"""Small JSON documents (configs, class maps, manifests, metrics) and folder checks on any Hadoop path."""

from __future__ import annotations

import json
import uuid
from datetime import datetime, timezone
from typing import Any

from pyspark.sql import DataFrame, SparkSession, functions as F

from tabloom.operators.features import FeatureConfig
from tabloom.session import shared_dir

# Fixed value: file name of the class map in a prepared folder.
CLASSES_FILE = "attack_type_classes.json"


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def glob_exists(spark: SparkSession, pattern: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    return bool(target.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(target))


def fresh_dir(spark: SparkSession, prefix: str = "run") -> str:
    return f"{shared_dir(spark)}/{prefix}-{uuid.uuid4().hex}"


def utc_now_iso() -> str:
    return datetime.now(timezone.utc).isoformat(timespec="seconds")


def run_stamp() -> str:
    return datetime.now(timezone.utc).strftime("%Y%m%d_%H%M%S")


def write_document(spark: SparkSession, path: str, payload: dict[str, Any]) -> None:
    spark.createDataFrame([(json.dumps(payload),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def read_document(spark: SparkSession, path: str) -> dict[str, Any]:
    if not path_exists(spark, path):
        raise FileNotFoundError(path)
    return json.loads(spark.read.text(path, wholetext=True).first()[0])


CONFIG_SCHEMA = "target_col string, row_id_col string, drop_cols array<string>, transform struct<timestamp_cols: array<string>, port_cols: array<string>>, broken string"


def read_config(spark: SparkSession, path: str) -> FeatureConfig:
    """Feature config document; absent keys get their defaults, a missing target or wrong shape is an error."""
    if not path_exists(spark, path):
        raise FileNotFoundError(path)
    reader = spark.read.schema(CONFIG_SCHEMA).option("multiLine", True).option("columnNameOfCorruptRecord", "broken")
    none = F.array().cast("array<string>")
    lists = {"drop_cols": F.col("drop_cols"), "timestamp_cols": F.col("transform.timestamp_cols"), "port_cols": F.col("transform.port_cols")}
    found = reader.json(path).select("target_col", F.coalesce("row_id_col", F.lit("row_id")).alias("row_id_col"), *(F.coalesce(c, none).alias(k) for k, c in lists.items()), "broken").first()
    if found is None or found["broken"] is not None or found["target_col"] is None:
        raise ValueError(f"{path} is no feature config: it needs a target_col, lists of column names and an object of transforms")
    return FeatureConfig(found["target_col"], found["row_id_col"], *(tuple(found[k]) for k in lists))


def class_map_document(target: str, classes: list[str]) -> dict[str, Any]:
    return {"target": target, "classes": classes, "class_to_index": {c: i for i, c in enumerate(classes)}}


def read_class_map(spark: SparkSession, path: str) -> DataFrame:
    """One row: target, classes, class_to_index."""
    if not path_exists(spark, path):
        raise FileNotFoundError(path)
    return spark.read.schema("target string, classes array<string>, class_to_index map<string,int>").option("multiLine", True).json(path)


def document_rows(spark: SparkSession, pattern: str) -> DataFrame:
    """(path, modified, body) of every document that matches the pattern."""
    files = spark.read.format("binaryFile").load(pattern)
    return files.select("path", F.col("modificationTime").alias("modified"), F.col("content").cast("string").alias("body"))
