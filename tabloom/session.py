"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F


def build_session(app: str = "tabloom", *, master: str | None = None, **conf: str) -> SparkSession:
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if master is not None:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: spark.checkpoint.dir, or a new one on a local master."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not re.match(r"local($|\[)", spark.sparkContext.master):
        raise RuntimeError("Set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="tabloom-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


BROADCAST_ROWS = 100_000
TEXT_ROWS = 1_000
_written: list[str] = []


def stash(df: DataFrame, **options: str) -> DataFrame:
    """Write df to the shared folder and read it back, so its lineage ends and its rows are frozen."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tabloom-{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path)
    _written.append(path)
    return spark.read.schema(df.schema).parquet(path)


def new_folder(spark: SparkSession, name: str) -> str:
    """Path of a folder to be written in the shared folder, which drop_stashes removes."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _written.append(path)
    return path


def drop_stashes(spark: SparkSession) -> None:
    """Delete the intermediate tables of this session; call it once all results are saved."""
    while _written:
        target = spark._jvm.org.apache.hadoop.fs.Path(_written.pop())
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def text_batches(spark: SparkSession) -> None:
    """Rows go to Python workers in batches of at most TEXT_ROWS, from now on in this session.

    A batch stands whole in the executor and again in its worker, with buffers of up to twice its size; Spark's 10,000
    rows of whole texts are tens of MB, and there is a batch for each running task. A smaller setting stays.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= TEXT_ROWS:
        spark.conf.set(key, TEXT_ROWS)


def small_side(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A narrow table for the other side of a join: broadcast when it is counted to be small, else shuffled as usual."""
    kept = stash(df)
    return F.broadcast(kept) if kept.count() <= rows else kept


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
