"""Scoring a stream with a saved model. Cleaning, features and scoring keep no state, so the batch code serves."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tabloom.operators.features import FeatureConfig
from tabloom.plans.learn import score


def score_stream(model: PipelineModel, events: DataFrame, config: FeatureConfig, classes: Sequence[str], *, output: str, checkpoint: str) -> StreamingQuery:
    """Append predictions of a streaming table to a Parquet folder, once per available input."""
    writer = score(model, events, config, classes).writeStream.format("parquet").outputMode("append")
    return writer.option("path", output).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
