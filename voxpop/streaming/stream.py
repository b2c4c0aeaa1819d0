"""Streaming use of the stateless projections.

The study has no stream source or stateful operator; its feature and class
projections are row-wise, so the same functions apply unchanged to a
Structured Streaming DataFrame (no watermark or state needed).  A fitted
``PipelineModel`` can also score a stream with ``model.transform``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from voxpop.operators.features import processed
from voxpop.schema import ORDERS_NPS_SCHEMA


def read_orders_stream(spark: SparkSession, path: str, fmt: str = "parquet",
                       max_files_per_trigger: int | None = None) -> DataFrame:
    """Order-level rows arriving as files, with the declared schema."""
    r = spark.readStream.schema(ORDERS_NPS_SCHEMA).format(fmt)
    if fmt == "csv":
        r = r.option("header", True)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def processed_stream(stream: DataFrame, rule: str = "floor") -> DataFrame:
    """The 26-column processed view of a stream (same code as batch)."""
    return processed(stream, rule)


def score_stream(model, stream: DataFrame) -> DataFrame:
    """Apply a fitted pipeline to a stream (stateless transform)."""
    return model.transform(stream)
