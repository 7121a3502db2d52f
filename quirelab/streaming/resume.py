"""Incremental processing of page files: a file stream whose checkpoint replaces the search for finished pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..sources.pages import PAGE


def page_stream(spark: SparkSession, folder: str, per_batch: int = 1000) -> DataFrame:
    """Pages of new JSON files in a folder, as they arrive."""
    return spark.readStream.schema(PAGE).option("multiLine", True).option("maxFilesPerTrigger", per_batch).json(folder)


def process_new(spark: SparkSession, folder: str, step, out: str, checkpoint: str) -> None:
    """Apply `step` (DataFrame -> DataFrame) to page files not seen before and append the result; each file exactly once."""
    stream = step(page_stream(spark, folder)).writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
    stream.trigger(availableNow=True).start().awaitTermination()
