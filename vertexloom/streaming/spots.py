"""Spot files read as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vertexloom.sources.files import name_under
from vertexloom.sources.spots import parse_spots


def stream_spots(spark: SparkSession, path: str, files_per_trigger: int = 1000) -> DataFrame:
    """A stream of the spots of CSV files that appear in a folder; parsing is by file, so no state is kept."""
    files = spark.readStream.format("text").option("wholetext", True).option("pathGlobFilter", "*.csv").option("maxFilesPerTrigger", files_per_trigger).load(path)
    return parse_spots(files.select(name_under(spark, path, F.col("_metadata.file_path")).alias("file"), "value"))
