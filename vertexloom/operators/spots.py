"""Operators on detected spots ``file, t, spot_ix, x, y, z, intensity, probability``."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def name_spots(spots: DataFrame) -> DataFrame:
    """Names from the spot's number in its file, from 1, padded to the digits of the file's count, and its two values."""
    file = Window.partitionBy("file")
    i, n = F.row_number().over(file.orderBy("spot_ix")).cast("string"), F.count(F.lit(1)).over(file).cast("string")
    return spots.withColumn("name", F.format_string("Point_%s_int:%.2f_prob:%.2f", F.lpad(i, F.length(n), F.lit("0")), "intensity", "probability"))


def spot_positions(spots: DataFrame) -> DataFrame:
    """Where a spot goes in an image stack: slice from 1, the one channel, the frame."""
    return spots.withColumns({"slice": (F.col("z") + 1).cast("int"), "channel": F.lit(1), "frame": F.col("t")})


def spot_counts(spots: DataFrame, files: DataFrame) -> DataFrame:
    """Spots of every file of the list; 0 and empty for those without any."""
    counted = spots.groupBy("file").agg(F.count(F.lit(1)).alias("n"))
    joined = files.select("file").distinct().join(counted, "file", "left")
    return joined.select("file", F.coalesce("n", F.lit(0)).cast("long").alias("n_spots"), F.col("n").isNull().alias("is_empty"))


def filter_detections(spots: DataFrame, threshold: float = -1) -> DataFrame:
    """Spots of at least this probability; -1 or less keeps all."""
    return spots if threshold <= -1 else spots.filter(F.col("probability") >= threshold)
