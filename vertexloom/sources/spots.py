"""Spot files: CSV lines ``z,y,x,intensity,probability`` or ``y,x,intensity,probability`` under a dropped first line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vertexloom.sources.files import name_under
from vertexloom.sources.frames import frame_of


def parse_spots(files: DataFrame) -> DataFrame:
    """Spots of files ``file, value`` (whole texts). A projection of each file alone, so it takes streams too.

    The first line that isn't empty is dropped; then a line counts if it has
    four or five fields, all numbers; empty fields at a line's end don't count.
    """
    lines = F.filter(F.split("value", "\r?\n", -1), lambda line: F.trim(line) != "")
    each = files.select("file", F.posexplode(F.slice(lines, F.lit(2), F.greatest(F.size(lines) - 1, F.lit(0)))).alias("line", "text"))
    fields = each.withColumn("f", F.split(F.regexp_replace("text", r",+\s*$", ""), ",", -1)).filter(F.size("f").isin(4, 5))

    def field(i: int) -> Column:
        at = F.when(F.size("f") == 5, F.lit(i)).otherwise(F.lit(i - 1))
        return F.trim(F.get("f", at)).try_cast("double")

    z = F.when(F.size("f") == 5, F.trim(F.get("f", F.lit(0))).try_cast("double")).otherwise(F.lit(0.0))
    parsed = fields.select("file", frame_of(F.col("file")).alias("t"), F.col("line").alias("spot_ix"), field(2).alias("x"), field(1).alias("y"), z.alias("z"), field(3).alias("intensity"), field(4).alias("probability"))
    return parsed.dropna(subset=["x", "y", "z", "intensity", "probability"])


def read_spots(spark: SparkSession, path: str) -> DataFrame:
    """Spots of all CSV files under a folder, each named by its path there; spot_ix is the line's number, so it orders them and may have gaps."""
    files = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv").text(path, wholetext=True)
    return parse_spots(files.select(name_under(spark, path, F.col("_metadata.file_path")).alias("file"), "value"))
