"""Point files: transformed points read, plain points written."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vertexloom.sources.files import name_under

#: The fields of a line of transformed points.
FIELDS = ("InputIndex", "InputPoint", "OutputIndexFixed", "OutputPoint", "Deformation")


def parse_transformed_points(lines: DataFrame) -> DataFrame:
    """Points of lines ``file, value``: input, output and deformation, of any dimension; other lines are dropped."""

    def numbers(name: str) -> Column:
        inside = F.regexp_extract("value", rf"{name}\s*=\s*\[([^\]]*)\]", 1)
        return F.transform(F.split(F.trim(inside), r"\s+"), lambda v: v.try_cast("double"))

    found = lines.filter(F.col("value").rlike(r"^\s*Point\s+\d+\s*;"))
    number = F.regexp_extract("value", r"^\s*Point\s+(\d+)", 1).cast("long")
    rows = found.select("file", number.alias("point_ix"), numbers("InputPoint").alias("input"), numbers("OutputPoint").alias("output"), numbers("Deformation").alias("deformation"))
    return rows.filter(F.get("output", F.lit(1)).isNotNull())


def read_transformed_points(spark: SparkSession, path: str) -> DataFrame:
    """Points of the files under a path; a file is named by its path there."""
    lines = spark.read.option("recursiveFileLookup", True).text(path)
    return parse_transformed_points(lines.select(name_under(spark, path, F.col("_metadata.file_path")).alias("file"), "value"))


def points_text(points: DataFrame) -> DataFrame:
    """The text of each set's point file: ``point``, the number, a line of tab-separated coordinates for each point."""
    line = F.array_join(F.transform("pos", lambda v: v.cast("string")), "\t")
    sets = points.groupBy("set_id").agg(F.array_sort(F.collect_list(F.struct("point_ix", line.alias("line")))).alias("rows"))
    head = F.array(F.lit("point"), F.size("rows").cast("string"))
    return sets.select("set_id", F.array_join(F.concat(head, F.transform("rows", lambda r: r["line"])), "\n").alias("value"))


def write_points(points: DataFrame, path: str) -> None:
    """One folder for each set, with its point file."""
    points_text(points).repartition("set_id").write.partitionBy("set_id").text(path)
