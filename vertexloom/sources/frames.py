"""Catalogue of frame files ``<title>-t<frame>.<ext>`` and of what tools have made of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vertexloom.sources.files import name_under

#: Ends of file names and the roles that they mean; others are inputs.
ROLES = (("_cp_masks.tif", "mask"), ("_cp_outlines.txt", "outline"), (".stardist.tif", "star_mask"), (".csv", "spots"))


def frame_of(name: Column) -> Column:
    """The frame from the first ``-t<digits>`` of a file name; 0 without one. Folders before the name don't count."""
    return F.coalesce(F.nullif(F.regexp_extract(name, r"-t(\d+)[^/]*$", 1), F.lit("")).cast("int"), F.lit(0))


def catalogue(files: DataFrame) -> DataFrame:
    """Title, frame and role of files ``file``."""
    role = F.lit("input")
    for end, name in reversed(ROLES):
        role = F.when(F.col("file").endswith(end), name).otherwise(role)
    return files.withColumns({"title": F.regexp_extract("file", r"^(.*?)(?:-t\d+[^/]*|\.[^./]*)$", 1), "t": frame_of(F.col("file")), "role": role})


def list_frames(spark: SparkSession, path: str) -> DataFrame:
    """The files under a folder that aren't empty, named by their path there, with size and time; contents aren't read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return catalogue(files.select(name_under(spark, path, F.col("path")).alias("file"), "path", "length", "modificationTime"))


def match_outputs(frames: DataFrame, roles: tuple[str, ...] = ("mask",)) -> DataFrame:
    """Each input frame with each role it should have an output of, and whether there is one."""
    wanted = frames.filter("role = 'input'").select("title", "t").distinct().withColumn("role", F.explode(F.array(*[F.lit(r) for r in roles])))
    made = frames.filter("role != 'input'").groupBy("title", "t", "role").agg(F.count(F.lit(1)).alias("n"))
    return wanted.join(made, ["title", "t", "role"], "left").select("title", "t", "role", F.when(F.col("n").isNull(), "missing").otherwise("found").alias("status"))
