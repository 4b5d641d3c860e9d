"""Operators on series of section images ``path``."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def section_index(files: DataFrame) -> DataFrame:
    """The section's number from ``_s<digits>`` in the path; null without one."""
    return files.withColumn("section", F.nullif(F.regexp_extract("path", r"_s(\d+)", 1), F.lit("")).cast("int"))


def order_sections(files: DataFrame) -> DataFrame:
    """Place of each section in its series, from 0."""
    return files.withColumn("place", F.row_number().over(Window.partitionBy("series").orderBy("section", "path")) - 1)


def space_sections(files: DataFrame, thickness: float | None = None) -> DataFrame:
    """Depth of each section below the first, by its number; one unit apart without a thickness."""
    return files.withColumn("depth", (F.col("section") - F.min("section").over(Window.partitionBy("series"))) * F.lit(1.0 if thickness is None else float(thickness)))


def missing_sections(files: DataFrame) -> DataFrame:
    """Numbers between a series' first and last that have no section."""
    ends = files.groupBy("series").agg(F.min("section").alias("a"), F.max("section").alias("b")).filter("a is not null")
    every = ends.select("series", F.explode(F.sequence("a", "b")).alias("section"))
    return every.join(files.select("series", "section"), ["series", "section"], "left_anti")
