"""Region sets and transform chains kept as Parquet tables, sorted by set or chain.

A folder for each set would be millions of small files; sorted files let a
filter on sets or chains skip by the files' own statistics.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vertexloom.operators.transform import relink_chain


def _sorted(df: DataFrame, *keys: str) -> DataFrame:
    return df.repartitionByRange(*keys).sortWithinPartitions(*keys)


def write_rois(rois: DataFrame, vertices: DataFrame, path: str) -> None:
    """Regions without an index, and vertices without a place, are dropped."""
    _sorted(rois.dropna(subset=["set_id", "roi_ix"]), "set_id").write.parquet(f"{path}/rois")
    _sorted(vertices.dropna(subset=["set_id", "roi_ix", "x", "y"]), "set_id", "roi_ix").write.parquet(f"{path}/vertices")


def read_rois(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    rois = spark.read.parquet(f"{path}/rois").dropna(subset=["set_id", "roi_ix"])
    return rois, spark.read.parquet(f"{path}/vertices").dropna(subset=["set_id", "roi_ix"])


def write_chains(transforms: DataFrame, path: str, settings: DataFrame | None = None) -> None:
    """Chains as a table; ``settings`` (chain_id, step, settings, a map of strings) lie beside the transforms of their step, or alone where there is none."""
    if settings is None:
        rows = transforms.withColumn("settings", F.lit(None).cast("map<string,string>"))
    else:
        rows = transforms.join(settings.select("chain_id", "step", "settings"), ["chain_id", "step"], "full")
    _sorted(rows, "chain_id", "step").write.parquet(path)


def read_chains(spark: SparkSession, path: str) -> DataFrame:
    """Steps of each chain up to the first gap, linked anew."""
    return relink_chain(spark.read.parquet(path).filter("kind is not null").drop("settings"))


def read_chain_settings(spark: SparkSession, path: str) -> DataFrame:
    """Steps with the settings beside them: both are taken up to the first gap of their own, so a step may have settings alone (its kind is null) or none."""
    rows = spark.read.parquet(path)
    order = Window.partitionBy("chain_id").orderBy("step")
    settings = rows.filter("settings is not null").select("chain_id", "step", "settings", (F.row_number().over(order) - 1).alias("place"))
    return read_chains(spark, path).join(settings.filter("place = step").drop("place"), ["chain_id", "step"], "full")
