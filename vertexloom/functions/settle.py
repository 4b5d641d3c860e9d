"""Intermediate tables of iterative operators, and tasks as small as the session asks for."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession, name: str) -> str:
    """A new path in the folder that the session names in spark.checkpoint.dir; on this machine only for a local session that names none."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="vertexloom-")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


#: Hadoop's schemes, and those of pyarrow's file systems that open the same places.
SCHEMES = {"file": "file", "hdfs": "hdfs", "viewfs": "viewfs", "s3": "s3", "s3a": "s3", "s3n": "s3", "gs": "gs", "gcs": "gcs", "abfs": "abfs", "abfss": "abfss"}


def place_for_workers(spark: SparkSession, path: str) -> str:
    """A folder's URI as pyarrow opens it in workers: one without a scheme is on Spark's default file system, not on each worker's disk; a scheme that pyarrow can't open raises here."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    if place.toUri().getScheme() is None:
        place = place.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(place)
    uri = place.toUri()
    scheme = str(uri.getScheme())
    if scheme not in SCHEMES:
        raise ValueError(f"workers can't write named files to {path}: none of their file systems opens {scheme}:, only {', '.join(sorted(SCHEMES))}")
    return f"{SCHEMES[scheme]}://{uri.getAuthority() or ''}{uri.getPath()}"


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """Rows of equal keys in one task, in exactly as many tasks as the session has shuffle partitions: what adaptive execution put together would be sorted several times over in one task's memory."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def settled(df: DataFrame) -> DataFrame:
    """``df`` written to the folder that the session names in spark.checkpoint.dir and read again.

    Lineage ends there and lost executors cost nothing.
    """
    spark = df.sparkSession
    path = folder(spark, "settled")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
