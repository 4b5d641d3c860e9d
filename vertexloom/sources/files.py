"""Named text files: what other programs read, written by tasks."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vertexloom.functions.settle import place_for_workers, settled


def name_under(spark: SparkSession, path: str, file: Column) -> Column:
    """What a file's URI is called under a path that was read: folders count, so that files of one name in two folders stay two. Where the path is the file itself, or a pattern, it is the name behind the pattern's last whole folder."""
    fixed = path
    for mark in "*?[{":
        fixed = fixed.partition(mark)[0]
    place = spark._jvm.org.apache.hadoop.fs.Path(fixed if fixed == path else fixed.rpartition("/")[0] or "/")
    uri = place.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(place).toUri()
    own = F.regexp_replace(file, "^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "")
    name = F.element_at(F.split(own, "/"), -1)
    out = name
    for root in dict.fromkeys((str(uri.getRawPath()), str(uri.getPath()))):
        root = root.rstrip("/") + "/"
        out = F.when(F.startswith(own, F.lit(root)), F.substring(own, F.lit(len(root) + 1), F.length(own))).otherwise(out)
    return out


def write_files(files: DataFrame, folder: str) -> DataFrame:
    """Write each text of ``file, value`` under its name, which may have folders in it; gives ``file, length`` of what was written.

    A name that is written again, as after a lost task, gets the same text.
    The folder is on a file system that workers can open by its URI.
    """
    place = place_for_workers(files.sparkSession, folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        target, root = fs.FileSystem.from_uri(place)
        made = set()
        for batch in batches:
            lengths = []
            for name, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                data, parent = (value.as_py() or "").encode(), f"{root}/{name}".rpartition("/")[0]
                if parent not in made:
                    target.create_dir(parent, recursive=True)
                    made.add(parent)
                with target.open_output_stream(f"{root}/{name}") as out:
                    out.write(data)
                lengths.append(len(data))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lengths, pa.int64())], names=["file", "length"])

    return settled(files.select("file", "value").mapInArrow(run, "file string, length long"))
