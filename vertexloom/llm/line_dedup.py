"""Lines that many documents share, by levelled sorted runs of line hashes.

A line's key is the line without white space at its ends, A-Z in lower
case. Batches of documents arrive one after another. Each batch counts the
documents of every key, merge-anti-joins the runs of keys already known to
be frequent, and adds what is left as its own run. When a level holds
``fanout`` runs they are merged into one run of the next level; a key whose
summed count has reached the threshold moves to a run of frequent keys and
is never counted again. Runs are tables bucketed and sorted by the hash, so
that merging and anti-joining read them side by side; they lie in the shared
folder, and are deleted in the end, also if something fails.

Keys are compared by two 64-bit hashes. Counts are made per task before
they are shuffled, so a line of every document costs one row per task; they
stay with the frequent keys, so that lines of nearly every document are
joined where they are. Documents without a frequent line are told by a filter
of a fixed size and go through as they are; only the texts of the others are
joined with their lines' places, which shuffles them.

Defined cases: a null text is one empty line, as is an empty one; blank
lines have the empty key and always stay; a very long text, or one of very
many lines, is treated whole; each row counts as a document, repeated rows
too; a null id is an id like any other; an empty table gives no rows;
further columns of the input are ignored.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vertexloom.llm.common import SPACE, counted_join, delete, key_filter, let, lower_ascii, may_have, shared_path, table, text_of, written

MIN_DOCS = 10
FANOUT = 2
BATCHES = 4


def lines_of(text: Column) -> Column:
    return F.split(text_of(text), "\n", -1)


def line_key(line: Column) -> Column:
    return lower_ascii(F.btrim(line, F.lit(SPACE)))


def key_hash(key: Column) -> list[Column]:
    return [F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(1), key).alias("h2")]


def key_counts(docs: DataFrame, *by: Column, text_col: str = "text") -> DataFrame:
    """Documents of each key ``(h1, h2, n)``, for each value of ``by``."""
    keys = docs.select(*by, F.explode(F.array_distinct(F.transform(lines_of(F.col(text_col)), line_key))).alias("key")).filter("key != ''")
    hashed = keys.select(*keys.columns[:-1], *key_hash(F.col("key")))
    return hashed.groupBy(*hashed.columns).agg(F.count(F.lit(1)).alias("n"))


class LineRuns:
    """Levels of sorted runs ``(h1, h2, n)``, and runs of the keys found in ``min_docs`` documents or more.

    Runs are tables of the session's catalogue until ``close``.
    """

    def __init__(self, spark: SparkSession, min_docs: int = MIN_DOCS, fanout: int = FANOUT, buckets: int | None = None):
        self.spark, self.min_docs, self.fanout = spark, min_docs, fanout
        self.folder = shared_path(spark, "line-runs")
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[DataFrame]] = [[]]
        self.frequent: list[DataFrame] = []
        self.names: list[str] = []
        self.merges = 0

    def _run(self, rows: DataFrame) -> DataFrame:
        self.names.append(f"line_run_{uuid.uuid4().hex}")
        sorted_rows = rows.repartition(self.buckets, "h1", "h2").write.bucketBy(self.buckets, "h1", "h2").sortBy("h1", "h2")
        sorted_rows.option("path", f"{self.folder}/{self.names[-1]}").saveAsTable(self.names[-1])
        return self.spark.table(self.names[-1])

    def close(self) -> None:
        """Drop the runs; what ``frequent_keys`` gave stays."""
        for name in self.names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        delete(self.spark, self.folder)
        self.names, self.levels, self.frequent = [], [[]], []

    def add(self, docs: DataFrame, text_col: str = "text") -> None:
        """Count one batch's keys, without those known to be frequent, into a run of its own."""
        self.add_counts(key_counts(docs, text_col=text_col))

    def add_counts(self, counts: DataFrame) -> None:
        """As ``add``, of a batch that ``key_counts`` has counted."""
        for run in self.frequent:
            counts = counts.join(run.drop("n"), ["h1", "h2"], "left_anti")
        self.levels[0].append(self._run(counts))
        level = 0
        while len(self.levels[level]) >= self.fanout:
            runs, self.levels[level] = self.levels[level], []
            if level + 1 == len(self.levels):
                self.levels.append([])
            self.levels[level + 1].append(self._settle(self._merged(runs)))
            level += 1

    def _merged(self, runs: list[DataFrame]) -> DataFrame:
        """Runs joined side by side, their counts summed."""
        self.merges += 1
        out = runs[0]
        for run in runs[1:]:
            both = out.join(run.withColumnRenamed("n", "m"), ["h1", "h2"], "full")
            out = both.select("h1", "h2", (F.coalesce("n", F.lit(0)) + F.coalesce("m", F.lit(0))).alias("n"))
        return out

    def _settle(self, counts: DataFrame) -> DataFrame:
        """Move keys that have become frequent to a run of theirs, with their counts so far; a run of the rest."""
        run = self._run(counts)
        reached = run.filter(F.col("n") >= self.min_docs)
        self.frequent.append(self._run(reached))
        return run.filter(F.col("n") < self.min_docs)

    def frequent_keys(self) -> DataFrame:
        """Hashes of all keys found in ``min_docs`` documents or more, each once, with their number of documents when they reached it."""
        left = [run for level in self.levels for run in level]
        if len(left) > 1 or self.levels[0]:
            self.levels = [[], [self._settle(self._merged(left))]]
        found = self.frequent[0] if self.frequent else self.spark.createDataFrame([], "h1 long, h2 long, n long")
        for run in self.frequent[1:]:
            found = found.unionByName(run)
        return written(found, "line-frequent")


def drop_frequent_lines(docs: DataFrame, frequent: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: the id, n_lines, n_dropped and the text without frequent lines."""
    base = docs.select(F.col(id_col).alias("id"), text_of(F.col(text_col)).alias("text")).withColumn("version", F.xxhash64("text"))
    lines = base.select("id", "version", F.posexplode(F.transform(lines_of(F.col("text")), line_key)).alias("at", "key")).filter("key != ''")
    found = counted_join(lines.select("id", "version", "at", *key_hash(F.col("key"))), frequent, ["h1", "h2"], "inner", "n")
    hits = found.groupBy(F.col("id").alias("hit_id"), F.col("version").alias("hit_version")).agg(F.array_sort(F.collect_set("at")).alias("drop"))
    hits = written(hits, "line-hits")
    same = base["id"].eqNullSafe(hits["hit_id"]) & (base["version"] == hits["hit_version"])
    told = may_have(base, key_filter(hits, ["hit_version"]), ["version"])
    without = told.filter("not __may").select("*", *[F.lit(None).cast(hits.schema[c].dataType).alias(c) for c in hits.columns])
    rows = without.unionByName(told.filter("__may").join(hits, same, "left"))
    split = F.split("text", "\n", -1)
    # What stays are the runs of lines between those that go.
    ends = F.concat("drop", F.array(F.size(split)))
    starts = F.concat(F.array(F.lit(0)), F.transform("drop", lambda at: at + 1))
    runs = let(split, lambda lines: F.flatten(F.zip_with(starts, ends, lambda a, b: F.slice(lines, a + 1, b - a))))
    rows = rows.select("id", F.size(split).cast("long").alias("n_lines"), F.coalesce(F.size("drop"), F.lit(0)).alias("n_dropped"), F.when(F.col("drop").isNull(), F.col("text")).otherwise(F.array_join(runs, "\n")).alias("text"))
    return rows.select(F.col("id").alias(id_col), "n_lines", F.when(F.col("n_dropped") > 0, F.col("n_dropped")).otherwise(0).cast("long").alias("n_dropped"), "text")


def frequent_lines(docs: DataFrame, batches: int = BATCHES, id_col: str = "doc_id", text_col: str = "text", runs: LineRuns | None = None) -> DataFrame:
    """Hashes of the frequent keys of a table whose rows arrive in ``batches`` batches, dealt by a hash of the id; read and counted once."""
    spark, runs = docs.sparkSession, runs or LineRuns(docs.sparkSession)
    path = shared_path(spark, "line-batches")
    counts = key_counts(docs, F.pmod(F.xxhash64(id_col), F.lit(batches)).cast("int").alias("batch"), text_col=text_col)
    counts.write.partitionBy("batch").parquet(path)
    arrived = spark.read.schema(counts.schema).parquet(path)
    try:
        for k in range(batches):
            runs.add_counts(arrived.filter(F.col("batch") == k).drop("batch"))
        return runs.frequent_keys()
    finally:
        runs.close()


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rows = drop_frequent_lines(docs, frequent_lines(docs))
    return rows.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


OP10_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (
  SELECT r, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS i FROM d),
k AS (
  SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
f AS (
  SELECT key FROM k WHERE key <> '' GROUP BY key HAVING count(DISTINCT r) >= 10)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (f.key IS NOT NULL) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (f.key IS NULL), '')) AS kept_sha256
FROM k LEFT JOIN f ON k.key = f.key
GROUP BY r
"""
