"""What the corpus operators share: tables, the shared folder, ASCII text rules, checked joins."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, StringType

#: The white space of every rule here, as characters and as a class of patterns.
SPACE = " \t\n\x0b\f\r"
SPACE_CLASS = r"[\x20\x09-\x0D]"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: A side of a join is broadcast up to so many bytes: its rows, counted beforehand, times what its columns take at most.
BROADCAST_BYTES = 32 << 20
COLUMN_BYTES, WIDE_COLUMN_BYTES = 16, 120
#: Keys with more than one in so many of the rows of a join, or one in as many as it has partitions if these are more, are hot; there are fewer than this many of them.
HOT_KEYS = 200
#: Tasks among which the rows of one key are dealt where keys can't be counted first; more where there are over 16 times as many partitions.
SALTS = 16

#: Bits of a filter of keys and of each of its pieces; all of it takes 16 MB however many keys there are.
FILTER_BITS, PIECE_BITS = 1 << 27, 1 << 15

BATCH_SETTING, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "4m"
#: How Spark writes the setting's default.
BATCH_DEFAULTS = ("67108864b", "64MB", "64m")

_own_dir: list[str] = []
_made: list[str] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The cluster's folder for intermediate tables; one of this machine's only for a local session that names none."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not _own_dir:
        _own_dir.append("file://" + tempfile.mkdtemp(prefix="vertexloom-"))
    return _own_dir[0]


def shared_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _made.append(path)
    return path


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of a few MB for this session, unless it has a size of its own: workers hold a batch of texts and what they make of it at once."""
    if spark.conf.get(BATCH_SETTING) in BATCH_DEFAULTS:
        spark.conf.set(BATCH_SETTING, BATCH_BYTES)


def give_back() -> None:
    """At a task's end in a Python worker: memory goes back to the machine, as the worker stays for later tasks."""
    import ctypes
    import gc

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def collect_garbage(spark: SparkSession) -> None:
    """Executors collect what earlier work has left in their heaps, so that these give memory back before workers that need much of their own start; a few short tasks for each of their cores."""
    tasks = 4 * spark.sparkContext.defaultParallelism
    spark.range(0, tasks, 1, tasks).selectExpr("java_method('java.lang.System', 'gc')").write.format("noop").mode("overwrite").save()


def written(df: DataFrame, name: str, **options) -> DataFrame:
    """``df`` written to the shared folder and read again: lineage ends, and a lost executor costs nothing."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def delete(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def intermediates() -> int:
    """How many intermediate tables there are by now, for ``written_alone``."""
    return len(_made)


def written_alone(df: DataFrame, name: str, since: int) -> DataFrame:
    """``df`` written, and the intermediate tables that were made after the first ``since`` deleted."""
    spark, out = df.sparkSession, written(df, name)
    for path in _made[since:-1]:
        delete(spark, path)
    del _made[since:-1]
    return out


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def fits(df: DataFrame, rows: int) -> bool:
    """Whether so many rows of the table may be broadcast."""
    return rows * sum(WIDE_COLUMN_BYTES if isinstance(f.dataType, (ArrayType, StringType, BinaryType)) else COLUMN_BYTES for f in df.schema) <= BROADCAST_BYTES


def checked_join(left: DataFrame, right: DataFrame, on, how: str) -> DataFrame:
    """Join with a written table of thin rows: broadcast if its counted rows allow it, shuffled otherwise. For keys of which ``left`` has few rows each."""
    return left.join(F.broadcast(right) if fits(right, right.count()) else right, on, how)


def counted_join(left: DataFrame, right: DataFrame, on: list[str], how: str, count: str) -> DataFrame:
    """Inner or left join with a written table of distinct keys whose column ``count`` says how many rows of ``left`` have each at most.

    A small table is broadcast. Of a larger one the hot keys are, and their
    rows stay where they are; only rows of other keys are shuffled.
    """
    n, total = right.agg(F.count(F.lit(1)), F.sum(count)).first()
    thin = right.drop(count)
    if fits(thin, n):
        return left.join(F.broadcast(thin), on, how)
    is_hot = F.col(count) * max(HOT_KEYS, partitions(left.sparkSession)) > F.lit(total)
    hot, others = F.broadcast(right.filter(is_hot).drop(count)), right.filter(~is_hot).drop(count)
    return left.join(hot, on).unionByName(left.join(hot.select(*on), on, "left_anti").join(others, on, how))


def salted_join(left: DataFrame, right: DataFrame, on: str, salt_by: str) -> DataFrame:
    """Inner join with a written table of thin rows, of which ``left`` may have very many for one key: broadcast, or else every key's rows dealt by ``salt_by``."""
    if fits(right, right.count()):
        return left.join(F.broadcast(right), on)
    salts = max(SALTS, partitions(left.sparkSession) // 16)
    several = right.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.withColumn("__salt", F.pmod(F.xxhash64(salt_by), F.lit(salts)).cast("int")).join(several, [on, "__salt"]).drop("__salt")


def _bit(keys: list[str]) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(FILTER_BITS))


def key_filter(keys: DataFrame, on: list[str]) -> DataFrame:
    """A bit for every key of a table, by hash, in pieces of 32-bit words: written, of a fixed size at most."""
    bits = keys.select(_bit(on).alias("bit")).select(F.floor(F.col("bit") / PIECE_BITS).alias("__piece"), (F.col("bit") % PIECE_BITS).alias("at"))
    pieces = bits.groupBy("__piece").agg(F.bitmap_construct_agg("at").alias("bits"))
    words = F.transform(F.sequence(F.lit(0), F.lit(PIECE_BITS // 32 - 1)), lambda k: F.conv(F.hex(F.substr(F.col("bits"), 4 * k + 1, F.lit(4))), 16, 10).cast("long"))
    signed = F.transform(words, lambda w: F.when(w >= 1 << 31, w - (1 << 32)).otherwise(w).cast("int"))
    return written(pieces.select("__piece", signed.alias("__words")), "key-filter")


def may_have(rows: DataFrame, keys: DataFrame, on: list[str], column: str = "__may") -> DataFrame:
    """Rows with whether their key may be in the filter ``keys``; it surely isn't where not. No row moves."""
    bit = rows.withColumn("__bit", _bit(on)).withColumn("__piece", F.floor(F.col("__bit") / PIECE_BITS))
    at = F.col("__bit") % PIECE_BITS
    # A word's first byte has its highest eight bits.
    shift = (24 - F.call_function("div", at % 32, F.lit(8)) * 8 + at % 8).cast("int")
    is_set = F.call_function("shiftrightunsigned", F.get("__words", F.call_function("div", at, F.lit(32)).cast("int")), shift).bitwiseAND(F.lit(1)) == 1
    return bit.join(F.broadcast(keys), "__piece", "left").withColumn(column, F.coalesce(is_set, F.lit(False))).drop("__bit", "__piece", "__words")


def rows_among(rows: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """Rows whose key is in a written table of distinct keys and, where that is too large to broadcast, few others. No row moves."""
    if fits(keys.select(on), keys.count()):
        return rows.join(F.broadcast(keys.select(on)), on, "left_semi")
    return may_have(rows, key_filter(keys, [on]), [on]).filter("__may").drop("__may")


def rows_without(rows: DataFrame, gone: DataFrame, on: str, maybe_null: str) -> DataFrame:
    """Rows whose two columns, the second of which may be null, aren't in a written table: that is broadcast, or else only rows that a filter of ``on`` lets pass are shuffled."""
    other = gone.select(F.col(on).alias("__on"), F.col(maybe_null).alias("__maybe"))
    found = (F.col(on) == F.col("__on")) & F.col(maybe_null).eqNullSafe(F.col("__maybe"))
    if fits(gone, gone.count()):
        return rows.join(F.broadcast(other), found, "left_anti")
    marked = may_have(rows, key_filter(gone, [on]), [on])
    return marked.filter("not __may").drop("__may").unionByName(marked.filter("__may").drop("__may").join(other, found, "left_anti"))


def let(value: Column, body) -> Column:
    """``body(value)`` with the value evaluated once: inside lambdas an expression is evaluated for each element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def text_of(column: Column) -> Column:
    return F.coalesce(column, F.lit(""))


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case and nothing else; all-ASCII texts take the built-in's fast path."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def without_space(text: Column) -> Column:
    return F.translate(text, SPACE, "")


def words(text: Column) -> Column:
    """Runs without white space, as an array; none for an empty text."""
    stripped = F.btrim(text, F.lit(SPACE))
    return F.when(stripped == "", F.array().cast("array<string>")).otherwise(F.split(stripped, f"{SPACE_CLASS}+", -1))
