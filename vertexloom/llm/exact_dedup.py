"""Exact duplicates by progressive refinement: length, then prefix hash, then full hash.

Texts are equal when identical without white space. Each level narrows the
rows that the next one looks at:

1. the number of code points of the normalised text: rows of a length that
   no other row has are done,
2. a hash of its first code points, among the rows that are left,
3. SHA-256 of the whole, among the rows that share both.

Levels 1 and 2 join thin rows (numbers, lengths, hashes) with counted keys,
whatever their number; keys with very many rows are joined where their rows
are. The texts that level 3 hashes are found in place, by a filter of a fixed
size that has a bit for each shared pair of length and prefix: it lets all of
them pass, and few others as long as shared pairs are few against its bits,
which the thin rows then sort out. Texts are never shuffled to find copies.

Defined cases: a null text counts as empty; a null id sorts after every
other id; of rows repeated whole, one stays; a very long text is one row
like any other, hashed whole; an empty table gives no rows; columns of the
input that have the name of a result don't disturb it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vertexloom.llm.common import checked_join, counted_join, key_filter, may_have, table, text_of, without_space, written

PREFIX = 64


def _read(docs: DataFrame, id_col: str, text_col: str, prefix: int, carry: list[str], digest_all: bool) -> DataFrame:
    """One pass over the texts, written: ``carry``, __row, __id, __n, __len, the prefix's hash and, if all rows are to have it, the digest."""
    text = text_of(F.col(text_col))
    base = docs.select(*carry, F.col(id_col).alias("__id"), F.length(text).alias("__n"), without_space(text).alias("__norm"))
    digest = [F.sha2(F.col("__norm"), 256).alias("__sha")] if digest_all else []
    return written(base.select(*carry, F.monotonically_increasing_id().alias("__row"), "__id", "__n", F.length("__norm").alias("__len"), F.xxhash64(F.substring("__norm", 1, prefix)).alias("__prefix"), *digest), "dedup-read")


def _shared(rows: DataFrame, on: list[str], name: str) -> DataFrame:
    """Keys of two rows or more, with their number, written."""
    return written(rows.groupBy(*on).agg(F.count(F.lit(1)).alias("__rows")).filter("__rows > 1"), name)


def refined(read: DataFrame, text_col: str | None) -> tuple[DataFrame, DataFrame]:
    """The written rows that levels 1 and 2 leave, and those of level 3 with their digest ``__sha``, which is computed from ``text_col`` for them alone or, without it, is there."""
    thin = ["__row", "__id", "__n", "__len", "__prefix"]
    lengths = _shared(read.select("__len"), ["__len"], "dedup-lengths")
    first = counted_join(read.select(*thin), lengths, ["__len"], "inner", "__rows")
    pairs = _shared(first.select("__len", "__prefix"), ["__len", "__prefix"], "dedup-prefixes")
    if text_col is None:
        left = counted_join(read.select(*thin, "__sha"), pairs, ["__len", "__prefix"], "inner", "__rows")
        return first, written(left, "dedup-left")
    passed = may_have(read.select(*thin, text_of(F.col(text_col)).alias("__text")), key_filter(pairs, ["__len", "__prefix"]), ["__len", "__prefix"]).filter("__may")
    hashed = written(passed.select(*thin, F.sha2(without_space(F.col("__text")), 256).alias("__sha")), "dedup-hashed")
    return first, written(counted_join(hashed, pairs, ["__len", "__prefix"], "inner", "__rows"), "dedup-left")


def _groups(left: DataFrame) -> DataFrame:
    """Groups of two rows or more among those of level 3: their size and the row that stays, written."""
    order = F.struct((-F.col("__n")).alias("n"), F.col("__id").isNull().alias("no_id"), F.col("__id").alias("id"), F.col("__row").alias("row"))
    groups = left.groupBy("__len", "__prefix", "__sha").agg(F.count(F.lit(1)).alias("__size"), F.min(order).alias("__first"))
    groups = groups.filter("__size > 1").select("__len", "__prefix", "__sha", "__size", F.col("__first.id").alias("__keep"), F.col("__first.row").alias("__stays"), F.col("__size").alias("__rows"))
    return written(groups, "dedup-groups")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prefix: int = PREFIX) -> DataFrame:
    """One row per document: the id, keep_id, group_size, kept, text_sha256.

    The row with the most code points in its original text stays, then the
    one with the smallest id. All rows have a digest, made as their text is
    read; those that levels 1 and 2 rule out are compared by it with none.
    """
    read = _read(docs, id_col, text_col, prefix, [], True)
    groups = _groups(refined(read, None)[1])
    alone = F.col("__size").isNull()
    return counted_join(read, groups, ["__len", "__prefix", "__sha"], "left", "__rows").select(
        F.col("__id").alias(id_col),
        F.when(alone, F.col("__id")).otherwise(F.col("__keep")).alias("keep_id"),
        F.coalesce("__size", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("__row") == F.col("__stays"))).alias("kept"),
        F.col("__sha").alias("text_sha256"),
    )


def drop_exact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stay, with the columns they came with.

    The numbers of the rows that go are found first; the documents are read
    once more without them, and are shuffled, by number, only where those
    are too many to broadcast.
    """
    names = [f"__in_{i}" for i in range(len(docs.columns))]
    key, body = names[docs.columns.index(id_col)], names[docs.columns.index(text_col)]
    read = _read(docs.toDF(*names), key, body, PREFIX, names, False)
    left = refined(read, body)[1]
    gone = counted_join(left.select("__row", "__len", "__prefix", "__sha"), _groups(left).select("__len", "__prefix", "__sha", "__stays", "__rows"), ["__len", "__prefix", "__sha"], "inner", "__rows")
    gone = written(gone.filter("__row != __stays").select("__row"), "dedup-gone")
    kept = checked_join(read, gone, "__row", "left_anti")
    return kept.select(*[F.col(n).alias(c) for c, n in zip(docs.columns, names, strict=True)])


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))


OP7_SQL = r"""
WITH n AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         sha256(translate(coalesce(text, ''), chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '')) AS text_sha256
  FROM documents),
r AS (
  SELECT *, row_number() OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id NULLS LAST) AS rn,
         first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id NULLS LAST) AS keep_id,
         count(*) OVER (PARTITION BY text_sha256) AS group_size
  FROM n)
SELECT doc_id, keep_id, group_size, rn = 1 AS kept, text_sha256 FROM r
"""
