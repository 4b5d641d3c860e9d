"""Benchmark items inside documents: size-partitioned MinHash containment search, verified exactly.

An item counts as found in a document that holds at least ``threshold`` of
its distinct word shingles, wherever they stand and however long the
document is. Items are partitioned by size (their number of shingles, in
powers of two). Of each item the MinHash sketch is kept that its partition's
upper bound u calls for: the ``u - ceil(threshold * u) + 1`` smallest hashes.
A document that holds the threshold of the item's shingles must hold one of
these, so a document that meets no sketch hash is left out without loss, as
a sampled signature of a long document would not allow. What meets one is a
candidate, and candidates are verified by counting equal shingles as text.
So documents have no sketch of their own, which departs from the usual search
among sketches of both sides.

Words are runs without white space, A-Z in lower case.

Defined cases: null and empty texts have no shingles and are never found or
contaminated; a text of fewer than ``size`` words has one shingle, the whole
sequence, so an item of fewer matches only documents equal to it; items of
equal text are all reported; repeated rows of a document are reported once;
a very long text is shingled whole; a null id is an id like any other; empty
tables give no rows; further columns of the inputs are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vertexloom.llm.common import checked_join, lower_ascii, salted_join, table, text_of, words, written

SIZE = 5
THRESHOLD = 0.8


def _slices(word_array: Column, size: int, of) -> Column:
    """``of`` applied to every run of ``size`` words; to the whole sequence if it is shorter."""
    n = F.size(word_array)
    ends = F.when(n >= size, F.sequence(F.lit(1), n - (size - 1))).when(n > 0, F.array(F.lit(1))).otherwise(F.array().cast("array<int>"))
    return F.transform(ends, lambda i: of(F.slice(word_array, i, F.lit(size))))


def _items(benchmark: DataFrame, item_id: str, text_col: str, size: int) -> DataFrame:
    split = benchmark.select(F.col(item_id).alias("item"), words(lower_ascii(text_of(F.col(text_col)))).alias("w"))
    return split.select("item", F.array_distinct(_slices(F.col("w"), size, lambda s: F.array_join(s, " "))).alias("shingles"), F.array_sort(F.array_distinct(_slices(F.col("w"), size, F.xxhash64))).alias("hashes")).withColumn("n", F.size("shingles")).filter("n > 0")


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text", size: int = SIZE, threshold: float = THRESHOLD) -> DataFrame:
    """Pairs of a document (its id and version, a hash of its text) and an item found in it, with the counts."""
    items = written(_items(benchmark, item_id, item_text, size), "decontam-items")
    upper = F.pow(F.lit(2), F.ceil(F.log2("n")))
    needed = F.least(F.col("n"), (upper - F.ceil(F.lit(threshold) * upper - F.lit(1e-9)) + 1).cast("int"))
    sketch = written(items.select("item", F.explode(F.slice("hashes", F.lit(1), needed)).alias("h")), "decontam-sketch")

    base = docs.select(F.col(id_col).alias("id"), text_of(F.col(text_col)).alias("text"))
    base = base.select("id", F.xxhash64("text").alias("version"), words(lower_ascii(F.col("text"))).alias("w"))
    met = base.select("id", "version", F.explode(_slices(F.col("w"), size, F.xxhash64)).alias("h"))
    candidates = written(salted_join(met, sketch, "h", "version").select("id", "version", "item").distinct(), "decontam-candidates")

    suspects = written(candidates.select("id", "version").distinct().select(F.col("id").alias("s_id"), F.col("version").alias("s_version")), "decontam-suspects")
    texts = checked_join(base, suspects, base["id"].eqNullSafe(suspects["s_id"]) & (base["version"] == suspects["s_version"]), "left_semi")
    held = texts.select("id", "version", F.explode(F.array_distinct(_slices(F.col("w"), size, lambda s: F.array_join(s, " ")))).alias("shingle"))
    wanted = written(items.select("item", "n", F.explode("shingles").alias("shingle")), "decontam-shingles")
    shared = salted_join(held, wanted, "shingle", "version").groupBy("id", "version", "item", "n").agg(F.countDistinct("shingle").alias("shared"))
    shared = shared.withColumnsRenamed({"id": "f_id", "version": "f_version", "item": "f_item"})
    both = candidates["id"].eqNullSafe(shared["f_id"]) & (candidates["version"] == shared["f_version"]) & candidates["item"].eqNullSafe(shared["f_item"])
    found = candidates.join(shared, both).filter(F.col("shared") >= F.lit(threshold) * F.col("n") - F.lit(1e-9))
    return found.select("id", "version", "item", F.col("n").cast("long").alias("n"), "shared")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents in which no item is found, with the columns they came with."""
    found = written(contaminated(docs, benchmark, id_col, text_col, **options).select(F.col("id").alias("__id"), F.col("version").alias("__version")).distinct(), "decontam-found")
    same = docs[id_col].eqNullSafe(found["__id"]) & (F.xxhash64(text_of(docs[text_col])) == found["__version"])
    return checked_join(docs, found, same, "left_anti")


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(F.col("id").alias("doc_id"), F.col("item").alias("item_id"), F.col("n").alias("n_shingles"), F.col("shared").alias("n_shared"), F.round(F.col("shared") / F.col("n"), 6).alias("containment"))


OP9_SQL = r"""
WITH t AS (
  SELECT 0 AS side, doc_id AS id, text FROM documents UNION ALL SELECT 1, item_id, text FROM benchmark),
w AS (
  SELECT side, id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM t),
s AS (
  SELECT side, id, unnest(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
         ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END)) AS s FROM w),
n AS (
  SELECT id, count(*) AS n FROM s WHERE side = 1 GROUP BY id)
SELECT d.id AS doc_id, b.id AS item_id, any_value(n) AS n_shingles, count(*) AS n_shared, round(count(*) / any_value(n), 6) AS containment
FROM s d JOIN s b ON d.s = b.s AND d.side = 0 AND b.side = 1 JOIN n ON n.id = b.id
GROUP BY d.id, b.id HAVING count(*) >= 0.8 * any_value(n) - 1e-9
"""
