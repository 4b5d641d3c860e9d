"""Token counts from pre-token frequencies, without token ids.

1. Each document's distinct pre-tokens and their frequencies are written.
2. The pieces of each distinct pre-token of the table are counted once (the
   tokenizers library gives them).
3. The two are joined by pre-token, and a document's count is the sum of
   frequency times pieces. The pre-tokens that most documents share, as many
   as may be broadcast, meet their documents where these are; only the pairs
   of rarer ones, of which each has few documents, are shuffled.

The split follows the file: texts are cut at its special strings, each of
which is one token; the rest is normalised (NFC, lower case) and split by
the file's pattern.

Defined cases: a null text counts as empty (0 bytes, 0 tokens); repeated
rows are counted alike; a very long text is split whole, and gives no more
pairs than it has distinct pre-tokens; a null id stays null; an empty table
gives no rows; further columns of the input are ignored.
"""

from __future__ import annotations

import json
import os
import unicodedata
from collections import Counter
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType

from vertexloom.llm.common import fits, give_back, small_batches, table, text_of, written

VOCABULARY = "word_bpe_49k.json"
LIMIT = 2048
ENCODED_TOGETHER = 8192
#: Pre-tokens are told apart by their number of documents in steps of a 16th of a power of two, to find how many may be broadcast.
STEPS = 16
#: Dictionary pages that hold the pre-tokens of many documents.
PAGES = {"parquet.dictionary.page.size": 16 << 20}


class PreTokens:
    """How a vocabulary file splits texts."""

    def __init__(self, vocabulary: bytes):
        rules = json.loads(vocabulary)
        steps = [n["type"] for n in rules["normalizer"]["normalizers"]]
        split, coding = rules["pre_tokenizer"]["pretokenizers"]
        if steps != ["NFC", "Replace", "Lowercase"] or (split["type"], split["behavior"], split["invert"], coding["use_regex"]) != ("Split", "Removed", True, False):
            raise ValueError("the tokenizer's normalizer or pre-tokenizer isn't one that this operator follows")
        replaced = rules["normalizer"]["normalizers"][1]
        if (replaced["pattern"], replaced["content"]) != ({"Regex": r"\s+"}, " "):
            raise ValueError("the tokenizer's normalizer replaces more than white space by a blank, which the split drops anyway")
        if any(t[k] for t in rules["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError("the tokenizer's special strings aren't matched as they stand")
        special = sorted((t["content"] for t in rules["added_tokens"]), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.split = regex.compile(split["pattern"]["Regex"]).findall

    def frequencies(self, text: str) -> tuple[int, Counter]:
        """Special strings of a text, and the frequency of each pre-token."""
        if self.special is None:
            return 0, self._frequencies(text)
        first, *more = self.special.split(text)
        frequency = self._frequencies(first)
        for part in more:
            frequency.update(self._frequencies(part))
        return len(more), frequency

    def _frequencies(self, text: str) -> Counter:
        # A letter is lowered by itself; str.lower() would look at what surrounds a capital sigma.
        return Counter(self.split(unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()))


def pre_tokens(docs: DataFrame, vocabulary: bytes, id_col: str, text_col: str) -> DataFrame:
    """Per document: __row, id, n_bytes, special, and the arrays piece and times; written."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    text = text_of(F.col(text_col))
    rows = docs.select(F.monotonically_increasing_id().alias("__row"), F.col(id_col).alias("id"), F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = PreTokens(shared.value)
        for batch in batches:
            special, ends, pieces, times = [], [0], [], []
            for text in batch.column(3):
                n, frequency = split.frequencies(text.as_py())
                special.append(n)
                pieces.extend(frequency)
                times.extend(frequency.values())
                ends.append(len(pieces))
            at = pa.array(ends, pa.int32())
            lists = [pa.ListArray.from_arrays(at, pa.array(pieces, pa.string())), pa.ListArray.from_arrays(at, pa.array(times, pa.int64()))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(special, pa.int64()), *lists], names=names)
        give_back()

    schema = rows.drop("text").schema.add("special", "long").add("piece", ArrayType(StringType())).add("times", ArrayType(LongType()))
    names = schema.names
    return written(rows.mapInArrow(run, schema), "token-pairs", **PAGES)


def piece_counts(pairs: DataFrame, vocabulary: bytes) -> DataFrame:
    """Each distinct pre-token with its number of documents and of pieces; written."""
    shared = pairs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        tokenizer = Tokenizer.from_str(shared.value.decode())
        for batch in batches:
            pieces, n = batch.column(0).to_pylist(), []
            for at in range(0, len(pieces), ENCODED_TOGETHER):
                n += map(len, tokenizer.encode_batch_fast(pieces[at : at + ENCODED_TOGETHER], add_special_tokens=False))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(n, pa.int64())], names=["piece", "docs", "n"])

    each = pairs.select(F.explode("piece").alias("piece")).groupBy("piece").agg(F.count(F.lit(1)).alias("docs"))
    return written(each.mapInArrow(run, "piece string, docs long, n long"), "token-pieces")


def _most_shared(pieces: DataFrame) -> int:
    """The least number of documents such that the pre-tokens with as many may all be broadcast."""
    step = F.floor(F.log2("docs") * STEPS).cast("int")
    held, least = 0, None
    # At most STEPS rows for each power of two.
    for row in pieces.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("k"), F.min("docs").alias("docs")).orderBy(F.desc("step")).collect():
        held += row.k
        if not fits(pieces.select("piece", "n"), held):
            break
        least = row.docs
    return least if least is not None else (1 << 62)


def token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, limit: int = LIMIT) -> DataFrame:
    """Per document: n_bytes, n_tokens and over_limit."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(VOCABULARY)
    vocabulary = Path(path).read_bytes()
    rows = pre_tokens(docs, vocabulary, id_col, text_col)
    pieces = piece_counts(rows, vocabulary)
    least = _most_shared(pieces)
    pairs = rows.select("__row", F.inline(F.arrays_zip("piece", "times")))
    shared, rare = F.broadcast(pieces.filter(F.col("docs") >= least).select("piece", "n")), pieces.filter(F.col("docs") < least).select("piece", "n")
    met = pairs.join(shared, "piece").groupBy("__row").agg(F.sum(F.col("times") * F.col("n")).alias("n"))
    if not rare.isEmpty():
        others = pairs.join(shared.select("piece"), "piece", "left_anti").join(rare, "piece")
        met = met.unionByName(others.groupBy("__row").agg(F.sum(F.col("times") * F.col("n")).alias("n")))
    counted = rows.select("__row", "id", "n_bytes", F.col("special").alias("n")).unionByName(met, allowMissingColumns=True)
    counted = counted.groupBy("__row").agg(F.first("id", True).alias(id_col), F.max("n_bytes").alias("n_bytes"), F.sum("n").alias("n_tokens")).drop("__row")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))
