"""The corpus pipeline: from raw documents to coded, deduplicated, decontaminated ones.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the stage
before it kept. All but the last return the columns of documents.

Defined cases of every stage: a null text counts as empty, and a null in
another column goes through as it is; an empty table gives no rows; a very
long text is treated whole; ties and repeated rows are said below for each
stage; columns beyond those of documents go along under their names in the
stages that filter, and are left out by the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vertexloom.llm import byte_bpe, decontaminate, exact_dedup, near_dedup, toxicity
from vertexloom.llm.common import collect_garbage, give_back, intermediates, table, written_alone


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labelled ones among them, doesn't predict to be toxic.

    Repeated rows go or stay together. Without labels of both kinds every
    document has the share of toxic labels as its score.
    """
    network = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    give_back()
    return toxicity.drop_toxic(docs, network)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal without white space, the longest original with the smallest id.

    Empty texts are equal. A null id comes after all others; of rows
    repeated whole one stays.
    """
    return exact_dedup.drop_exact(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a five-word Jaccard similarity of 0.8 or more, the one with the smallest id.

    SimHash fingerprints find the closest, prefixes of the shingle sets all
    others, and every link is verified. Rows that share the smallest id stay
    together, as do documents without an id that are linked to no other.
    """
    collect_garbage(spark)
    return near_dedup.drop_near(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found. Repeated rows go or stay together."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each text, none for an empty one, and whether they decode to it; a row for every row."""
    collect_garbage(spark)
    coded = byte_bpe.encode_checked(docs.select("doc_id", "lang", "source", "text"))
    return coded.select("doc_id", "lang", "source", "token_ids", F.size("token_ids").cast("long").alias("n_tokens"), "round_trip")


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_exact_copies),
    ("near dedup", drop_near_copies),
    ("decontamination", drop_leaks),
    ("byte-level BPE", encode),
]

#: SQL can't express trained scores, fingerprints or merges; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage's rows are written before the next reads them, and what it wrote besides is deleted."""
    docs, since = table(spark, sf_dir, "documents"), intermediates()
    for name, stage in STAGES[:-1]:
        docs = written_alone(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}", since)
    return STAGES[-1][1](spark, docs, sf_dir)
