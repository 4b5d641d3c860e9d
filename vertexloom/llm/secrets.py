"""Secret scans with an incremental ledger of blobs.

Every version of a path is content-addressed: its blob is the SHA-256 of its
text. The ledger holds, for each blob and each version of a rule that was
run on it, the spans found (an empty list too, which says that it was
scanned). A scan takes the distinct blobs of the paths it is given, leaves
out the pairs of blob and rule version that the ledger has, runs only the
others, and appends their rows. Findings of all paths, old and new, come
from joining paths to the ledger by blob.

Spans are found with built-in functions: the pieces between the matches
(``split``) and the matches (``regexp_extract_all``) alternate, so running
sums of their lengths give the places, in code points, end exclusive. The
sums are taken in blocks and then over the blocks, so that a text with very
many matches is no slower by the match.

Texts stay where they are: what is joined to them is the thin list of the
copies to scan, or of those to pass over, whichever is shorter.

Defined cases: a null text counts as empty; repeated rows and equal texts
are one blob and all get its findings; a very long text is one blob, scanned
whole; a null id is a path like any other; an empty table gives no rows;
further columns of the input are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vertexloom.llm.common import counted_join, fits, let, shared_path, table, text_of, written


@dataclass(frozen=True)
class Rule:
    """A kind of secret: the pattern, and the length that the group must have to count; a new version scans anew.

    ``scan`` may be a pattern that matches exactly the matches that are long
    enough: a run of one class of characters is as long as it gets, and
    where it is too short nothing inside it is long enough.
    """

    kind: str
    pattern: str
    least: int
    group: int = 0
    version: int = 1
    scan: str | None = None


#: The base rules, in the order that ties between spans follow.
RULES = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 12, 2),
    Rule("access", r"AKIA[A-Z0-9]+", 18, scan=r"AKIA[A-Z0-9]{14,}"),
    Rule("hex", r"[0-9a-f]+", 16, scan=r"[0-9a-f]{16,}"),
)

LEDGER = "blob string, kind string, version int, spans array<struct<start:int,end:int>>"
SPANS = "array<struct<start:int,end:int>>"


def _placed(parts: Column) -> Column:
    """(start, end, held) of each part (gap, size, held): running sums in blocks of about the square root of their number, then over the blocks."""
    places = "array<struct<start:int,end:int,held:int>>"

    def step(state: Column, part: Column) -> Column:
        begin = state["at"] + part["gap"]
        place = F.struct(begin.alias("start"), (begin + part["size"]).alias("end"), part["held"].alias("held"))
        return F.struct((begin + part["size"]).alias("at"), F.concat(state["out"], F.array(place)).alias("out"))

    def block_step(state: Column, block: Column) -> Column:
        return F.struct((state["at"] + block["at"]).alias("at"), F.concat(state["out"], F.array(state["at"])).alias("out"))

    def summed(parts: Column) -> Column:
        wide = F.ceil(F.sqrt(F.size(parts).cast("double"))).cast("int")
        blocks = F.transform(F.sequence(F.lit(0), F.ceil(F.size(parts) / wide).cast("int") - 1), lambda b: F.slice(parts, b * wide + 1, wide))
        start = F.struct(F.lit(0).alias("at"), F.array().cast(places).alias("out"))
        return F.transform(blocks, lambda block: F.aggregate(block, start, step))

    def shifted(blocks: Column) -> Column:
        offsets = F.aggregate(blocks, F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out")), block_step)["out"]
        return F.zip_with(blocks, offsets, lambda block, by: F.transform(block["out"], lambda s: F.struct((s["start"] + by).alias("start"), (s["end"] + by).alias("end"), s["held"].alias("held"))))

    return let(parts, lambda p: F.when(F.size(p) > 0, F.flatten(let(summed(p), shifted))).otherwise(F.array().cast(places)))


def spans_of(text: Column, rule: Rule) -> Column:
    """Places of the rule's leftmost non-overlapping matches whose group is long enough."""
    scan = rule.scan or rule.pattern
    pattern = F.lit(scan)
    sizes = F.transform(F.regexp_extract_all(text, pattern, F.lit(0)), F.length)
    held = F.transform(F.regexp_extract_all(text, pattern, F.lit(rule.group)), F.length)
    gaps = F.transform(F.split(text, scan, -1), F.length)
    parts = F.arrays_zip(F.slice(gaps, F.lit(1), F.size(sizes)).alias("gap"), sizes.alias("size"), held.alias("held"))
    places = F.filter(_placed(parts), lambda s: s["held"] >= rule.least)
    places = F.transform(places, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))
    return F.when(F.regexp_like(text, pattern), places).otherwise(F.array().cast(SPANS))


class BlobLedger:
    """Rows of ``LEDGER`` in a folder of its own; every scan appends."""

    def __init__(self, spark: SparkSession, path: str | None = None, rules: tuple[Rule, ...] = RULES):
        self.spark, self.rules = spark, rules
        self.path = path or shared_path(spark, "blob-ledger")
        spark.createDataFrame([], LEDGER).write.mode("append").parquet(self.path)

    def rows(self) -> DataFrame:
        return self.spark.read.schema(LEDGER).parquet(self.path)

    def scan(self, paths: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """Scan what is new in ``paths`` and append it; returns the paths' ids and blobs, written."""
        texts = paths.select(F.col(id_col).alias("id"), text_of(F.col(text_col)).alias("text")).withColumn("blob", F.sha2("text", 256))
        index = written(texts.select("id", "blob"), "blob-index")
        firsts = index.groupBy("blob").agg(F.min("id").alias("id"))
        known = self.rows().select("blob", "kind", "version")
        rules = F.array(*[F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version")) for r in self.rules])
        unseen = firsts.withColumn("rule", F.explode(rules)).select("blob", "id", "rule.*").join(known, ["blob", "kind", "version"], "left_anti")
        unseen = unseen.groupBy("blob", "id").agg(F.collect_set("kind").alias("kinds"))
        unseen = written(unseen.select(F.col("blob").alias("u_blob"), F.col("id").alias("u_id"), "kinds"), "blob-unseen")
        found = self._to_scan(texts, index, unseen)
        run = [F.when(F.array_contains("kinds", r.kind), spans_of(F.col("text"), r)).alias(r.kind) for r in self.rules]
        found = found.select("blob", *run)
        rows = F.array(*[F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version"), F.col(r.kind).alias("spans")) for r in self.rules])
        found = found.select("blob", F.explode(rows).alias("row")).select("blob", "row.*").filter("spans is not null")
        found.write.mode("append").parquet(self.path)
        return index

    def _to_scan(self, texts: DataFrame, index: DataFrame, unseen: DataFrame) -> DataFrame:
        """Texts of the unseen blobs with the kinds to scan for; a blob's first path has its text (more than one row of it, if rows repeat)."""
        every = F.array(*[F.lit(r.kind) for r in self.rules])
        first_copy = (F.col("blob") == F.col("u_blob")) & F.col("id").eqNullSafe(F.col("u_id"))
        if fits(unseen, unseen.count()):
            return texts.join(F.broadcast(unseen), first_copy)
        some = unseen.filter(F.size("kinds") < len(self.rules))
        copies = index.select("blob", "id").distinct().join(unseen.filter(F.size("kinds") == len(self.rules)), first_copy, "left_anti")
        copies = written(copies.select(F.col("blob").alias("u_blob"), F.col("id").alias("u_id")), "blob-copies")
        if some.isEmpty() and fits(copies, copies.count()):
            return texts.join(F.broadcast(copies), first_copy, "left_anti").withColumn("kinds", every)
        return texts.join(unseen, first_copy)

    def findings(self, index: DataFrame) -> DataFrame:
        """``index`` with one column of spans for each rule, joined by blob."""
        now = F.lit(False)
        for r in self.rules:
            now = now | ((F.col("kind") == r.kind) & (F.col("version") == r.version))
        some = self.rows().filter(now & (F.size("spans") > 0))
        # A blob can be in the ledger twice if a row of it was repeated; its spans are the same.
        by_blob = some.groupBy("blob").agg(*[F.first(F.when(F.col("kind") == r.kind, F.col("spans")), True).alias(r.kind) for r in self.rules])
        counts = index.groupBy("blob").agg(F.count(F.lit(1)).alias("copies"))
        by_blob = written(by_blob.join(counts, "blob"), "blob-findings")
        empty = F.array().cast(SPANS)
        return counted_join(index, by_blob, ["blob"], "left", "copies").select("id", "blob", *[F.coalesce(r.kind, empty).alias(r.kind) for r in self.rules])


def spans_text(rules: tuple[Rule, ...] = RULES) -> Column:
    """kind:start:end of all spans by start, then the rules' order, joined by commas."""

    def named(kind: str, rank: int) -> Column:
        return F.transform(F.col(kind), lambda s: F.struct(s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end"), F.lit(kind).alias("kind")))

    each = [named(r.kind, i) for i, r in enumerate(rules)]
    return F.array_join(F.transform(F.array_sort(F.concat(*each)), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op5_secret_scan(spark: SparkSession, sf_dir: str, increments: int = 2) -> DataFrame:
    """Increments of the table's rows, dealt by a hash of the id; each scans only blobs that none before it has seen."""
    docs = table(spark, sf_dir, "documents")
    ledger, dealt = BlobLedger(spark), F.pmod(F.xxhash64("doc_id"), F.lit(increments))
    indexes = [ledger.scan(docs.filter(dealt == k)) for k in range(increments)]
    index = indexes[0]
    for more in indexes[1:]:
        index = index.unionByName(more)
    rows = ledger.findings(index).withColumn("spans", spans_text())
    return rows.select(F.col("id").alias("doc_id"), *[F.size(k).cast("long").alias(f"n_{k}") for k in ("assign", "access", "hex")], F.sha2("spans", 256).alias("base_sha256"), "spans")


def _kind_sql(kind: str, pattern: str, rank: int, least: int, group: int) -> str:
    p = pattern.replace("'", "''")
    return f"""
{kind}_m AS (
  SELECT r, t, regexp_extract_all(t, '{p}', 0) AS m, regexp_extract_all(t, '{p}', {group}) AS g, string_split_regex(t, '{p}') AS s FROM d),
{kind} AS (
  SELECT r, '{kind}' AS kind, {rank} AS rank, u.b AS b, u.b + u.n AS e FROM (
    SELECT r, unnest(list_transform(range(1, len(m) + 1), lambda i: {{
      'b': (list_sum(list_transform(s[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0))::BIGINT,
      'n': length(m[i]), 'g': length(g[i])}})) AS u FROM {kind}_m)
  WHERE u.g >= {least})"""


OP5_SQL = (
    "WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),"
    + ",".join(_kind_sql(r.kind, r.pattern, i, r.least, r.group) for i, r in enumerate(RULES))
    + """,
a AS (
  SELECT * FROM assign UNION ALL SELECT * FROM access UNION ALL SELECT * FROM hex),
g AS (
  SELECT r, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
         string_agg(kind || ':' || b || ':' || e, ',' ORDER BY b, rank) AS spans FROM a GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN g USING (r)
"""
)
