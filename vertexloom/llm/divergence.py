"""How far the sources of a language differ in their words: a source divergence audit.

1. Each task counts the documents of every term, in a table that it hands on
   before it grows large; terms in ``min_docs`` documents of a language or
   more are kept.
2. The kept terms are sorted over the cluster, and each sorted slice becomes
   a minimal acyclic transducer (``transducer``), whose outputs are the
   terms' ordinals; a slice adds the number of terms before it.
3. All texts are streamed through the transducers of their language, all
   words of a batch at once, which gives the counts of each source by
   ordinal. Transducers go to the workers as many as ``SENT_BYTES`` hold at a
   time; the texts of the languages concerned are read once for each such lot.
4. Counts meet by blocks of ordinals and tiles of sources, each small enough
   for one task, which gives its part of every two sources' distance. A
   source's foremost terms are ranked from its own counts and its language's;
   ties go by ordinal, which is the order of the terms' bytes.

All arithmetic is in whole numbers.

Defined cases: null text, lang or source count as the empty string; repeated
rows each count as a document; a group without kept terms has all counts
zero, and in a language without kept terms all distances are zero; a lone
source has no pairs; null ids and further columns are ignored; a very long
text is streamed in pieces; an empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vertexloom.llm.common import UPPER, checked_join, counted_join, give_back, small_batches, table, text_of, written
from vertexloom.llm.transducer import Transducer

MIN_DOCS, FOREMOST, ADDED, SCALE = 30, 50, 5, 1_000_000_000
#: Terms of a slice, bytes of transducers that are sent at once, terms that a task counts before it hands them on, and bytes of text that are cut into words together.
SLICE_TERMS, SENT_BYTES, HELD, PIECE = 1 << 17, 48 << 20, 400_000, 4 << 20
#: Sources of a tile and ordinals of a block.
TILE, WIDTH = 64, 4096
#: Bits of a key that hold the ordinal.
ORDINAL_BITS = 40
#: A byte to what it is in terms: A-Z in lower case, a-z and all of other characters as they are, the rest blank.
BYTES = bytes(b + 32 if chr(b) in UPPER else b if b >= 0x80 or chr(b) in UPPER.lower() else 32 for b in range(256))


def _pieces(text: bytes) -> Iterator[bytes]:
    """A text in terms and blanks, cut between terms."""
    cleaned, at = text.translate(BYTES), 0
    while at < len(cleaned):
        end = cleaned.find(b" ", at + PIECE)
        end = len(cleaned) if end < 0 else end
        yield cleaned[at:end]
        at = end


def _texts(docs: DataFrame, lang: str, source: str, text: str) -> DataFrame:
    return docs.select(text_of(F.col(lang)).alias("lang"), text_of(F.col(source)).alias("source"), text_of(F.col(text)).cast("binary").alias("text"))


def document_frequencies(texts: DataFrame) -> DataFrame:
    """``lang, term, n`` of all terms: documents of each, counted in tasks before they are shuffled."""

    def rows(held: dict[str, Counter]) -> Iterator[pa.RecordBatch]:
        for lang, counts in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(counts), pa.string()), pa.array(list(counts), pa.binary()).cast(pa.string()), pa.array(list(counts.values()), pa.int64())], names=["lang", "term", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                found: set[bytes] = set()
                for piece in _pieces(text.as_py()):
                    found.update(piece.split())
                held.setdefault(lang, Counter()).update(found)
                if sum(map(len, held.values())) > HELD:
                    yield from rows(held)
                    held = {}
        yield from rows(held)
        del held
        give_back()

    return texts.select("lang", "text").mapInArrow(run, "lang string, term string, n long").groupBy("lang", "term").agg(F.sum("n").alias("n"))


def vocabulary(texts: DataFrame, min_docs: int = MIN_DOCS, slice_terms: int = SLICE_TERMS) -> DataFrame:
    """Written slices of each language's sorted kept terms: lang, first, n, the terms, the transducer's arrays, and ``offset``, the number of terms before them."""
    kept = written(document_frequencies(texts).filter(F.col("n") >= min_docs).select("lang", "term"), "divergence-kept")
    slices = max(1, -(-kept.count() // slice_terms))
    arrays = Transducer.ARRAYS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lang, terms = None, []

        def row() -> pa.RecordBatch:
            stored = Transducer.of(t.encode() for t in terms).to_bytes()
            values = [pa.array([lang]), pa.array([terms[0]]), pa.array([len(terms)], pa.int64()), pa.array([terms], pa.list_(pa.string())), *[pa.array([stored[a]], pa.binary()) for a in arrays]]
            return pa.RecordBatch.from_arrays(values, names=["lang", "first", "n", "terms", *arrays])

        for batch in batches:
            for of, term in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if terms and (of != lang or len(terms) >= slice_terms):
                    yield row()
                    terms = []
                lang = of
                terms.append(term)
        if terms:
            yield row()

    schema = "lang string, first string, n long, terms array<string>, " + ", ".join(f"{a} binary" for a in arrays)
    made = written(kept.repartitionByRange(slices, "lang", "term").sortWithinPartitions("lang", "term").mapInArrow(run, schema), "divergence-slices")
    size = F.lit(0)
    for a in arrays:
        size = size + F.octet_length(a)
    earlier = Window.partitionBy("lang").orderBy("first").rowsBetween(Window.unboundedPreceding, -1)
    # A row for each slice, of tens of thousands of terms: few enough to be numbered in one task.
    numbered = made.select("lang", "first", "n", size.alias("size")).withColumns({"offset": F.coalesce(F.sum("n").over(earlier), F.lit(0)), "lot": F.floor(F.sum("size").over(Window.orderBy("lang", "first")) / SENT_BYTES)})
    return made.join(F.broadcast(written(numbered.select("lang", "first", "offset", "lot"), "divergence-offsets")), ["lang", "first"])


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[first], np.add.reduceat(counts, first)


def _streamed(texts: DataFrame, lot: list) -> DataFrame:
    """Counts of the terms of some slices in each group: lang, source, ordinal, n, summed in tasks as far as they hold them."""
    by_lang: dict[str, list] = {}
    for row in lot:
        by_lang.setdefault(row["lang"], []).append((row["offset"], {a: bytes(row[a]) for a in Transducer.ARRAYS}))
    sent = texts.sparkSession.sparkContext.broadcast(by_lang)
    names = ["lang", "source", "ordinal", "n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = {lang: [(offset, Transducer.from_bytes(stored)) for offset, stored in slices] for lang, slices in sent.value.items()}
        groups: dict[tuple[str, str], int] = {}
        keys: list[np.ndarray] = []
        counts: list[np.ndarray] = []

        def rows() -> pa.RecordBatch:
            each, group = list(groups), keys[0] >> ORDINAL_BITS
            langs, sources = (pa.array([g[i] for g in each], pa.string()).take(pa.array(group)) for i in (0, 1))
            return pa.RecordBatch.from_arrays([langs, sources, pa.array(keys[0] & ((1 << ORDINAL_BITS) - 1)), pa.array(counts[0])], names=names)

        for batch in batches:
            of: dict[tuple[str, str], list[bytes]] = {}
            for lang, source, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                of.setdefault((lang, source), []).append(text.as_py())
            for group, own in of.items():
                number = groups.setdefault(group, len(groups)) << ORDINAL_BITS
                for piece in _pieces(b" ".join(own)):
                    text = np.frombuffer(piece, np.uint8)
                    inside = np.concatenate(([False], text != 32, [False]))
                    edges = np.flatnonzero(inside[1:] != inside[:-1])
                    starts, lengths = edges[::2], edges[1::2] - edges[::2]
                    for offset, slice_ in known[group[0]]:
                        ordinals = slice_.ordinals(text, starts, lengths)
                        found = ordinals >= 0
                        if found.any():
                            k, n = np.unique(ordinals[found], return_counts=True)
                            keys.append(k + (number + offset))
                            counts.append(n.astype(np.int64))
                            starts, lengths = starts[~found], lengths[~found]
            if sum(map(len, keys)) > HELD:
                summed = _summed(np.concatenate(keys), np.concatenate(counts))
                keys, counts = [summed[0]], [summed[1]]
                if 2 * len(keys[0]) > HELD:
                    yield rows()
                    groups, keys, counts = {}, [], []
        if keys:
            summed = _summed(np.concatenate(keys), np.concatenate(counts))
            keys, counts = [summed[0]], [summed[1]]
            yield rows()
        del known, keys, counts
        give_back()

    return texts.filter(F.col("lang").isin(list(by_lang))).mapInArrow(run, "lang string, source string, ordinal long, n long")


def recount(texts: DataFrame, slices: DataFrame) -> DataFrame:
    """Written counts ``lang, source, ordinal, n`` of the kept terms in each group, without zeros."""
    out = None
    for number in sorted(r[0] for r in slices.select("lot").distinct().collect()):
        lot = slices.filter(F.col("lot") == number).select("lang", "offset", *Transducer.ARRAYS).collect()  # SENT_BYTES and a slice at most
        more = _streamed(texts, lot)
        out = more if out is None else out.unionByName(more)
    if out is None:
        out = texts.sparkSession.createDataFrame([], "lang string, source string, ordinal long, n long")
    return written(out.groupBy("lang", "source", "ordinal").agg(F.sum("n").alias("n")), "divergence-counts")


def _share_of(count: np.ndarray, total: np.ndarray) -> np.ndarray:
    """1 + floor(SCALE * count / total), in steps of 1000 so that nothing overflows; count is total at most."""
    share, rest = np.zeros_like(count), count
    for _ in range(3):
        more, rest = np.divmod(rest * 1000, total)
        share = share * 1000 + more
    return share + 1


def _share(count: Column, total: Column) -> Column:
    """As ``_share_of``, of columns."""
    share, rest = F.lit(0).cast("long"), count
    for _ in range(3):
        share, rest = share * 1000 + F.call_function("div", rest * 1000, total), rest * 1000 % total
    return share + 1


def _compared(counts: pa.Table, info: pa.Table) -> pa.Table:
    """One block of ordinals and two tiles of a language's sources, or one: its part of the distance of every two sources."""
    row = info.to_pylist()[0]
    low, sources = row["low"], [*row["sources"], *(row["o_sources"] if row["a"] != row["b"] else [])]
    totals = np.array([*row["totals"], *(row["o_totals"] if row["a"] != row["b"] else [])], np.int64)
    n = np.zeros((len(sources), row["high"] - low), np.int64)
    n[pc.index_in(counts["source"], value_set=pa.array(sources, pa.string())).to_numpy(), counts["ordinal"].to_numpy() - low] = counts["n"].to_numpy()
    p = _share_of(n + ADDED, (totals + ADDED * row["terms"])[:, None])
    first, second, values = [], [], [np.empty(0, np.int64)]
    for i, source in enumerate(row["sources"]):
        past = i + 1 if row["a"] == row["b"] else len(row["sources"])
        values.append(np.abs(p[past:] - p[i]).sum(1))
        first.extend([source] * (len(sources) - past))
        second.extend(sources[past:])
    return pa.table([pa.array([row["lang"]] * len(first), pa.string()), pa.array(first, pa.string()), pa.array(second, pa.string()), pa.array(np.concatenate(values))], names=["lang", "source", "item", "value"])


def distances(counts: DataFrame, groups: DataFrame) -> DataFrame:
    """``lang, source, item, value``: of every two sources of a language, both ways, the sum of the differences of all terms' shares.

    Sources are dealt to tiles, and a task has two tiles' counts in one block
    of ordinals, so that it is bounded however many sources and terms there are.
    """
    tiles = groups.groupBy("lang", "tile").agg(F.array_sort(F.collect_list(F.struct("source", "total"))).alias("s"), F.first("terms").alias("terms"))
    tiles = written(tiles.select("lang", F.col("tile").alias("a"), F.col("s.source").alias("sources"), F.col("s.total").alias("totals"), "terms"), "divergence-tiles")
    # The result has a row for every two sources, so to pair tiles costs less than it.
    others = tiles.select("lang", F.col("a").alias("b"), F.col("sources").alias("o_sources"), F.col("totals").alias("o_totals"))
    both = tiles.join(others, "lang").filter("a <= b")
    blocks = both.filter("terms > 0").withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("terms") - 1) / WIDTH))))
    blocks = blocks.withColumns({"low": F.col("block") * WIDTH, "high": F.least("terms", (F.col("block") + 1) * WIDTH)})
    placed = counted_join(counts, groups.filter("rows > 0").select("lang", "source", "tile", "tiles", "rows"), ["lang", "source"], "inner", "rows")
    placed = placed.withColumns({"block": F.floor(F.col("ordinal") / WIDTH), "u": F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1))})
    placed = placed.select("lang", F.least("tile", "u").alias("a"), F.greatest("tile", "u").alias("b"), "block", "source", "ordinal", "n")
    keys = ["lang", "a", "b", "block"]
    parts = placed.groupBy(*keys).cogroup(blocks.groupBy(*keys)).applyInArrow(_compared, "lang string, source string, item string, value long")
    half = written(parts.groupBy("lang", "source", "item").agg(F.sum("value").alias("value")), "divergence-pairs")
    without = both.filter("terms = 0").select("lang", F.explode("sources").alias("source"), "a", "b", "o_sources").select("lang", "source", F.explode("o_sources").alias("item"), F.lit(0).cast("long").alias("value")).filter("source < item")
    half = half.unionByName(without)
    return half.unionByName(half.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value"))


def foremost_terms(counts: DataFrame, groups: DataFrame, foremost: int) -> DataFrame:
    """``lang, source, ordinal, value, rank`` of the terms that a source has more often than its language, by how much, then by ordinal."""
    term = Window.partitionBy("lang", "ordinal")
    both = counts.withColumn("all", F.sum("n").over(term))
    known = groups.filter("rows > 0").select("lang", "source", "total", "of_lang", "terms", "rows")
    placed = counted_join(both, known, ["lang", "source"], "inner", "rows")
    added = F.col("terms") * ADDED
    value = _share(F.col("n") + ADDED, F.col("total") + added) - _share(F.col("all") + ADDED, F.col("of_lang") + added)
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "ordinal")
    return placed.select("lang", "source", "ordinal", value.alias("value")).filter("value > 0").withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= foremost)


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, foremost: int = FOREMOST, lang_col: str = "lang", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """``lang, source, part, item, value, rank``: by part ``pair``, the other sources by distance; by part ``term``, the ``foremost`` terms that a source has more often than its language.

    A term's share is ``1 + floor(SCALE * (count + ADDED) / (total + ADDED * terms))``.
    """
    small_batches(docs.sparkSession)
    texts = _texts(docs, lang_col, source_col, text_col)
    slices = vocabulary(texts, min_docs)
    counts = recount(texts, slices)
    terms = slices.groupBy("lang").agg(F.sum("n").alias("terms"))
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("rows"))
    lang = Window.partitionBy("lang")
    groups = texts.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("docs")).join(totals, ["lang", "source"], "left").join(terms, "lang", "left").na.fill(0)
    groups = groups.withColumns({"tile": F.floor((F.row_number().over(lang.orderBy("source")) - 1) / TILE), "tiles": F.ceil(F.count(F.lit(1)).over(lang) / TILE), "of_lang": F.sum("total").over(lang)})
    groups = written(groups, "divergence-groups")

    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = distances(counts, groups).select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(by_value).alias("rank"))
    first = written(foremost_terms(counts, groups, foremost), "divergence-first")
    spelled = slices.select("lang", "offset", F.posexplode("terms").alias("at", "item")).select("lang", (F.col("offset") + F.col("at")).alias("ordinal"), "item")
    found = checked_join(spelled, first, ["lang", "ordinal"], "inner")
    return pairs.unionByName(found.select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"))


OP12_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents),
o AS (
  SELECT r, lang, source, unnest(w) AS t FROM d),
k AS (
  SELECT lang, t FROM o GROUP BY lang, t HAVING count(DISTINCT r) >= 30),
v AS (
  SELECT lang, count(*) AS v FROM k GROUP BY lang),
c AS (
  SELECT o.lang, o.source, o.t, count(*) AS n FROM o JOIN k ON o.lang = k.lang AND o.t = k.t GROUP BY o.lang, o.source, o.t),
g AS (
  SELECT DISTINCT lang, source FROM d),
gn AS (
  SELECT lang, source, CAST(sum(n) AS BIGINT) AS total FROM c GROUP BY lang, source),
ln AS (
  SELECT lang, CAST(sum(n) AS BIGINT) AS total FROM c GROUP BY lang),
p AS (
  SELECT g.lang, g.source, k.t, coalesce(c.n, 0) AS n, 1 + (1000000000 * (coalesce(c.n, 0) + 5)) // (coalesce(gn.total, 0) + 5 * v.v) AS p
  FROM g JOIN k ON g.lang = k.lang JOIN v ON g.lang = v.lang
  LEFT JOIN gn ON g.lang = gn.lang AND g.source = gn.source
  LEFT JOIN c ON g.lang = c.lang AND g.source = c.source AND k.t = c.t),
ct AS (
  SELECT lang, t, CAST(sum(n) AS BIGINT) AS n FROM c GROUP BY lang, t),
q AS (
  SELECT ct.lang, ct.t, 1 + (1000000000 * (ct.n + 5)) // (ln.total + 5 * v.v) AS q
  FROM ct JOIN ln ON ct.lang = ln.lang JOIN v ON ct.lang = v.lang),
f AS (
  SELECT a.lang, a.source, b.source AS item, CAST(sum(abs(a.p - b.p)) AS BIGINT) AS value
  FROM p AS a JOIN p AS b ON a.lang = b.lang AND a.t = b.t AND a.source <> b.source GROUP BY a.lang, a.source, b.source),
pair AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(f.value, 0) AS BIGINT) AS value
  FROM g AS a JOIN g AS b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source),
term AS (
  SELECT p.lang, p.source, 'term' AS part, p.t AS item, CAST(p.p - q.q AS BIGINT) AS value
  FROM p JOIN q ON p.lang = q.lang AND p.t = q.t WHERE p.n > 0 AND p.p > q.q),
r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INT) AS rank
  FROM (SELECT * FROM pair UNION ALL SELECT * FROM term))
SELECT lang, source, part, item, value, rank FROM r WHERE part = 'pair' OR rank <= 50
"""
