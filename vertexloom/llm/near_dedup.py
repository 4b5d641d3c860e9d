"""SimHash near-dedup with verified links: one document of each group of near copies stays.

A text is the set of the hashes of its shingles of ``size`` words (the whole
sequence if there are fewer); A-Z in lower case, words are runs without white
space. Two texts are linked if the Jaccard similarity of their sets is 0.8 or
more, which is verified on the whole sets of every link.

Texts of one set are one node. The nodes' SimHash fingerprints go through the
Gray-order index (``simhash``), and each node is verified against one node of
the group that the index puts it in. Fingerprints alone can't decide here: at
a similarity of 0.8 they differ in about ten of 64 bits, more than any index
of theirs can search. So the pairs that lie further apart come from prefixes:
with all shingles in one order, the first ``n - ceil(0.8 n) + 1`` of two
linked sets share a shingle. In the order, shingles that are frequent in a
sample of the texts come last, so that common lines make no candidates; any
order finds every link. Sets that share c shingles of their prefixes share at
most c and the larger of the rests behind the prefixes, which rules out most
candidates before their texts are read.

First each node is verified against its group's node, the most promising of
its prefixes' pivots and, in frequent shingles, the most promising of the
nodes with the least before the shingle, of all and of those that end alike,
so that groups of copies and texts that are hardly more than passages become
components in rows linear in their size; then candidates that lie in
different components are.

What keeps the texts of a passage from being paired with each other:

* A shingle that comes right behind one and the same other shingle in all
  texts that have it pairs no two that this other one doesn't pair, so a
  passage pairs its texts at its first shingle and not at every one. How many
  such shingles follow is counted on.
* Two nodes meet in a frequent shingle only if what either has from it on
  could still make them similar enough, which is so of the first shingle that
  linked nodes share.
* Every node carries a signature: for each of 1,024 classes of hashes,
  whether an odd number of its shingles lies there. Where two signatures
  differ the sets do, so that pairs with too many differing bits are dropped
  as they meet (by signatures of half as many bits, folded, which move less)
  or before their sets are read, and no linked pair is. Sets of over 2,048
  shingles have a signature of eight times as many bits beside it.

Defined cases: null, empty and blank texts have one empty shingle and are
linked; a very long text is one set like any other; a null id counts in no
minimum, and what only rows without ids are linked to stays; of repeated rows
all stay or none; an empty table gives no rows; columns keep their names
whatever these are.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

from vertexloom.llm.common import checked_join, counted_join, give_back, key_filter, may_have, rows_among, rows_without, small_batches, text_of, written
from vertexloom.llm.components import components
from vertexloom.llm.simhash import links_between

#: Linked from 4/5 on; in whole numbers, so that no rounding decides.
NUMERATOR, DENOMINATOR = 4, 5
#: The order of shingles is taken from one text of so many, for so many shingles at most; neither changes which links are found.
SAMPLED, ORDERED = 16, 200_000
#: Classes of hashes of a node's signature, and of the second one of nodes with more shingles than LARGE.
SIGNED, SIGNED_LARGE, LARGE = 1024, 8192, 2048
#: So many pairs of one node, or nodes of one shingle, are compared in one task.
TOGETHER = 256
#: Nodes with longer prefixes look for pivots in one of so many shingles; what has no pivot in common there meets later, in every shingle.
LONG_PREFIX, PIVOTED = 64, 4
#: Fixed value: the seed of the shingles' XXH64.
SEED = 42


def shingle_set(text: str, size: int) -> np.ndarray:
    """Distinct hashes of the shingles, in order."""
    import xxhash

    words = text.encode().lower().split()
    joined = b" ".join(words)
    if len(words) <= size:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64).view(np.int64)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[: len(words) - size + 1]
    hash64 = xxhash.xxh64_intdigest
    return np.unique(np.array([hash64(joined[a:b], SEED) for a, b in zip(starts.tolist(), ends[size - 1 :].tolist(), strict=True)], np.uint64).view(np.int64))


def fingerprint_of(hashes: np.ndarray) -> int:
    """SimHash of a set of hashes: the bits that are set in more than half of them."""
    ones = np.unpackbits(hashes.view(np.uint8), bitorder="little").reshape(-1, 64).sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.int64)[0])


def signature(hashes: np.ndarray, classes: int) -> np.ndarray:
    """A bit for each class of hashes: whether the set has an odd number of them."""
    odd = np.bincount(hashes & (classes - 1), minlength=classes) & 1
    return np.packbits(odd.astype(bool), bitorder="little").view(np.int64)


def _lists(sets: list[np.ndarray | None]) -> pa.Array:
    ends = np.cumsum([0, *[0 if s is None else len(s) for s in sets]])
    mask = pa.array([s is None for s in sets], pa.bool_())
    values = np.concatenate([np.empty(0, np.int64), *[s for s in sets if s is not None]])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values), mask=mask)


def _text_key(text: str) -> Column:
    """What a row's text is known by where the text itself isn't kept."""
    return F.xxhash64(text_of(F.col(text)))


def _sets(docs: DataFrame, size: int, text_col: str) -> DataFrame:
    """All columns but the text's, and ``shingles``."""
    rows = docs.select(*[c for c in docs.columns if c != text_col], text_of(F.col(text_col)).alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(text.as_py(), size) for text in batch.column(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], _lists(sets)], names=names)
        give_back()

    schema = rows.drop("__text").schema.add("shingles", ArrayType(LongType()))
    names = schema.names
    return rows.mapInArrow(run, schema)


def frequent_last(docs: DataFrame, size: int, text_col: str) -> np.ndarray:
    """Shingles that several sampled texts have, by rising frequency."""
    sample = docs.select(text_of(F.col(text_col)).alias("text")).filter(F.pmod(F.xxhash64("text"), F.lit(SAMPLED)) == 0)
    counts = _sets(sample, size, "text").select(F.explode("shingles").alias("h")).groupBy("h").count().filter("count > 1")
    return counts.orderBy(F.desc("count"), "h").limit(ORDERED).select("h").toArrow().column("h").to_numpy()[::-1]


def prefixes(docs: DataFrame, size: int, text_col: str, known: np.ndarray) -> DataFrame:
    """All columns but the text's, its key ``text``, a row number, ``node``, ``n``, its number of shingles that aren't frequent ``r``, the fingerprint ``fp``, the prefix, the last shingle in the order ``tail`` and the signatures; these are null where the task has met the node before."""
    from xxhash import xxh64_intdigest as xxhash64

    rows = docs.select(*[c for c in docs.columns if c != text_col], _text_key(text_col).alias("text"), F.monotonically_increasing_id().alias("__row"), text_of(F.col(text_col)).alias("__text"))
    by_hash = np.argsort(known)
    sent = docs.sparkSession.sparkContext.broadcast((known[by_hash], by_hash + 1))

    def prefix(hashes: np.ndarray) -> tuple[int, np.ndarray, int]:
        frequent, place = sent.value
        rank = np.zeros(len(hashes), np.int64)
        if len(frequent):
            at = np.minimum(np.searchsorted(frequent, hashes), len(frequent) - 1)
            rank = np.where(frequent[at] == hashes, place[at], 0)
        n = len(hashes)
        order = np.lexsort((hashes, rank))
        return int(np.count_nonzero(rank == 0)), hashes[order[: n + 1 + -NUMERATOR * n // DENOMINATOR]], int(hashes[order[-1]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met = set()
        for batch in batches:
            nodes, sizes, others, codes, firsts, tails, signs, more = [], [], [], [], [], [], [], []
            for text in batch.column(batch.num_columns - 1):
                hashes = shingle_set(text.as_py(), size)
                node = xxhash64(hashes.tobytes(), SEED)
                r, first, tail = (0, None, None) if node in met else prefix(hashes)
                nodes.append(node)
                sizes.append(len(hashes))
                others.append(r)
                codes.append(None if node in met else fingerprint_of(hashes))
                firsts.append(first)
                tails.append(tail)
                signs.append(None if node in met else signature(hashes, SIGNED))
                more.append(None if node in met or len(hashes) <= LARGE else signature(hashes, SIGNED_LARGE))
                met.add(node)
            made = [pa.array(np.array(nodes, np.uint64).view(np.int64)), pa.array(sizes, pa.int32()), pa.array(others, pa.int32()), pa.array(codes, pa.int64()), _lists(firsts), pa.array(tails, pa.int64()), _lists(signs), _lists(more)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *made], names=names)
        del met
        give_back()

    schema = rows.drop("__text").schema.add("node", "long").add("n", "integer").add("r", "integer").add("fp", "long").add("prefix", ArrayType(LongType())).add("tail", "long").add("sign", ArrayType(LongType())).add("more", ArrayType(LongType()))
    names = schema.names
    return rows.mapInArrow(run, schema)


def _may_link(shared: Column) -> Column:
    """Whether sets of ``n`` and ``o_n`` that share so many shingles of their prefixes may be linked."""
    rest = F.ceil(F.greatest("n", "o_n") * NUMERATOR / DENOMINATOR) - 1
    return (shared + rest) * (NUMERATOR + DENOMINATOR) >= NUMERATOR * (F.col("n") + F.col("o_n"))


def _similar_sizes() -> Column:
    return F.least("n", "o_n") * DENOMINATOR >= F.greatest("n", "o_n") * NUMERATOR


def _with_sets(pairs: DataFrame, sets: DataFrame, end: str, other: str, name: str) -> DataFrame:
    """``pairs`` with the set of one end; the set of a node with many pairs goes to several tasks, each with a share of the pairs."""
    counts = pairs.groupBy(end).agg(F.count(F.lit(1)).alias("k"))
    counts = written(counts.select(end, F.ceil(F.col("k") / TOGETHER).cast("int").alias("parts"), "k"), "near-ends")
    dealt = counted_join(pairs, counts, [end], "inner", "k").withColumn("part", F.pmod(F.xxhash64(other), "parts").cast("int")).drop("parts")
    several = sets.withColumnRenamed("node", end).join(counts.drop("k"), end).select(end, F.col("shingles").alias(name), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    return dealt.join(several, [end, "part"]).drop("part")


def _differ_little(bits: Column) -> Column:
    """Whether sets of ``n`` and ``o_n`` shingles that differ in so many at least can be linked."""
    both = F.col("n") + F.col("o_n")
    return bits * (NUMERATOR + DENOMINATOR) <= both * (DENOMINATOR - NUMERATOR)


def _sign_bits(words: int) -> Column:
    return reduce(lambda a, b: a + b, [F.bit_count(F.get("sign", F.lit(k)).bitwiseXOR(F.get("o_sign", F.lit(k)))) for k in range(words)])


def _halved(sign: str) -> Column:
    """A signature of half as many classes, by which fewer pairs are told apart where they meet."""
    half = SIGNED // 128
    return F.zip_with(F.slice(sign, 1, half), F.slice(sign, half + 1, half), lambda a, b: a.bitwiseXOR(b))


def _promising(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs (u, v) whose signatures don't tell them apart; a node with many pairs is joined where they are."""
    signed = nodes.select("node", "n", "sign", "more")
    for end, other in (("u", ""), ("v", "o_")):
        counts = written(pairs.groupBy(F.col(end).alias("node")).agg(F.count(F.lit(1)).alias("k")), "near-counts")
        own = written(rows_among(signed, counts, "node").join(counts, "node"), "near-signs").select(F.col("node").alias(end), *[F.col(c).alias(f"{other}{c}") for c in ("n", "sign", "more")], "k")
        pairs = counted_join(pairs, own, [end], "inner", "k")
    large = F.aggregate(F.zip_with("more", "o_more", lambda a, b: F.bit_count(a.bitwiseXOR(b))), F.lit(0), lambda a, b: a + b)
    near = _differ_little(_sign_bits(SIGNED // 64)) & F.coalesce(_differ_little(large), F.lit(True))
    return written(pairs.filter(near).select("u", "v"), "near-promising")


def _node_sets(texts: DataFrame, size: int) -> DataFrame:
    """A row number, ``node`` and ``shingles`` of each text, once in each task."""
    from xxhash import xxh64_intdigest as xxhash64

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met = set()
        for batch in batches:
            rows, nodes, sets = [], [], []
            for row, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                hashes = shingle_set(text.as_py(), size)
                node = xxhash64(hashes.tobytes(), SEED)
                if node not in met:
                    met.add(node)
                    rows.append(row)
                    nodes.append(node)
                    sets.append(hashes)
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(np.array(nodes, np.uint64).view(np.int64)), _lists(sets)], names=["__row", "node", "shingles"])
        give_back()

    return texts.mapInArrow(run, "__row long, node long, shingles array<long>")


def _verified(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, size: int, text_col: str) -> DataFrame:
    """The pairs (u, v) of nodes whose whole sets are similar enough; these are made of the documents' texts, which are read in place."""
    pairs = _promising(pairs, nodes)
    wanted = written(pairs.select(F.explode(F.array("u", "v")).alias("node")).distinct(), "near-wanted")
    keys = written(rows_among(nodes.select("node", "text"), wanted, "node").select("text").distinct(), "near-texts")
    read = docs.select(_text_key(text_col).alias("text"), text_of(F.col(text_col)).alias("__text"))
    texts = rows_among(read, keys, "text").select(F.monotonically_increasing_id().alias("__row"), "__text")
    sets = _once(written(_node_sets(texts, size), "near-sets")).drop("__row")
    both = _with_sets(_with_sets(pairs, sets, "u", "v", "a"), sets, "v", "u", "b")
    shared = F.size(F.array_intersect("a", "b"))
    return both.filter(shared * (NUMERATOR + DENOMINATOR) >= NUMERATOR * (F.size("a") + F.size("b"))).select("u", "v")


def _once(rows: DataFrame) -> DataFrame:
    """One row for each node."""
    thin = rows.select("node", "__row")
    several = written(thin.groupBy("node").agg(F.min("__row").alias("first"), F.count(F.lit(1)).alias("k")).filter("k > 1"), "near-repeated")
    again = written(counted_join(thin, several, ["node"], "inner", "k").filter("__row != first").select("__row"), "near-again")
    return checked_join(rows, again, "__row", "left_anti")


def _index_pairs(rows: DataFrame) -> DataFrame:
    """(u, v): each node of a group that the fingerprints' index finds, and one node of the group."""
    codes = written(rows.filter("fp is not null").select("node", "n", "fp").distinct(), "near-codes")
    roots = written(components(links_between(codes.select("fp").distinct())).withColumnRenamed("node", "fp"), "near-index")
    counts = written(codes.groupBy("fp").agg(F.count(F.lit(1)).alias("k")), "near-code-counts")
    sized = written(checked_join(counts, roots, "fp", "left").filter("k > 1 or root is not null").select("fp", F.coalesce("root", "fp").alias("root"), "k"), "near-code-roots")
    grouped = written(counted_join(codes, sized, ["fp"], "inner", "k").select("node", "n", "root"), "near-code-groups")
    pivots = written(grouped.groupBy("root").agg(F.min_by(F.struct("node", "n"), F.xxhash64("node")).alias("p"), F.count(F.lit(1)).alias("k")), "near-code-pivots")
    pairs = counted_join(grouped, pivots, ["root"], "inner", "k").select("node", "n", F.col("p.node").alias("o_node"), F.col("p.n").alias("o_n"))
    return pairs.filter((F.col("node") != F.col("o_node")) & _similar_sizes()).select(F.col("node").alias("u"), F.col("o_node").alias("v"))


def _reach(n: str, at: str) -> Column:
    """How many shingles a set of ``n`` has from a place of its order on."""
    return F.col(n) - F.col(at)


def _stars(met: DataFrame) -> DataFrame:
    """(u, v): each node and the pivot ``o_node`` that shares the most of its prefix, or of the part of it that was looked at, by twice as much as that promises."""
    counts = met.filter((F.col("node") != F.col("o_node")) & _similar_sizes()).groupBy("node", "n", "o_node", "o_n").agg(F.count(F.lit(1)).alias("count"), F.max("part").alias("part"))
    counts = counts.filter(_may_link(F.col("count") * F.when(F.col("part"), 2 * PIVOTED).otherwise(1)))
    return counts.groupBy("node").agg(F.max_by("o_node", F.struct("count", "o_node")).alias("v")).withColumnRenamed("node", "u")


def _heads(placed: DataFrame, nodes: DataFrame) -> DataFrame:
    """Rows of the shingles that different components share, without those of shingles that always come right behind one other; ``run`` says how many of these follow."""
    behind = (F.min("prev") == F.max("prev")) & (F.count("prev") == F.count(F.lit(1)))
    open_ = placed.groupBy("h").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count(F.lit(1)).alias("k"), F.coalesce(behind, F.lit(False)).alias("behind")).filter("lo < hi")
    # Those behind have no parts.
    open_ = written(open_.select("h", F.when(F.col("behind"), 0).otherwise(F.ceil(F.col("k") / TOGETHER)).cast("int").alias("parts"), "k"), "near-open")
    order = Window.partitionBy("node").orderBy("at")
    marked = counted_join(placed.drop("prev"), open_, ["h"], "inner", "k").withColumn("head", F.sum((F.col("parts") > 0).cast("int")).over(order))
    heads = marked.withColumn("run", F.count(F.lit(1)).over(Window.partitionBy("node", "head")) - 1).filter("parts > 0").drop("head")
    return written(heads.join(nodes.select("node", _halved("sign").alias("sign")), "node"), "near-heads")


def _met(heads: DataFrame) -> DataFrame:
    """Pairs of nodes at each shingle that both have as a head, but for those that can't be linked by their sizes, their places or their signatures."""
    kept = [c for c in heads.columns if c not in ("h", "parts")]
    within_reach = F.least(_reach("n", "at"), _reach("o_n", "o_at")) * (NUMERATOR + DENOMINATOR) >= NUMERATOR * (F.col("n") + F.col("o_n"))
    # All of it is a part of the join's condition, so that no other pair leaves the join.
    may = (F.col("node") < F.col("o_node")) & (F.col("root") != F.col("o_root")) & _similar_sizes() & (~F.col("frequent") | within_reach) & _differ_little(_sign_bits(SIGNED // 128))
    # Shingles of one part need no dealing; both sides differ in the columns' names alone.
    few = heads.filter("parts = 1").select("h", *kept)
    pairs = few.toDF("h", *[f"a_{c}" for c in kept]).join(few.toDF("h", *[f"o_{c}" for c in kept]), "h").toDF("h", *kept, *[f"o_{c}" for c in kept]).filter(may)
    many = heads.filter("parts > 1")
    others = many.select("h", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), *[F.col(c).alias(f"o_{c}") for c in kept])
    dealt = many.select("h", F.pmod(F.xxhash64("node"), "parts").cast("int").alias("part"), *kept)
    return pairs.unionByName(dealt.join(others, ["h", "part"]).filter(may).drop("part"))


def near_links(rows: DataFrame, docs: DataFrame, size: int, text_col: str) -> DataFrame:
    """Links (u, v) that connect what the pairs of similar nodes of the documents' ``prefixes`` connect."""
    nodes = _once(rows.filter("prefix is not null"))
    places = F.transform("prefix", lambda h, at: F.struct(h.alias("h"), F.get("prefix", at - 1).alias("prev")))
    each = nodes.select("node", "n", "r", "tail", F.size("prefix").alias("size"), F.posexplode(places).alias("at", "p"))
    each = each.select("node", "n", "size", F.greatest(F.lit(0), F.col("size") - F.col("r")).alias("f"), "p.h", "p.prev", "at", (F.col("at") >= F.col("r")).alias("frequent"), "tail")
    # Most shingles of prefixes are one node's, and few of these pass the filter of the others; they meet no other node and do no harm.
    shared = key_filter(each.groupBy("h").count().filter("count > 1"), ["h"])
    buckets = written(may_have(each, shared, ["h"]).filter("__may").drop("__may"), "near-buckets")
    # Nodes are hashes, so the least of them is anyone of the shingle's.
    looked = buckets.withColumn("part", F.col("size") > LONG_PREFIX).filter(~F.col("part") | (F.pmod("h", F.lit(PIVOTED)) == 0))
    foremost = F.min_by(F.struct("node", "n"), F.struct("at", F.xxhash64("node")))
    pivots = looked.groupBy("h").agg(F.min(F.struct("node", "n")).alias("p"), F.min(F.when(F.col("frequent"), F.struct("at", "node", "n"))).alias("q"), F.count(F.lit(1)).alias("k"))
    pivots = written(pivots.filter("k > 1").select("h", F.col("p.node").alias("p"), F.col("p.n").alias("p_n"), F.col("q.node").alias("q"), F.col("q.n").alias("q_n"), "k"), "near-pivots")
    with_pivots = counted_join(looked.select("h", "node", "n", "part"), pivots, ["h"], "inner", "k")
    stars = [_stars(with_pivots.select("node", "n", "part", F.col(p).alias("o_node"), F.col(f"{p}_n").alias("o_n"))) for p in ("p", "q")]
    # Of the texts that end alike, too, the one with the least before the shingle.
    often = buckets.filter("frequent").select("h", "tail", "node", "n", "at")
    tails = written(often.groupBy("h", "tail").agg(foremost.alias("q"), F.count(F.lit(1)).alias("k")).filter("k > 1").select("h", "tail", "q", "k"), "near-tails")
    stars.append(_stars(counted_join(often.drop("at"), tails, ["h", "tail"], "inner", "k").select("node", "n", F.lit(False).alias("part"), F.col("q.node").alias("o_node"), F.col("q.n").alias("o_n"))))
    pairs = written(reduce(DataFrame.unionByName, [*stars, _index_pairs(rows)]).distinct(), "near-stars")
    first = written(_verified(pairs, nodes, docs, size, text_col), "near-first")
    roots = written(components(first), "near-roots")

    placed = checked_join(buckets.drop("tail", "size"), roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    met = _met(_heads(written(placed, "near-placed"), nodes))
    # Of frequent shingles not all that a pair shares are met, so as many count as both prefixes have.
    more = F.when(~F.col("frequent"), F.least("run", "o_run") + 1).otherwise(0)
    counts = met.groupBy("node", "n", "o_node", "o_n").agg(F.sum(more).alias("count"), F.max(F.least("f", "o_f")).alias("frequent"))
    pairs = counts.filter(_may_link(F.col("count") + F.col("frequent")))
    rest = written(pairs.select(F.col("node").alias("u"), F.col("o_node").alias("v")), "near-rest")
    return first.unionByName(_verified(rest, nodes, docs, size, text_col))


def drop_near(docs: DataFrame, size: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each group of linked ones, that of the smallest id, with the columns it came with.

    Documents without an id and what they alone link to all stay, as do
    rows that share the smallest id. What goes is found first, by its id and
    its text's key, and the documents are read once more without it: no copy
    of the texts is written, and a text is shuffled only if it may go and
    those that go are too many to broadcast.
    """
    small_batches(docs.sparkSession)
    numbered = [f"__in_{i}" for i in range(len(docs.columns))]
    key, text = numbered[docs.columns.index(id_col)], numbered[docs.columns.index(text_col)]
    named = docs.toDF(*numbered)
    rows = written(prefixes(named.select(key, text), size, text, frequent_last(named, size, text)), "near-rows")
    roots = written(components(near_links(rows, named, size, text)), "near-components")
    nodes = written(rows.groupBy("node").agg(F.min(key).alias("least"), F.count(F.lit(1)).alias("k")), "near-nodes")
    linked = checked_join(nodes, roots, "node", "left").filter("k > 1 or root is not null").select("node", "least", F.coalesce("root", "node").alias("root"), "k")
    linked = written(linked, "near-linked")
    firsts = written(linked.groupBy("root").agg(F.min("least").alias("stays"), F.count(F.lit(1)).alias("nodes")), "near-firsts")
    grouped = written(counted_join(linked, firsts, ["root"], "inner", "nodes").select("node", "stays", "k"), "near-grouped")
    gone = counted_join(rows.select("text", "node", key), grouped, ["node"], "inner", "k").filter(~F.col(key).eqNullSafe(F.col("stays")))
    kept = rows_without(named.withColumn("text", _text_key(text)), written(gone.select("text", key).distinct(), "near-gone"), "text", key)
    return kept.select(*[F.col(n).alias(c) for c, n in zip(docs.columns, numbered, strict=True)])
