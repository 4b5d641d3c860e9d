"""Near-duplicates by SimHash fingerprints and a Gray-order hierarchical index.

Fingerprint: A-Z in lower case, words are runs without white space, shingles
of ``size`` words (the whole sequence if there are fewer), each hashed to 64
bits; a bit is set if it is set in more than half of the hashes.

Links (fingerprints that differ in at most ``distance`` bits) are searched
among distinct fingerprints, in parts that Spark deals out. The 64 bits are
cut into ``distance + 2`` blocks; two linked fingerprints agree in two
blocks at least, so they meet in the part of one choice of two blocks. A
part that holds many fingerprints is dealt out again, by two of as many
blocks of the bits that are still free, which loses nothing either, and so
on until no part is large. Inside a
part the fingerprints are sorted by Gray rank, so that neighbours differ in
few bits; the index above them is a tree whose nodes hold the bits that all
below them share, as a mask and a pattern. A pair of nodes is passed over
with all that is below it when the shared bits alone differ too often, or
when all below it is already linked.

A part reports, for each fingerprint that has a link, one representative of
those it reaches there, so rows stay linear in the fingerprints however many
pairs there are. Components are then found on Spark.

Defined cases: null, empty and blank texts have fingerprint zero and are
linked like any other; a very long text is hashed whole, so many shingles
at a time; a null id counts in no minimum, and a component without ids has
none; repeated rows each have a row; an empty table gives no rows; further
columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vertexloom.llm.common import checked_join, counted_join, small_batches, table, text_of, written
from vertexloom.llm.components import components

DISTANCE = 4
#: Parts of more fingerprints are dealt out again; up to LEAF are compared directly.
HOT_PART, LEAF = 20_000, 32
HASHED_TOGETHER = 255 * 256
#: Fixed value: the seed of the shingles' XXH64.
SEED = 42


def fingerprint(text: str, size: int) -> int:
    import xxhash

    words = text.encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    last = max(1, len(words) - size + 1)
    starts, ends = starts[:last].tolist(), ends[min(size, len(words)) - 1 :].tolist()
    hash64, ones, n = xxhash.xxh64_intdigest, np.zeros(64, np.int64), len(starts)
    for at in range(0, n, HASHED_TOGETHER):
        some = [hash64(joined[a:b], SEED) for a, b in zip(starts[at : at + HASHED_TOGETHER], ends[at : at + HASHED_TOGETHER], strict=True)]
        bits = np.unpackbits(np.array(some, np.uint64).view(np.uint8), bitorder="little")
        whole = len(some) // 255 * 255
        # Sums of 255 bits fit in a byte, which numpy adds fastest.
        ones += np.add.reduce(bits[: whole * 64].reshape(-1, 255, 64), axis=1, dtype=np.uint8).sum(0, dtype=np.int64)
        ones += bits[whole * 64 :].reshape(-1, 64).sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, size: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id and fp, the fingerprint as a signed 64-bit integer."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col), text_of(F.col(text_col)).alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(text.as_py(), size) for text in batch.column(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(fps, pa.int64())], names=names)

    schema = rows.drop("__text").schema.add("fp", "long")
    names = schema.names
    return rows.mapInArrow(run, schema)


def block_masks(free: list[int], blocks: int) -> list[int]:
    """Masks of every choice of two of ``blocks`` blocks of the bits in ``free``, as signed integers."""
    cut = [free[len(free) * i // blocks : len(free) * (i + 1) // blocks] for i in range(blocks)]
    masks = [sum(1 << b for b in [*x, *y]) for x, y in combinations(cut, 2)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Place of each code in the Gray sequence."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class Links:
    """Linked codes of some parts: a forest that is merged link by link."""

    def __init__(self):
        self.above: dict[int, int] = {}

    def root(self, x: int) -> int:
        above = self.above
        while (up := above.get(x, x)) != x:
            above[x] = x = above.get(up, up)
        return x

    def join(self, a: int, b: int) -> None:
        a, b = self.root(a), self.root(b)
        if a != b:
            self.above[max(a, b)] = min(a, b)

    def rows(self) -> list[tuple[int, int]]:
        return [(x, self.root(x)) for x in self.above]


def _close(x: np.ndarray, y: np.ndarray, distance: int) -> np.ndarray:
    return np.bitwise_count(x ^ y) <= distance


def search_part(codes: np.ndarray, distance: int, links: Links) -> None:
    """Link the codes of one part by its Gray-order tree."""
    codes = codes[np.argsort(gray_rank(codes))]
    leaves = -(-len(codes) // LEAF)
    bounds = [(i * LEAF, min(len(codes), (i + 1) * LEAF)) for i in range(leaves)]
    # levels[0] has the leaves; a node is (from, to, the bits that all below share, what they are)
    levels = [[(a, b, ~(np.bitwise_and.reduce(codes[a:b]) ^ np.bitwise_or.reduce(codes[a:b])), codes[a]) for a, b in bounds]]
    while len(levels[-1]) > 1:
        low = levels[-1]
        levels.append([low[i] if i + 1 == len(low) else (low[i][0], low[i + 1][1], low[i][2] & low[i + 1][2] & ~(low[i][3] ^ low[i + 1][3]), low[i][3]) for i in range(0, len(low), 2)])
    whole: dict[tuple[int, int], bool] = {}

    def united(a: int, b: int) -> bool:
        """Whether all codes of a node are linked; once so, it stays so."""
        if not whole.get((a, b)):
            root = links.root(int(codes[a]))
            whole[(a, b)] = all(links.root(int(c)) == root for c in codes[a + 1 : b])
        return whole[(a, b)]

    todo = [(len(levels) - 1, 0, 0)]
    for i in range(leaves):
        todo.append((0, i, i))
    while todo:
        level, i, j = todo.pop()
        (a, b, mask_a, code_a), (c, d, mask_c, code_c) = levels[level][i], levels[level][j]
        if i != j and int(np.bitwise_count((code_a ^ code_c) & mask_a & mask_c)) > distance:
            continue
        if links.root(int(codes[a])) == links.root(int(codes[c])) and united(a, b) and united(c, d):
            continue
        if level == 0:
            x, y = np.nonzero(_close(codes[a:b, None], codes[None, c:d], distance))
            for p, q in zip((x + a).tolist(), (y + c).tolist(), strict=True):
                if p < q:
                    links.join(int(codes[p]), int(codes[q]))
            continue
        below = len(levels[level - 1])
        for p in {2 * i, min(2 * i + 1, below - 1)}:
            for q in {2 * j, min(2 * j + 1, below - 1)}:
                if i != j or p <= q:
                    todo.append((level - 1, p, q))


def _search(distance: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = np.empty(0, np.int64), np.empty(0, np.uint64)
        for batch in batches:
            key, code = (np.concatenate((old, new)) for old, new in zip(rest, (batch.column(0).to_numpy(), batch.column(1).to_numpy().view(np.uint64)), strict=True))
            cut = int(np.searchsorted(key, key[-1])) if len(key) else 0  # the last part may go on in the next batch
            rest = key[cut:], code[cut:]
            yield _linked(key[:cut], code[:cut])
        yield _linked(*rest)

    def _linked(key: np.ndarray, code: np.ndarray) -> pa.RecordBatch:
        links = Links()
        if len(key):
            starts = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
            sizes = np.diff(np.append(starts, len(key)))
            small = np.repeat(sizes <= LEAF, sizes)
            for gap in range(1, min(LEAF, len(key))):
                at = np.flatnonzero((key[gap:] == key[:-gap]) & small[gap:])
                if not len(at):
                    break
                at = at[_close(code[at], code[at + gap], distance)]
                for a, b in zip(code[at].tolist(), code[at + gap].tolist(), strict=True):
                    links.join(a, b)
            for a, n in zip(starts[sizes > LEAF].tolist(), sizes[sizes > LEAF].tolist(), strict=True):
                search_part(code[a : a + n], distance, links)
        rows = np.array(links.rows(), np.uint64).reshape(-1, 2).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(rows[:, 0]), pa.array(rows[:, 1])], names=["u", "v"])

    return run


def _dealt(distance: int):
    """(fp, mask) -> the same once for each choice of two blocks of the bits that are free of the mask; (fp, mask) itself where too few are free."""
    blocks = distance + 2
    more: dict[int, np.ndarray] = {}

    def masks(mask: int) -> np.ndarray:
        if mask not in more:
            free = [b for b in range(64) if not mask >> b & 1]
            more[mask] = np.array([mask | m for m in block_masks(free, blocks)] if len(free) >= blocks else [mask], np.int64)
        return more[mask]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp, mask = (batch.column(i).to_numpy() for i in (0, 1))
            for m in np.unique(mask).tolist():
                new, some = masks(m), fp[mask == m]
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(some, len(new))), pa.array(np.tile(new, len(some)))], names=["fp", "mask"])

    return run


def parts_of(codes: DataFrame, distance: int, hot: int) -> DataFrame:
    """(key, fp) of every part that a fingerprint is in; those of more than ``hot`` are dealt again, while enough bits are free."""
    masks = F.array(*[F.lit(m) for m in block_masks(list(range(64)), distance + 2)])
    parts, done, free = codes.select("fp", F.explode(masks).alias("mask")), None, 64
    key = F.xxhash64("mask", F.col("fp").bitwiseAND(F.col("mask"))).alias("key")
    while True:
        keyed = parts.select("fp", "mask", key)
        free -= 2 * (free // (distance + 2))
        large = keyed.groupBy("key").count().filter(F.col("count") > hot).withColumnRenamed("count", "n")
        large = written(large, "simhash-large") if free >= distance + 2 else None
        now = keyed if large is None or large.isEmpty() else counted_join(keyed, large.withColumn("large", F.lit(True)), ["key"], "left", "n")
        cold = (now.filter("large is null") if "large" in now.columns else now).select("key", "fp")
        done = cold if done is None else done.unionByName(cold)
        if "large" not in now.columns:
            return done
        parts = written(now.filter("large").select("fp", "mask").mapInArrow(_dealt(distance), "fp long, mask long").distinct(), "simhash-again")


def links_between(codes: DataFrame, distance: int = DISTANCE, hot: int = HOT_PART) -> DataFrame:
    """Links (u, v) that connect what the pairs of distinct ``fp`` at most ``distance`` apart connect."""
    parts = parts_of(codes, distance, hot)
    return parts.repartition("key").sortWithinPartitions("key").mapInArrow(_search(distance), "u long, v long").distinct()


def near_groups(docs: DataFrame, size: int = 5, distance: int = DISTANCE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: the id, fp and component_id, the smallest id that links reach."""
    fps = written(fingerprints(docs, size, id_col, text_col), "simhash-fps")
    codes = written(fps.groupBy("fp").agg(F.min(id_col).alias("__first"), F.count(F.lit(1)).alias("__n")), "simhash-codes")
    roots = written(components(links_between(codes.select("fp"), distance)).withColumnRenamed("node", "fp"), "simhash-roots")
    linked = written(checked_join(codes, roots, "fp", "inner"), "simhash-linked")
    firsts = written(linked.groupBy("root").agg(F.min("__first").alias("component_id"), F.count(F.lit(1)).alias("__codes")), "simhash-firsts")
    named = counted_join(linked, firsts, ["root"], "inner", "__codes").select("fp", "component_id", "__n")
    copies = checked_join(codes.filter("__n > 1"), roots, "fp", "left_anti").select("fp", F.col("__first").alias("component_id"), "__n")
    # Most fingerprints have one document and no link: such a document is a component by itself.
    several = written(named.unionByName(copies), "simhash-several")
    return counted_join(fps, several, ["fp"], "left", "__n").select(id_col, "fp", F.coalesce("component_id", id_col).alias("component_id"))


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = near_groups(table(spark, sf_dir, "documents"), size=4)
    return rows.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
