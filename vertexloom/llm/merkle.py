"""A Merkle manifest of a table: one digest for all of it, and for each row what proves that it belongs.

Every row is a leaf. The leaves of a tree are put in order over the cluster,
and cut into aligned subtrees of up to ``SPAN`` leaves, each of which one
task hashes up to its root. The roots of a tree's subtrees are the leaves of
its next tier, and so on until one is left; the roots of all trees, in their
order, make a tree of their own.

A subtree is kept as one array of digests in van Emde Boas layout: a tree of
some levels is cut at half its height, its top comes first, then the trees
below it from left to right, each laid out likewise. Where a node lies
follows from its level and number by arithmetic alone, so that the subtree is
built and siblings are found without links, and a path from leaf to root
touches few stretches of the array whatever the size of a cache line.

A proof has, level by level, the siblings to the left and to the right; a
tier's proofs are handed down to the tier below by tree and subtree, so that
no task sees more than a subtree and the path above it.

Defined cases: a null field is ``-`` in a leaf, which no other value is; a
null tree comes first; a null id comes after all others in its tree; rows
that share an id are ordered by their leaves, and rows repeated whole are
alike in all they return but for their siblings; a lone leaf is its tree's
root, and a lone tree's root the manifest's; a very long text is hashed like
any other; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vertexloom.llm.common import checked_join, lower_ascii, small_batches, table, written

#: Children of a node; levels above the leaves of a whole subtree, and its leaves.
ARITY, HEIGHT = 8, 4
SPAN = ARITY**HEIGHT
#: Fixed value: the ids of every third remainder of crc32 are tampered with in the query.
TAMPERED = 3


def leaf(*fields: Column) -> Column:
    """Digest of a row: each field's UTF-8 length, a colon and the field, or a dash for a null."""

    def part(field: Column) -> Column:
        text = field.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*map(part, fields)), 256)


def size(levels: int) -> int:
    """Nodes of a whole tree of so many levels."""
    return (ARITY**levels - 1) // (ARITY - 1)


@lru_cache
def address(levels: int, level: int) -> np.ndarray:
    """Where the nodes of one level lie in the layout of a tree of so many levels, from left to right; level 0 is the root."""
    number = np.arange(ARITY**level)
    if levels == 1:
        return number
    top = levels // 2
    if level < top:
        return address(top, level)
    tree, inside = np.divmod(number, ARITY ** (level - top))
    return size(top) + tree * size(levels - top) + address(levels - top, level - top)[inside]


def height_of(leaves: int) -> int:
    """Levels above so many leaves until one node is left."""
    return next(h for h in range(64) if ARITY**h >= leaves)


def built(leaves: list[bytes], height: int) -> np.ndarray:
    """The layout of a tree over up to ``ARITY ** height`` leaves; nodes that aren't there are empty."""
    nodes = np.zeros(size(height + 1), "S64")
    nodes[address(height + 1, height)[: len(leaves)]] = leaves
    count = len(leaves)
    for level in range(height, 0, -1):
        children = nodes[address(height + 1, level)]
        count = -(-count // ARITY)
        nodes[address(height + 1, level - 1)[:count]] = [sha256(b"".join(children[ARITY * k : ARITY * (k + 1)].tolist())).hexdigest() for k in range(count)]
    return nodes


def paths(nodes: np.ndarray, height: int, count: int) -> Iterator[list[str]]:
    """Of each leaf, from left to right, the siblings before and after it, then those of its parent, up to the root."""
    levels = [nodes[address(height + 1, level)].astype(str).tolist() for level in range(height, 0, -1)]
    for number in range(count):
        path = []
        for digests in levels:
            first = number // ARITY * ARITY
            path += ["".join(digests[first:number]), "".join(digests[number + 1 : first + ARITY])]
            number //= ARITY
        yield path


def folded(digest: str, path: list[str]) -> str:
    """The root that a leaf and its siblings give; none are left out where a run has one node, as it is hashed too."""
    for before, after in zip(path[::2], path[1::2], strict=True):
        digest = sha256((before + digest + after).encode()).hexdigest()
    return digest


def placed(rows: DataFrame, *order: Column) -> DataFrame:
    """Written rows with ``at``, their place in their ``tree``, and ``of``, how many it has. Rows are sorted over the cluster, those that are alike by where they are in the table, so that a large tree is in many tasks."""
    order = ("tree", *order, "__row")
    sorted_rows = rows.withColumn("__row", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order).drop("__row")
    numbered = written(sorted_rows.select("*", F.spark_partition_id().alias("__part"), F.monotonically_increasing_id().alias("__id")), "merkle-sorted")
    tree = Window.partitionBy("tree")
    parts = numbered.groupBy("tree", "__part").agg(F.min("__id").alias("first"), F.count(F.lit(1)).alias("n"))
    earlier = F.coalesce(F.sum("n").over(tree.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shifts = written(parts.select("tree", "__part", (earlier - F.col("first")).alias("shift"), F.sum("n").over(tree).alias("of")), "merkle-parts")
    return checked_join(numbered, shifts, ["tree", "__part"], "inner").withColumn("at", F.col("__id") + F.col("shift")).drop("__part", "__id", "shift")


def _blocks(rows: DataFrame, payload: list[str]) -> DataFrame:
    """One row for each subtree of ``rows`` (tree, at, of, digest and payload): its number, layout, root ``top``, and the payload of its leaves in order; written."""
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}

    def block(group: pa.Table) -> pa.Table:
        group = group.sort_by("at")
        of, n = group["of"][0].as_py(), group.num_rows
        height = height_of(n) if of <= SPAN else HEIGHT
        nodes = built([d.encode() for d in group["digest"].to_pylist()], height)
        values = [group["tree"][:1], group["block"][:1], group["of"][:1], pa.array([n], pa.int32()), pa.array([height], pa.int32()), pa.array([nodes.tobytes()], pa.binary()), pa.array([nodes[address(height + 1, 0)[0]].decode()])]
        lists = [pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), group[p].combine_chunks()) for p in payload]
        return pa.table([*values, *lists], names=["tree", "block", "of", "n", "height", "nodes", "top", *payload])

    schema = f"tree string, block long, of long, n int, height int, nodes binary, top string{''.join(f', {p} array<{kinds[p]}>' for p in payload)}"
    grouped = rows.withColumn("block", F.floor(F.col("at") / SPAN)).select("tree", "block", "at", "of", "digest", *payload).groupBy("tree", "block")
    return written(grouped.applyInArrow(block, schema), "merkle-blocks")


def tiers(rows: DataFrame, payload: list[str]) -> list[DataFrame]:
    """The subtrees of ``placed`` rows, then those over their roots, up to one for each tree."""
    out = [_blocks(rows, payload)]
    while True:
        several = out[-1].filter(F.col("of") > SPAN)
        if several.isEmpty():
            return out
        roots = several.select("tree", F.col("block").alias("at"), F.ceil(F.col("of") / SPAN).alias("of"), F.col("top").alias("digest"))
        out.append(_blocks(roots, []))


def roots(levels: list[DataFrame]) -> DataFrame:
    """``tree, digest``: the root of each tree."""
    out = None
    for blocks in levels:
        own = blocks.filter(F.col("of") <= SPAN).select("tree", F.col("top").alias("digest"))
        out = own if out is None else out.unionByName(own)
    return out


def traced(levels: list[DataFrame], above: DataFrame) -> DataFrame:
    """The lowest tier's subtrees, each with what ``above`` (tree, path and more) has for its tree, the path begun with that from the subtree's root to the tree's."""
    more = [f for f in above.schema if f.name not in ("tree", "path")]

    def down(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                nodes = np.frombuffer(row["nodes"], "S64")
                whole = [own + row["path"] for own in paths(nodes, row["height"], row["n"])]
                first = row["block"] * SPAN
                values = [pa.array([row["tree"]] * row["n"], pa.string()), pa.array(range(first, first + row["n"]), pa.int64()), pa.array(whole, pa.list_(pa.string()))]
                yield pa.RecordBatch.from_arrays([*values, *[pa.array([row[f.name]] * row["n"], pa.string()) for f in more]], names=["tree", "block", "path", *[f.name for f in more]])

    handed = None
    for blocks in reversed(levels):
        out = blocks.filter(F.col("of") <= SPAN).join(above, "tree")
        if handed is not None:
            out = out.unionByName(blocks.filter(F.col("of") > SPAN).join(handed, ["tree", "block"]))
        if blocks is not levels[0]:
            schema = "tree string, block long, path array<string>" + "".join(f", {f.name} string" for f in more)
            handed = written(out.mapInArrow(down, schema), "merkle-paths")
    return out


def _each(blocks: DataFrame, schema: str, columns: Callable[[dict, Iterator[list[str]]], list]) -> DataFrame:
    """A row for each leaf of ``traced`` subtrees: the columns that a subtree and its leaves' whole paths give."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                nodes = np.frombuffer(row["nodes"], "S64")
                row["leaves"] = nodes[address(row["height"] + 1, row["height"])][: row["n"]].astype(str).tolist()
                whole = (own + row["path"] for own in paths(nodes, row["height"], row["n"]))
                yield pa.RecordBatch.from_arrays([pa.array(v, kind) for v, kind in zip(columns(row, whole), kinds, strict=True)], names=names)

    from pyspark.sql.pandas.types import to_arrow_type

    fields = blocks.sparkSession.createDataFrame([], schema).schema
    names, kinds = fields.names, [to_arrow_type(f.dataType) for f in fields]
    return blocks.mapInArrow(run, schema)


def manifest(docs: DataFrame, fields: list[str], changed: Callable[[dict[str, Column]], Column] | None = None, id_col: str = "doc_id", tree_col: str = "lang") -> DataFrame:
    """A row for each document: the id, its leaf, its tree's root ``subroot``, the ``root``, ``path`` (its siblings before and after it, level by level) and ``folded_root``.

    ``folded_root`` comes from the path and the document's present leaf:
    ``changed`` makes one of the fields' columns, null where a document is as
    it was. Equal to ``root``, it proves the document.
    """
    small_batches(docs.sparkSession)
    each = {f: F.col(f) for f in fields}
    tree = F.coalesce(F.concat(F.lit("="), F.col(tree_col).cast("string")), F.lit(""))
    now = F.lit(None).cast("string") if changed is None else changed(each)
    rows = docs.select(tree.alias("tree"), F.col(id_col).alias("id"), leaf(*each.values()).alias("digest"), now.alias("changed"))
    own = tiers(placed(written(rows, "merkle-leaves"), F.col("id").asc_nulls_last(), F.col("digest"), F.col("changed")), ["id", "changed"])

    subroots = written(roots(own).select(F.lit("").alias("tree"), F.col("tree").alias("id"), "digest"), "merkle-roots")
    upper = tiers(placed(subroots, F.col("id")), ["id"])
    top = roots(upper).select("tree", F.array().cast("array<string>").alias("path"), F.col("digest").alias("root"))
    above = _each(traced(upper, top), "tree string, path array<string>, subroot string, root string", lambda row, whole: [row["id"], list(whole), row["leaves"], [row["root"]] * row["n"]])

    def of_document(row: dict, whole: Iterator[list[str]]) -> list:
        all_paths = list(whole)
        back = [folded(new or old, path) for new, old, path in zip(row["changed"], row["leaves"], all_paths, strict=True)]
        return [row["id"], row["leaves"], [row["subroot"]] * row["n"], [row["root"]] * row["n"], all_paths, back]

    kind = docs.schema[id_col].dataType.simpleString()
    lowest = traced(own, written(above, "merkle-subroots"))
    return _each(lowest, f"id {kind}, leaf string, subroot string, root string, path array<string>, folded_root string", of_document).withColumnRenamed("id", id_col)


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third document's text, by crc32 of its id, is tampered with by lower-casing it."""
    tampered = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(TAMPERED)) == 0

    def lowered(each: dict[str, Column]) -> Column:
        return F.when(tampered, leaf(*[lower_ascii(c) if name == "text" else c for name, c in each.items()]))

    rows = manifest(table(spark, sf_dir, "documents"), ["doc_id", "source", "lang", "n_chars", "text"], lowered)
    proof = F.sha2(F.array_join("path", ""), 256)
    return rows.select("doc_id", "leaf", "subroot", "root", proof.alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def _level_sql(k: int, name: str, tree: str) -> str:
    """Nodes of level k + 1, and every leaf's proof and folded value after level k; a tree's last node goes up as it is."""
    return f"""
{name}{k + 1} AS (
  SELECT *, count(*) OVER (PARTITION BY tree) AS c FROM (
    SELECT tree, i // 8 AS i, CASE WHEN any_value(c) = 1 THEN any_value(h) ELSE sha256(string_agg(h, '' ORDER BY i)) END AS h FROM {name}{k} GROUP BY tree, i // 8)),
{name}s{k} AS (
  SELECT f.r, coalesce(string_agg(s.h, '' ORDER BY s.i) FILTER (s.i < f.i), '') AS before, coalesce(string_agg(s.h, '' ORDER BY s.i) FILTER (s.i > f.i), '') AS after, any_value(s.c) AS c
  FROM {name}f{k} AS f JOIN {name}{k} AS s ON f.tree = s.tree AND f.i // 8 = s.i // 8 GROUP BY f.r),
{name}f{k + 1} AS (
  SELECT f.r, f.tree, f.i // 8 AS i, f.proof || s.before || s.after AS proof, CASE WHEN s.c = 1 THEN f.v ELSE sha256(s.before || f.v || s.after) END AS v
  FROM {name}f{k} AS f JOIN {name}s{k} AS s ON f.r = s.r),"""


def _leaf_sql(text: str) -> str:
    fields = ("CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text)
    return "sha256(" + " || ".join(f"coalesce(CAST(strlen({f}) AS VARCHAR) || ':' || {f}, '-')" for f in fields) + ")"


#: Levels of a language's tree and of the tree of subroots, enough for 2,097,152 documents and 512 languages.
LEVELS_SQL, UPPER_LEVELS_SQL = 7, 3

OP13_SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce('=' || lang, '') AS tree, {_leaf_sql("text")} AS leaf,
         {_leaf_sql("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS low,
         xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: [ord(x)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
             lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, 3988292384 * (c & 1)) END), 4294967295) % 3 = 0 AS tampered
  FROM documents),
p AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS LAST, leaf) - 1 AS i, count(*) OVER (PARTITION BY tree) AS c FROM d),
n0 AS (
  SELECT tree, i, leaf AS h, c FROM p),
nf0 AS (
  SELECT r, tree, i, '' AS proof, CASE WHEN tampered THEN low ELSE leaf END AS v FROM p),
{"".join(_level_sql(k, "n", "tree") for k in range(LEVELS_SQL))}
u AS (
  SELECT tree AS lang, h, row_number() OVER (ORDER BY tree) - 1 AS i, count(*) OVER () AS c FROM n{LEVELS_SQL}),
m0 AS (
  SELECT '' AS tree, i, h, c FROM u),
mf0 AS (
  SELECT f.r, '' AS tree, u.i, f.proof, f.v FROM nf{LEVELS_SQL} AS f JOIN u ON f.tree = u.lang),
{"".join(_level_sql(k, "m", "tree") for k in range(UPPER_LEVELS_SQL))}
t AS (
  SELECT h AS root FROM m{UPPER_LEVELS_SQL})
SELECT p.doc_id, p.leaf, u.h AS subroot, t.root, sha256(f.proof) AS proof_sha256, f.v AS folded_root, f.v = t.root AS verified
FROM p JOIN u ON p.tree = u.lang JOIN mf{UPPER_LEVELS_SQL} AS f ON p.r = f.r CROSS JOIN t
"""
