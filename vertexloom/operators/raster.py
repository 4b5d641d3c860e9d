"""Operators on label images ``image_id, y, x, label`` and the rings around their objects.

Neighbours come from windows along rows and columns, so that work is split
by image and line, never by label. All labels are handled in one pass; an
image's pixels fill its rectangle, and pixels without a label (null) are an
object like any other. All are lazy but ``trace_rings`` and what calls it,
which write their steps when they are called.

Outlines are traced by straight pieces, from turn to turn, so that what is
chained grows with the turns and not with the length of the borders.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vertexloom.functions.settle import settled
from vertexloom.operators.roi import roi_names_from_labels, smooth_movable

OBJECT = ["image_id", "label"]
#: An object's key in joins: ``none`` says that its label is null.
KEY = [*OBJECT, "none"]
#: Edges of one image, or else of one object, that are chained in one task; those of larger objects are chained by joins.
GATHERED = 1 << 17
#: Rings done in one round that are broadcast at most; each is a few numbers.
CLOSED_TOGETHER = 200_000
SIDES = ["upper", "left", "lower", "right"]
#: Where two edges start: lower and upper edges end there if the pixels are north-west and south-east, and turn left; left and right ones if they are north-east and south-west, and turn right.
TURNS = {"lower": "right", "upper": "left", "left": "upper", "right": "lower"}


def distinct_labels(labels: DataFrame) -> DataFrame:
    return labels.select("image_id", "label").distinct()


def label_mask(labels: DataFrame, low: float, high: float | None = None) -> DataFrame:
    """Pixels from ``low`` to ``high``; of the one label ``low`` without it."""
    return labels.filter(F.col("label").between(low, low if high is None else high))


def _lines() -> tuple:
    return Window.partitionBy("image_id", "y").orderBy("x"), Window.partitionBy("image_id", "x").orderBy("y")


def _same(neighbour: str) -> Column:
    """Whether there is a pixel there and it has the pixel's label."""
    return F.col(neighbour).isNotNull() & F.col(f"{neighbour}.label").eqNullSafe(F.col("label"))


def _beside(labels: DataFrame) -> DataFrame:
    """Pixels with those to the west, east, north and south as structs, null where there is none."""
    (across, down), pixel = _lines(), F.struct("label")
    return labels.withColumns({"w": F.lag(pixel).over(across), "e": F.lead(pixel).over(across), "n": F.lag(pixel).over(down), "s": F.lead(pixel).over(down)})


def boundary_edges(labels: DataFrame) -> DataFrame:
    """Unit edges between a pixel and what isn't of its label, the pixel to the left of each; side says which one of its pixel."""
    sides = (("upper", "n", (1, 0), (0, 0)), ("left", "w", (0, 0), (0, 1)), ("lower", "s", (0, 1), (1, 1)), ("right", "e", (1, 1), (1, 0)))
    made = F.array(*[F.when(~_same(beside), F.struct(F.lit(side).alias("side"), (F.col("x") + a).alias("x0"), (F.col("y") + b).alias("y0"), (F.col("x") + c).alias("x1"), (F.col("y") + d).alias("y1"))) for side, beside, (a, b), (c, d) in sides])
    return _beside(labels).select("image_id", "label", F.explode(F.array_compact(made)).alias("e")).select("image_id", "label", "e.*")


def _around(labels: DataFrame) -> DataFrame:
    """Pixels with all eight neighbours as structs, null where there is none: one window along rows, one along columns."""
    across, down = _lines()
    row = labels.select("image_id", "y", "x", "label", F.lag(F.struct("label")).over(across).alias("w"), F.lead(F.struct("label")).over(across).alias("e"))
    line = F.struct("label", "w", "e")
    both = row.withColumns({"n": F.lag(line).over(down), "s": F.lead(line).over(down)})
    return both.withColumns({"nw": F.col("n.w"), "ne": F.col("n.e"), "sw": F.col("s.w"), "se": F.col("s.e"), "o": F.struct("label")})


def _corner(nw: str, ne: str, sw: str, se: str) -> tuple[Column, Column]:
    """Whether four pixels meet at a corner, and the corner's class by their labels."""
    four = (nw, ne, sw, se)
    inside = F.lit(True)
    for p in four:
        inside = inside & F.col(p).isNotNull()
    label = {p: F.col(f"{p}.label") for p in four}
    kinds = F.size(F.array_distinct(F.array(*label.values())))
    return inside, F.when(kinds == 1, "mono").when(kinds > 2, "three").when(label[nw].eqNullSafe(label[se]) & label[ne].eqNullSafe(label[sw]), "cross").otherwise("plain")


#: Of each side: the pixel behind it; where it starts and ends, from its pixel, and the four pixels around each; the neighbour and the diagonal one that say whether it goes on straight before and after; its line, and its place along it as it is walked.
_WALK = {
    "upper": ("n", (1, 0), (0, 0), ("n", "ne", "o", "e"), ("nw", "n", "w", "o"), ("e", "ne"), ("w", "nw"), "y", ("x", -1)),
    "left": ("w", (0, 0), (0, 1), ("nw", "n", "w", "o"), ("w", "o", "sw", "s"), ("n", "nw"), ("s", "sw"), "x", ("y", 1)),
    "lower": ("s", (0, 1), (1, 1), ("w", "o", "sw", "s"), ("o", "e", "s", "se"), ("w", "sw"), ("e", "se"), "y", ("x", 1)),
    "right": ("e", (1, 1), (1, 0), ("o", "e", "s", "se"), ("n", "ne", "o", "e"), ("s", "se"), ("n", "ne"), "x", ("y", -1)),
}


def boundary_segments(labels: DataFrame, fixed: bool = False) -> DataFrame:
    """As ``boundary_edges``, but edges in a line are one piece, from turn to turn.

    With ``fixed`` pieces end at corners that may not move, too (image
    borders, three labels, crossings), and ``movable`` says of each whether
    the corner where it starts may. Only the pixels where a piece begins or
    ends leave the windows; the two are paired along their line.
    """
    made = []
    for side, (behind, (a, b), (c, d), start, end, before, after, line, (along, sign)) in _WALK.items():
        def breaks(corner: tuple, straight: tuple) -> Column:
            inside, kind = _corner(*corner)
            return (~_same(straight[0]) | _same(straight[1])) | (F.lit(fixed) & ~(inside & ~kind.isin("three", "cross")))

        inside, kind = _corner(*start)
        begins, ends = breaks(start, before), breaks(end, after)
        piece = F.struct(
            F.lit(side).alias("side"), begins.alias("begins"), ends.alias("ends"), F.col(line).alias("line"), (F.col(along) * sign).alias("along"), (F.col("x") + a).alias("x0"), (F.col("y") + b).alias("y0"), (F.col("x") + c).alias("x1"), (F.col("y") + d).alias("y1"),
            (inside & ~kind.isin("three", "cross")).alias("movable"),
        )
        made.append(F.when(~_same(behind) & (begins | ends), piece))
    rows = _around(labels).select("image_id", "label", F.explode(F.array_compact(F.array(*made))).alias("p")).select("image_id", "label", "p.*")
    walked = Window.partitionBy("image_id", "label", "side", "line").orderBy("along")
    pieces = rows.withColumn("to", F.when(F.col("ends"), F.struct("x1", "y1")).otherwise(F.lead(F.struct("x1", "y1")).over(walked))).filter("begins")
    return pieces.select("image_id", "label", "side", "x0", "y0", "to.x1", "to.y1", *(["movable"] if fixed else []))


def corner_classes(labels: DataFrame) -> DataFrame:
    """Class of each lattice corner inside an image, by the four pixels around it, and whether a vertex there may move."""
    across, down = _lines()
    row = labels.select("image_id", "y", "x", F.struct("label").alias("o"), F.lag(F.struct("label")).over(across).alias("w"))
    four = row.withColumns({"n": F.lag("o").over(down), "nw": F.lag("w").over(down)})
    inside, kind = _corner("nw", "n", "w", "o")
    classed = four.filter(inside).select("image_id", "y", "x", kind.alias("corner"))
    return classed.withColumn("movable", ~F.col("corner").isin("three", "cross"))


def _chained(edges: pd.DataFrame) -> pd.DataFrame:
    """The rings of one image's or object's pieces, with arrays."""
    n, e, side = len(edges), edges["e"].to_numpy(), edges["side"].map({s: i for i, s in enumerate(SIDES)}).to_numpy()
    x0, y0, x1, y1 = (edges[c].to_numpy(np.int64) for c in ("x0", "y0", "x1", "y1"))
    label = np.unique(edges["label"].to_numpy(), return_inverse=True)[1].astype(np.int64) * 2 + edges["none"].to_numpy()
    low_x, low_y = min(x0.min(), x1.min()), min(y0.min(), y1.min())
    wide, high = max(x0.max(), x1.max()) - low_x + 1, max(y0.max(), y1.max()) - low_y + 1
    start, end = ((label * high + y - low_y) * wide + x - low_x for x, y in ((x0, y0), (x1, y1)))
    order = np.argsort(start, kind="stable")
    first, past = (np.searchsorted(start[order], end, where) for where in ("left", "right"))
    if (first == past).any():
        raise ValueError(f"edges of image {edges['image_id'].iloc[0]} don't close to rings: at {int(x1[first == past][0])}, {int(y1[first == past][0])} none goes on")
    turn = np.array([SIDES.index(TURNS[s]) for s in SIDES])
    after = order[first]
    other = order[np.minimum(first + 1, n - 1)]
    after = np.where((past - first > 1) & (side[after] != turn[side]), other, after)
    low, far, ahead, span = e.copy(), np.zeros(n, np.int64), after, 1
    while span < n:
        nearer = low[ahead] < low
        far = np.where(nearer, far[ahead] + span, far)
        low, ahead, span = np.minimum(low, low[ahead]), ahead[ahead], 2 * span
    _, ring, size = np.unique(np.stack((label, low)), axis=1, return_inverse=True, return_counts=True)
    sizes = size[ring.ravel()]
    named = {"image_id": edges["image_id"], "label": edges["label"], "none": edges["none"], "ring_id": low, "vertex_ix": (sizes - far) % sizes, "x": edges["x0"], "y": edges["y0"]}
    return pd.DataFrame(named | {c: edges[c] for c in edges.columns if c == "movable"})


def _doubled(edge: DataFrame) -> DataFrame:
    """The rings of pieces of any number: every piece learns the smallest one among the next 1, 2, 4, ... and how far it is.

    A ring is done once its smallest piece meets itself; its pieces then leave
    the state, so that later rounds have only the rings that are longer.
    """
    more = [c for c in edge.columns if c == "movable"]
    starts = edge.select(*KEY, F.col("x0").alias("x1"), F.col("y0").alias("y1"), F.col("e").alias("next"), F.col("side").alias("next_side"))
    joined = edge.join(starts, [*KEY, "x1", "y1"])
    two = F.count(F.lit(1)).over(Window.partitionBy(*KEY, "e")) > 1
    chosen = F.lit(False)
    for side, to in TURNS.items():
        chosen = chosen | ((F.col("side") == side) & (F.col("next_side") == to))
    succ = joined.withColumn("two", two).filter(~F.col("two") | chosen)
    state = settled(succ.select(*KEY, "e", "x0", "y0", *more, "next", F.col("e").alias("low"), F.lit(0).cast("long").alias("far")))
    if state.count() != edge.count():
        raise ValueError("edges of an image don't close to rings: at the end of one none goes on")
    span, rings = 1, None
    while not state.isEmpty():
        ahead = state.select(*KEY, F.col("e").alias("next"), F.col("next").alias("next2"), F.col("low").alias("low2"), F.col("far").alias("far2"))
        nearer = F.col("low2") < F.col("low")
        met = (F.col("low") == F.col("e")) & (F.col("low2") == F.col("e"))
        wide = state.join(ahead, [*KEY, "next"])
        state = settled(wide.select(*KEY, "e", "x0", "y0", *more, F.col("next2").alias("next"), F.least("low", "low2").alias("low"), F.when(nearer, F.col("far2") + span).otherwise(F.col("far")).alias("far"), F.when(met, F.col("far2") + span).alias("n")))
        closed = settled(state.filter("n is not null").select(*KEY, "low", "n"))
        few = F.broadcast(closed) if closed.count() <= CLOSED_TOGETHER else closed
        done = state.drop("n").join(few, [*KEY, "low"]).select(*KEY, F.col("low").alias("ring_id"), F.pmod(F.col("n") - F.col("far"), F.col("n")).alias("vertex_ix"), F.col("x0").alias("x"), F.col("y0").alias("y"), *more)
        rings = done if rings is None else rings.unionByName(done)
        state, span = settled(state.drop("n").join(few.drop("n"), [*KEY, "low"], "left_anti")), span * 2
    return rings


def trace_rings(edges: DataFrame, gathered: int = GATHERED) -> DataFrame:
    """Unit edges or straight pieces chained to closed rings: ring_ix and vertex_ix for the corner where each starts; a column ``movable`` goes along.

    The next one starts where one ends. Where two start, one turns left if the
    object's pixels are north-west and south-east (they stay apart) and right
    if they are north-east and south-west (they join). The smallest start, by
    row, column and side, is the ring's first vertex, and the ring is named by
    it; as that is always a turn, edges and pieces give rings of one name.
    Edges that don't close raise.

    Images of up to ``gathered`` edges are chained each in one task, and so
    are the objects of larger ones; the edges of larger objects are chained
    by joins, in rounds.
    """
    number = F.lit(0)
    for i, side in enumerate(SIDES):
        number = F.when(F.col("side") == side, i).otherwise(number)
    kind = {f.name: f.dataType.simpleString() for f in edges.schema}
    none = F.col("label").isNull()
    keyed = edges.withColumns({"none": none, "label": F.coalesce("label", F.lit(0).cast(kind["label"]))})
    edge = settled(keyed.withColumn("e", F.col("y0").cast("long") * (1 << 34) + F.col("x0").cast("long") * 4 + number))
    objects = settled(edge.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n")))
    images = objects.groupBy("image_id").agg(F.sum("n").alias("of_image"))
    large = settled(objects.join(images.filter(F.col("of_image") > gathered), "image_id"))
    schema = f"image_id {kind['image_id']}, label {kind['label']}, none boolean, ring_id long, vertex_ix long, x {kind['x0']}, y {kind['y0']}" + (", movable boolean" if "movable" in kind else "")
    if large.isEmpty():
        out = edge.groupBy("image_id").applyInPandas(_chained, schema)
    else:
        by_image = edge.join(large.select("image_id").distinct(), "image_id", "left_anti").groupBy("image_id").applyInPandas(_chained, schema)
        by_object = edge.join(large.filter(F.col("n") <= gathered).select(*KEY), KEY, "left_semi").groupBy(*KEY).applyInPandas(_chained, schema)
        rings = _doubled(edge.join(large.filter(F.col("n") > gathered).select(*KEY), KEY, "left_semi"))
        out = by_image.unionByName(by_object)
        out = out if rings is None else out.unionByName(rings)
    return out.withColumn("label", F.when(~F.col("none"), F.col("label"))).drop("none")


def simplify_rings(rings: DataFrame, mode: str = "all", corners: DataFrame | None = None) -> DataFrame:
    """Rings without vertices on a straight line: none dropped (keep_all), all such (all), or those at movable corners (movable)."""
    if mode not in ("keep_all", "all", "movable") or (mode == "movable" and corners is None):
        raise ValueError(f"unknown mode {mode}, or mode movable without corner classes")
    if mode == "keep_all":
        return rings
    keys = [*OBJECT, "ring_id"]
    w = Window.partitionBy(*keys).orderBy("vertex_ix")
    full = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    near = {"xb": F.coalesce(F.lag("x").over(w), F.last("x").over(full)), "yb": F.coalesce(F.lag("y").over(w), F.last("y").over(full)), "xa": F.coalesce(F.lead("x").over(w), F.first("x").over(full)), "ya": F.coalesce(F.lead("y").over(w), F.first("y").over(full))}
    straight = (F.col("x") - F.col("xb")) * (F.col("ya") - F.col("y")) == (F.col("y") - F.col("yb")) * (F.col("xa") - F.col("x"))
    marked = rings.withColumns(near).withColumn("straight", straight)
    if mode == "movable":
        marked = marked.join(corners.select("image_id", "y", "x", "movable"), ["image_id", "y", "x"], "left").withColumn("straight", F.col("straight") & F.coalesce("movable", F.lit(False)))
    kept = marked.filter(~F.col("straight"))
    return kept.select(*keys, (F.row_number().over(w) - 1).alias("vertex_ix"), "x", "y")


def vectorize_labels(labels: DataFrame, smooth: bool = True) -> DataFrame:
    """Label images as vertex tables with names; neighbours keep and move the same corners, so their borders stay shared.

    Straight stretches between corners that may move have no vertices, so
    pieces between turns and fixed corners are all that is traced.
    """
    rings = settled(trace_rings(boundary_segments(labels, fixed=True)))
    # Objects and their rings are numbered, not their vertices.
    each = rings.filter("vertex_ix = 0").select(*OBJECT, "ring_id")
    roi_ix = F.dense_rank().over(Window.partitionBy("image_id").orderBy("label")) - 1
    poly_ix = F.row_number().over(Window.partitionBy(*OBJECT).orderBy("ring_id")) - 1
    numbered = roi_names_from_labels(each.select(*OBJECT, "ring_id", roi_ix.alias("roi_ix"), poly_ix.alias("poly_ix"))).withColumnRenamed("label", "of")
    joined = rings.join(numbered, ["image_id", "ring_id"]).filter(F.col("label").eqNullSafe(F.col("of")))
    vertices = joined.select(F.col("image_id").alias("set_id"), "roi_ix", "poly_ix", "vertex_ix", F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"), "movable", "name")
    return smooth_movable(vertices) if smooth else vertices.drop("movable")


def label_stats(labels: DataFrame) -> DataFrame:
    """Area, bounds, centre and border length of each object."""
    border = F.lit(0)
    for beside in ("w", "e", "n", "s"):
        border = border + (~_same(beside)).cast("int")
    return _beside(labels).withColumn("border", border).groupBy(*OBJECT).agg(
        F.count(F.lit(1)).alias("area"), F.min("x").alias("min_x"), F.min("y").alias("min_y"), F.max("x").alias("max_x"), F.max("y").alias("max_y"), F.avg("x").alias("centre_x"), F.avg("y").alias("centre_y"), F.sum("border").alias("perimeter")
    )
