"""Chains of spatial transforms, on points and on images, and measures of image pairs.

A chain is ``chain_id, step, kind, params``: translation [tx, ty]; euler
[angle, tx, ty, cx, cy], a rotation about a centre and a shift; affine
[a, b, c, d, tx, ty, cx, cy], a 2 x 2 matrix about a centre and a shift.
Steps apply in order. The maths of transforms and measures is our own, from
their public definitions.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Steps of a chain that are folded together first.
BLOCK = 64
#: The cubic spline prefilter's pole and gain, and the pixels of a line that run together.
POLE, GAIN, RUN = 3**0.5 - 2, 6.0, 64
#: Pixels of a line that are smoothed together, and how many deviations a smoothing reaches.
STRIP, REACH = 64, 3.0
#: Empty bins on either side of a soft histogram, for the reach of its window.
PADDING = 2
#: The multiplier and modulus of the generator that draws places.
DRAW, MODULUS = 48271, 2147483647
#: Width of the slices of hashes in which a sample's pixels are counted.
SLICE = 2147483647 / 1024


def relink_chain(transforms: DataFrame) -> DataFrame:
    """Steps of each chain while they follow each other from 0, each with the one before it."""
    order = Window.partitionBy("chain_id").orderBy("step")
    linked = transforms.withColumns({"place": F.row_number().over(order) - 1, "prev_step": F.lag("step").over(order)})
    return linked.filter("place = step").drop("place")


def final_transform(transforms: DataFrame) -> DataFrame:
    """The last step of each chain."""
    return transforms.groupBy("chain_id").agg(F.max_by(F.struct("kind", "params"), "step").alias("last"), F.max("step").alias("step")).select("chain_id", "step", "last.kind", "last.params")


def _matrix(kind: Column, p: Column) -> Column:
    """Any step as an affine map: x' = a x + b y + tx, y' = c x + d y + ty."""
    cos, sin = F.cos(p[0]), F.sin(p[0])

    def made(a: Column, b: Column, c: Column, d: Column, tx: Column, ty: Column) -> Column:
        return F.struct(a.alias("a"), b.alias("b"), c.alias("c"), d.alias("d"), tx.alias("tx"), ty.alias("ty"))

    def centred(a: Column, b: Column, c: Column, d: Column, tx: Column, ty: Column, cx: Column, cy: Column) -> Column:
        return made(a, b, c, d, tx + cx - a * cx - b * cy, ty + cy - c * cx - d * cy)

    one, zero = F.lit(1.0), F.lit(0.0)
    shift = made(one, zero, zero, one, p[0], p[1])
    turn = centred(cos, -sin, sin, cos, p[1], p[2], p[3], p[4])
    affine = centred(p[0], p[1], p[2], p[3], p[4], p[5], p[6], p[7])
    return F.when(kind == "translation", shift).when(kind == "euler", turn).when(kind == "affine", affine)


def _folded(parts: DataFrame, keys: list[str], place: str) -> DataFrame:
    """Maps ``m`` of each group of ``keys``, applied in the order of ``place``, as one."""
    gathered = parts.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(F.col(place).alias("place"), "m"))).alias("steps"))
    same = F.struct(*[F.lit(v).alias(k) for k, v in (("a", 1.0), ("b", 0.0), ("c", 0.0), ("d", 1.0), ("tx", 0.0), ("ty", 0.0))])

    def after(s: Column, step: Column) -> Column:
        m = step["m"]
        return F.struct(
            (m["a"] * s["a"] + m["b"] * s["c"]).alias("a"), (m["a"] * s["b"] + m["b"] * s["d"]).alias("b"), (m["c"] * s["a"] + m["d"] * s["c"]).alias("c"), (m["c"] * s["b"] + m["d"] * s["d"]).alias("d"),
            (m["a"] * s["tx"] + m["b"] * s["ty"] + m["tx"]).alias("tx"), (m["c"] * s["tx"] + m["d"] * s["ty"] + m["ty"]).alias("ty"),
        )

    return gathered.select(*keys, F.aggregate("steps", same, after).alias("m"))


def compose_chain(transforms: DataFrame) -> DataFrame:
    """One affine map ``a, b, c, d, tx, ty`` for each chain: steps are folded in blocks, then the blocks in order, so that no group holds all steps of a long chain."""
    steps = transforms.select("chain_id", "step", F.floor(F.col("step") / BLOCK).alias("block"), _matrix(F.col("kind"), F.col("params")).alias("m"))
    blocks = _folded(steps, ["chain_id", "block"], "step")
    return _folded(blocks, ["chain_id"], "block").select("chain_id", "m.*")


def transform_points(points: DataFrame, transforms: DataFrame) -> DataFrame:
    """Points ``chain_id, x, y, ...`` mapped by their chain; those of an unknown chain stay."""
    joined = points.join(compose_chain(transforms), "chain_id", "left")
    known = F.col("a").isNotNull()
    x = F.when(known, F.col("a") * F.col("x") + F.col("b") * F.col("y") + F.col("tx")).otherwise(F.col("x"))
    y = F.when(known, F.col("c") * F.col("x") + F.col("d") * F.col("y") + F.col("ty")).otherwise(F.col("y"))
    return joined.select(*[{"x": x, "y": y}.get(c, F.col(c)).alias(c) for c in points.columns])


def invert_chain(transforms: DataFrame) -> DataFrame:
    """Chains of affine steps that undo each step, last first; a step without an inverse raises on use."""
    steps = transforms.withColumn("m", _matrix(F.col("kind"), F.col("params"))).select("chain_id", "step", "m.*")
    det = F.col("a") * F.col("d") - F.col("b") * F.col("c")
    a, b, c, d = F.col("d") / det, -F.col("b") / det, -F.col("c") / det, F.col("a") / det
    tx, ty = -(a * F.col("tx") + b * F.col("ty")), -(c * F.col("tx") + d * F.col("ty"))
    back = F.row_number().over(Window.partitionBy("chain_id").orderBy(F.desc("step"))) - 1
    return steps.select("chain_id", back.alias("step"), F.lit("affine").alias("kind"), F.array(a, b, c, d, tx, ty, F.lit(0.0), F.lit(0.0)).alias("params"))


def _lattice_cells(source: DataFrame, keys: list[str]) -> DataFrame:
    """Every lattice cell with the values of its corners, missing ones 0; the four pixels of a cell lie together, so most of them meet before they are shuffled."""
    corners = F.array(*[F.struct((F.col("sx") - i).alias("fx"), (F.col("sy") - j).alias("fy"), F.lit(2 * j + i).alias("at")) for i in (0, 1) for j in (0, 1)])
    parts = source.select(*keys, "v", F.explode(corners).alias("c")).select(*keys, "v", "c.*")
    return parts.groupBy(*keys, "fx", "fy").agg(*[F.coalesce(F.max(F.when(F.col("at") == k, F.col("v"))), F.lit(0.0)).alias(f"v{k}") for k in range(4)])


def _recursive(pixels: DataFrame, keys: list[str], line: str, along: str) -> DataFrame:
    """One axis of the prefilter: ``v`` of each line of pixels made to cubic spline coefficients, mirrored at the ends.

    ``c+[k] = 6 v[k] + POLE c+[k-1]``, then backwards ``c[k] = POLE (c[k+1] - c+[k])``.
    Both run in blocks of ``RUN`` pixels: a block's own part is a running sum
    of values over powers of the pole, and what the block before ends with
    comes in by the pole's powers. What the one before that ends with is less
    than any rounding by then.
    """
    place = [*keys, line]
    of_line = Window.partitionBy(*place)
    whole = of_line.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    n, k = F.col("n"), F.col(along)
    power = lambda e: F.pow(F.lit(POLE), e)
    sized = pixels.withColumn("n", F.count(F.lit(1)).over(whole))
    mirrored = F.when((k == 0) | (k == n - 1), power(k)).otherwise(power(k) + power(2 * n - 2 - k))
    begun = F.try_divide(F.sum(mirrored * F.col("v")).over(whole), 1 - power(2 * n - 2)) * GAIN

    def run(df: DataFrame, value: Column, first: Column, backwards: bool, name: str) -> DataFrame:
        """``out[k] = value[k] + POLE out[k-1]`` along the line, or against it, where ``out`` at its first pixel is ``first``; only the block walked last may be short."""
        order, walked = (F.desc(along), n - 1 - k) if backwards else (F.asc(along), k)
        in_block, in_line = Window.partitionBy(*place, "block").orderBy(order), of_line.orderBy(order)
        cut = df.withColumns({"block": F.floor(walked / RUN), "inner": walked % RUN, "in": value, "first": first})
        own = cut.withColumn("own", power(F.col("inner")) * F.sum(F.col("in") * power(-F.col("inner"))).over(in_block))
        before = own.withColumn("last", F.coalesce(F.lag("own").over(in_line), (F.col("first") - F.col("in")) / POLE))
        carried = before.withColumn("carried", F.first("last").over(in_block.rowsBetween(Window.unboundedPreceding, 0)))
        return carried.withColumn(name, F.col("own") + power(F.col("inner") + 1) * F.col("carried")).drop("block", "inner", "in", "first", "own", "last", "carried")

    forward = run(sized.withColumn("begun", begun), GAIN * F.col("v"), F.col("begun"), False, "plus")
    at_end = POLE / (POLE * POLE - 1) * (F.col("plus") + POLE * F.coalesce(F.lag("plus").over(of_line.orderBy(along)), F.col("plus")))
    back = run(forward.withColumn("ended", at_end), -POLE * F.col("plus"), F.col("ended"), True, "coefficient")
    value = F.when(n > 1, F.col("coefficient")).otherwise(F.col("v"))
    return back.select(*keys, "y", "x", value.alias("v"))


def spline_coefficients(pixels: DataFrame, keys: list[str]) -> DataFrame:
    """Coefficients of the cubic spline through an image's pixels ``keys, y, x, v``, which fill its rectangle."""
    return _recursive(_recursive(pixels.select(*keys, "y", "x", F.col("v").cast("double").alias("v")), keys, "y", "x"), keys, "x", "y")


def _spline_cells(pixels: DataFrame, keys: list[str]) -> DataFrame:
    """Each lattice cell with its sixteen coefficients, those beyond the border mirrored: four along the line by one window, four lines by another."""

    def four(value: str, order) -> Column:
        near = [F.lag(value).over(order), F.col(value), F.lead(value).over(order), F.lead(value, 2).over(order)]
        return F.array(F.coalesce(near[0], near[2], near[1]), near[1], F.coalesce(near[2], near[0], near[1]), F.coalesce(near[3], near[1]))

    line, column = Window.partitionBy(*keys, "y").orderBy("x"), Window.partitionBy(*keys, "x").orderBy("y")
    rows = spline_coefficients(pixels, keys).withColumns({"row": four("v", line), "last_x": F.lead("x").over(line).isNull()})
    return rows.select(*keys, F.col("x").alias("fx"), F.col("y").alias("fy"), four("row", column).alias("c"), "last_x", F.lead("y").over(column).isNull().alias("last_y"))


def _spline_weights(t: Column) -> list[Column]:
    """The cubic B-spline at the four places around one that lies ``t`` behind the second."""
    return [(1 - t) ** 3 / 6, (3 * t**3 - 6 * t**2 + 4) / 6, (-3 * t**3 + 3 * t**2 + 3 * t + 1) / 6, t**3 / 6]


def interpolated(places: DataFrame, pixels: DataFrame, keys: list[str], order: int = 1) -> DataFrame:
    """``places`` (keys, x, y and more) with ``v``, the value of their image there.

    Order 0 takes the nearest pixel, order 1 weighs the four around the place
    (pixels that aren't there are 0), order 3 is the cubic spline through all
    pixels. It is 0 outside; for the spline that is beyond the outermost pixels.
    """
    columns = places.columns
    if order == 0:
        near = places.withColumns({"fx": F.floor(F.col("x") + 0.5).cast("int"), "fy": F.floor(F.col("y") + 0.5).cast("int")})
        found = near.join(pixels.select(*keys, F.col("x").alias("fx"), F.col("y").alias("fy"), "v"), [*keys, "fx", "fy"], "left")
        return found.select(*columns, F.coalesce("v", F.lit(0.0)).alias("v"))
    low = places.withColumns({"wx": F.col("x") - F.floor("x"), "wy": F.col("y") - F.floor("y"), "fx": F.floor("x").cast("int"), "fy": F.floor("y").cast("int")})
    if order == 1:
        cells = _lattice_cells(pixels.select(*keys, F.col("x").alias("sx"), F.col("y").alias("sy"), "v"), keys)
        value = (1 - F.col("wy")) * ((1 - F.col("wx")) * F.col("v0") + F.col("wx") * F.col("v1")) + F.col("wy") * ((1 - F.col("wx")) * F.col("v2") + F.col("wx") * F.col("v3"))
    elif order == 3:
        cells, value = _spline_cells(pixels, keys), F.lit(0.0)
        for j, by_y in enumerate(_spline_weights(F.col("wy"))):
            for i, by_x in enumerate(_spline_weights(F.col("wx"))):
                value = value + by_y * by_x * F.col("c")[j][i]
        # A cell of the last column or row has places on that border only.
        value = F.when((~F.col("last_x") | (F.col("wx") == 0)) & (~F.col("last_y") | (F.col("wy") == 0)), value)
    else:
        raise ValueError(f"unknown order {order}")
    return low.join(cells, [*keys, "fx", "fy"], "left").select(*columns, F.coalesce(value, F.lit(0.0)).alias("v"))


def transform_image(pixels: DataFrame, transforms: DataFrame, order: int = 1) -> DataFrame:
    """Images ``image_id, chain_id, y, x, v`` resampled: each output pixel takes the value at its mapped place, 0 outside, by ``interpolated``."""
    keys = ["image_id", "chain_id"]
    grid = pixels.select(*keys, F.col("x").alias("ox"), F.col("y").alias("oy"), F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"))
    found = interpolated(transform_points(grid, transforms), pixels, keys, order)
    return found.select(*keys, F.col("oy").alias("y"), F.col("ox").alias("x"), "v")


def pair_similarity(pairs: DataFrame, bins: int = 32) -> DataFrame:
    """Mutual information and mean squared difference of pairs ``pair_id, y, x, fixed, moving``, from joint histograms."""
    ends = pairs.groupBy("pair_id").agg(*[f(c).alias(f"{n}_{c}") for c in ("fixed", "moving") for n, f in (("lo", F.min), ("hi", F.max))], F.avg((F.col("fixed") - F.col("moving")) ** 2).alias("mean_square"), F.count(F.lit(1)).alias("n"))

    def bin_of(c: str) -> Column:
        scaled = F.try_divide(F.col(c) - F.col(f"lo_{c}"), F.col(f"hi_{c}") - F.col(f"lo_{c}"))
        return F.least(F.floor(F.coalesce(scaled, F.lit(0.0)) * bins), F.lit(bins - 1))

    joint = pairs.join(ends, "pair_id").select("pair_id", bin_of("fixed").alias("bf"), bin_of("moving").alias("bm")).groupBy("pair_id", "bf", "bm").count()
    pair = Window.partitionBy("pair_id")
    shares = joint.withColumns({"n": F.sum("count").over(pair), "nf": F.sum("count").over(Window.partitionBy("pair_id", "bf")), "nm": F.sum("count").over(Window.partitionBy("pair_id", "bm"))})
    term = F.col("count") / F.col("n") * F.log(F.col("count") * F.col("n") / (F.col("nf") * F.col("nm")))
    return shares.groupBy("pair_id").agg(F.sum(term).alias("mutual_information")).join(ends.select("pair_id", "mean_square"), "pair_id")


def soft_histograms(pairs: DataFrame, bins: int = 32) -> DataFrame:
    """``pair_id, c, bf, bm, w``: joint histograms of each channel, a pixel's moving value spread over four bins by a cubic window, its fixed value in one.

    A pixel's four parts are summed in tasks before they are shuffled, so that
    a histogram costs a row for each bin and task.
    """
    keys = ["pair_id", "c"]
    known = pairs.filter("fixed is not null and moving is not null")
    ends = known.groupBy(*keys).agg(*[f(c).alias(f"{n}_{c}") for c in ("fixed", "moving") for n, f in (("lo", F.min), ("hi", F.max))])

    def place(c: str) -> Column:
        return F.coalesce(F.try_divide((F.col(c) - F.col(f"lo_{c}")) * (bins - 2 * PADDING), F.col(f"hi_{c}") - F.col(f"lo_{c}")), F.lit(0.0)) + PADDING

    last = bins - PADDING - 1
    placed = known.join(ends, keys).select(*keys, F.least(F.floor(place("fixed")), F.lit(last)).cast("int").alias("bf"), place("moving").alias("at"))
    low = F.least(F.floor("at"), F.lit(last))
    spread = placed.select(*keys, "bf", low.cast("int").alias("low"), (F.col("at") - low).alias("t"))
    parts = F.array(*[F.struct((F.col("low") + i - 1).alias("bm"), w.alias("w")) for i, w in enumerate(_spline_weights(F.col("t")))])
    return spread.select(*keys, "bf", F.explode(parts).alias("p")).select(*keys, "bf", "p.*").groupBy(*keys, "bf", "bm").agg(F.sum("w").alias("w"))


def weighted_similarity(pairs: DataFrame, weights: dict[int, float] | None = None, bins: int = 32) -> DataFrame:
    """Similarity of pairs ``pair_id, c, y, x, fixed, moving`` of several channels: the sum of ``weights`` times the channels' mutual information (by ``soft_histograms``) and mean squared difference.

    Without weights each channel of a pair counts alike and they sum to 1; a
    channel that isn't in ``weights`` counts nothing.
    """
    keys = ["pair_id", "c"]
    joint = soft_histograms(pairs, bins).filter("w > 0")
    channel = Window.partitionBy(*keys)
    shares = joint.withColumns({"n": F.sum("w").over(channel), "nf": F.sum("w").over(Window.partitionBy(*keys, "bf")), "nm": F.sum("w").over(Window.partitionBy(*keys, "bm"))})
    information = shares.groupBy(*keys).agg(F.sum(F.col("w") / F.col("n") * F.log(F.col("w") * F.col("n") / (F.col("nf") * F.col("nm")))).alias("information"))
    square = pairs.groupBy(*keys).agg(F.avg((F.col("fixed") - F.col("moving")) ** 2).alias("square"))
    each = information.join(square, keys)
    if weights is None:
        weight = 1 / F.count(F.lit(1)).over(Window.partitionBy("pair_id"))
    else:
        weight = F.element_at(F.create_map(*[F.lit(v) for c, w in weights.items() for v in (c, float(w))]), F.col("c")) if weights else F.lit(None).cast("double")
    weighed = each.withColumn("weight", F.coalesce(weight, F.lit(0.0)))
    return weighed.groupBy("pair_id").agg(F.sum(F.col("weight") * F.col("information")).alias("mutual_information"), F.sum(F.col("weight") * F.col("square")).alias("mean_square"))


def image_pyramid(pixels: DataFrame, schedule: list[tuple[int, int]]) -> DataFrame:
    """Block means of images at each level; ``schedule`` has the factors of x and y, level by level."""
    levels = F.array(*[F.struct(F.lit(i).alias("level"), F.lit(fx).alias("fx"), F.lit(fy).alias("fy")) for i, (fx, fy) in enumerate(schedule)])
    each = pixels.withColumn("l", F.explode(levels))
    return each.groupBy("image_id", F.col("l.level").alias("level"), F.floor(F.col("y") / F.col("l.fy")).cast("int").alias("y"), F.floor(F.col("x") / F.col("l.fx")).cast("int").alias("x")).agg(F.avg("v").alias("v"))


def _smoothed(pixels: DataFrame, along: str, line: str, sizes: dict[int, float]) -> DataFrame:
    """Pixels ``image_id, level, y, x, v`` smoothed along one axis by a Gaussian of each level's deviation; pixels that aren't there don't count.

    Lines are cut into strips. A pixel is sent to its own strip, and to the
    next where it lies within the window's reach of it.
    """
    reach = {level: math.ceil(REACH * sigma) for level, sigma in sizes.items()}
    by_level = lambda values: F.element_at(F.create_map(*[v for level, value in values.items() for v in (F.lit(level), value)]), F.col("level"))
    r = by_level({level: F.lit(n) for level, n in reach.items()})
    weights = by_level({level: F.array(*[F.lit(math.exp(-0.5 * (d / sigma) ** 2)) for d in range(reach[level] + 1)]) for level, sigma in sizes.items()})
    strips = F.sequence(F.floor((F.col(along) - r) / STRIP), F.floor((F.col(along) + r) / STRIP))
    sent = pixels.filter("v is not null").withColumn("strip", F.explode(strips))
    lists = sent.groupBy("image_id", "level", line, "strip").agg(F.array_sort(F.collect_list(F.struct(F.col(along).alias("at"), F.col("v").cast("double").alias("v")))).alias("p"))
    ready = lists.withColumns({"r": r, "w": weights})

    def smooth(pixel: Column, k: Column) -> Column:
        near = F.slice(F.col("p"), F.greatest(k - F.col("r"), F.lit(0)) + 1, 2 * F.col("r") + 1)
        inside = F.filter(near, lambda q: F.abs(q["at"] - pixel["at"]) <= F.col("r"))
        weighed = F.transform(inside, lambda q: F.struct((F.element_at(F.col("w"), F.abs(q["at"] - pixel["at"]) + 1)).alias("w"), q["v"].alias("v")))
        sums = F.aggregate(weighed, F.struct(F.lit(0.0).alias("s"), F.lit(0.0).alias("w")), lambda a, q: F.struct((a["s"] + q["w"] * q["v"]).alias("s"), (a["w"] + q["w"]).alias("w")), lambda a: a["s"] / a["w"])
        return F.when(F.floor(pixel["at"] / STRIP) == F.col("strip"), F.struct(pixel["at"].alias("at"), sums.alias("v")))

    out = ready.select("image_id", "level", line, F.explode(F.array_compact(F.transform("p", smooth))).alias("q"))
    return out.select("image_id", "level", line, F.col("q.at").alias(along), F.col("q.v").alias("v"))


def smoothing_pyramid(pixels: DataFrame, schedule: list[tuple[int, int]], shrink: bool = False) -> DataFrame:
    """Images at each level smoothed by a Gaussian of half the level's factors of x and y as deviation; ``shrink`` keeps the pixels at whole multiples of the factors, numbered anew."""
    levels = F.array(*[F.lit(i) for i in range(len(schedule))])
    each = pixels.select("image_id", "y", "x", "v", F.explode(levels).alias("level"))
    smooth = _smoothed(each, "x", "y", {i: fx / 2 for i, (fx, _) in enumerate(schedule)})
    smooth = _smoothed(smooth, "y", "x", {i: fy / 2 for i, (_, fy) in enumerate(schedule)})
    if shrink:
        factor = F.element_at(F.array(*[F.struct(F.lit(fx).alias("x"), F.lit(fy).alias("y")) for fx, fy in schedule]), F.col("level") + 1)
        smooth = smooth.withColumn("f", factor).filter("x % f.x = 0 and y % f.y = 0").withColumns({"x": (F.col("x") / F.col("f.x")).cast("int"), "y": (F.col("y") / F.col("f.y")).cast("int")})
    return smooth.select("image_id", "level", "y", "x", "v")


def recursive_pyramid(pixels: DataFrame, schedule: list[tuple[int, int]]) -> DataFrame:
    """Smoothed and shrunk levels, each made from the finer one after it: the schedule's factors go down to the last level, and each is a multiple of the next."""
    ends = [*schedule[1:], (1, 1)]
    if any(a % c or b % d for (a, b), (c, d) in zip(schedule, ends, strict=True)):
        raise ValueError("a recursive pyramid's factors are multiples of those of the next level")
    finer, out = pixels.select("image_id", "y", "x", "v"), None
    for level in reversed(range(len(schedule))):
        (a, b), (c, d) = schedule[level], ends[level]
        finer = smoothing_pyramid(finer, [(a // c, b // d)], shrink=True).drop("level")
        same = finer.select("image_id", F.lit(level).alias("level"), "y", "x", "v")
        out = same if out is None else out.unionByName(same)
    return out


def initial_alignment(pairs: DataFrame, method: str = "CenterOfGravity") -> DataFrame:
    """Translation from the fixed to the moving image of pairs ``pair_id, y, x, fixed, moving``: by their middles, centres of gravity or origins."""
    if method == "CenterOfGravity":
        centre = {c: [F.coalesce(F.try_divide(F.sum(F.col(c) * F.col(a)), F.sum(c)), F.lit(0.0)) for a in ("x", "y")] for c in ("fixed", "moving")}
    elif method in ("GeometricalCenter", "Origins"):
        pick = (lambda a: (F.min(a) + F.max(a)) / 2) if method == "GeometricalCenter" else F.min
        centre = {c: [pick(F.when(F.col(c).isNotNull(), F.col(a))) for a in ("x", "y")] for c in ("fixed", "moving")}
    else:
        raise ValueError(f"unknown method {method}")
    return pairs.groupBy("pair_id").agg((centre["moving"][0] - centre["fixed"][0]).cast("double").alias("tx"), (centre["moving"][1] - centre["fixed"][1]).cast("double").alias("ty"))


def sample_pixels(pixels: DataFrame, n: int = 2048, seed: int = 0, iteration: int = 0) -> DataFrame:
    """``n`` pixels of each image, the same for the same seed and iteration, others for the next; the sample size is the feature.

    The order is a hash of the place. Its range is cut into slices whose
    pixels are counted first; only the slices that the first ``n`` lie in are
    sorted, so that no task sorts a large image.
    """
    mixed = (F.col("x").cast("long") * 73856093).bitwiseXOR(F.col("y").cast("long") * 19349663).bitwiseXOR(F.lit(seed * 83492791 + iteration * 2654435761)) % 2147483647
    sliced = pixels.withColumns({"mixed": mixed, "slice": F.floor(mixed / SLICE)})
    before = F.sum("k").over(Window.partitionBy("image_id").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1))
    counts = sliced.groupBy("image_id", "slice").agg(F.count(F.lit(1)).alias("k")).withColumn("before", F.coalesce(before, F.lit(0)))
    some = sliced.join(counts.filter(F.col("before") < n).select("image_id", "slice", "before"), ["image_id", "slice"])
    order = Window.partitionBy("image_id", "slice").orderBy("mixed", "y", "x")
    chosen = some.withColumn("place", F.col("before") + F.row_number().over(order)).filter(F.col("place") <= n)
    return chosen.select(*pixels.columns)


def sample_grid(pixels: DataFrame, spacing: tuple[int, int] = (2, 2)) -> DataFrame:
    """The pixels at whole multiples of the spacing of x and y."""
    return pixels.filter((F.col("x") % spacing[0] == 0) & (F.col("y") % spacing[1] == 0))


def sample_coordinates(pixels: DataFrame, n: int = 2048, seed: int = 0, iteration: int = 0, order: int = 1) -> DataFrame:
    """``image_id, k, x, y, v``: ``n`` places of each image between its outermost pixels, off the lattice, with the values there.

    Place ``k`` of an image comes from a hash of the image's and its own
    number, the seed and the iteration, so that it is the same however often
    a task runs, and another one for the next iteration.
    """
    spans = pixels.groupBy("image_id").agg(*[f(c).alias(f"{name}_{c}") for c in ("x", "y") for name, f in (("low", F.min), ("high", F.max))])
    each = spans.withColumn("k", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))))
    mixed = (F.col("k") * 73856093).bitwiseXOR(F.col("image_id").cast("long") * 19349663).bitwiseXOR(F.lit(seed * 83492791 + iteration * 2654435761))
    first = (F.pmod(mixed, F.lit(MODULUS)) * DRAW + 1) % MODULUS * DRAW % MODULUS
    drawn = each.withColumn("u", first).withColumn("w", F.col("u") * DRAW % MODULUS)
    between = lambda c, u: F.col(f"low_{c}") + F.col(u) / MODULUS * (F.col(f"high_{c}") - F.col(f"low_{c}"))
    places = drawn.select("image_id", "k", between("x", "u").alias("x"), between("y", "w").alias("y"))
    return interpolated(places, pixels, ["image_id"], order)


def sample(pixels: DataFrame, sampler: str = "Random", n: int = 2048, seed: int = 0, iteration: int = 0, spacing: tuple[int, int] = (2, 2)) -> DataFrame:
    """``image_id, x, y, v`` by one of the samplers ``Random``, ``Grid``, ``Full`` and ``RandomCoordinate``."""
    if sampler == "RandomCoordinate":
        found = sample_coordinates(pixels, n, seed, iteration)
    elif sampler == "Random":
        found = sample_pixels(pixels, n, seed, iteration)
    elif sampler == "Grid":
        found = sample_grid(pixels, spacing)
    elif sampler == "Full":
        found = pixels
    else:
        raise ValueError(f"unknown sampler {sampler}")
    return found.select("image_id", F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"), "v")


def deformation_stats(points: DataFrame) -> DataFrame:
    """Of each set's displacements from ``in_x, in_y`` to ``out_x, out_y``: mean, greatest and root mean square."""
    square = (F.col("out_x") - F.col("in_x")) ** 2 + (F.col("out_y") - F.col("in_y")) ** 2
    return points.withColumn("square", square).groupBy("set_id").agg(F.avg(F.sqrt("square")).alias("mean"), F.max(F.sqrt("square")).alias("greatest"), F.sqrt(F.avg("square")).alias("rms"))
