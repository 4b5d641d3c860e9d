"""Paths of SVG files as polygons sampled by arc length.

A path's text is interpreted by expressions and windows: its commands and
their numbers are found by patterns, each group of numbers is a segment, and
the running point is a sum of relative moves since the last absolute place,
first inside each sub-path, then from sub-path to sub-path. Curves and arcs
are cut into as many straight pieces as keep within a tolerance of them.
"""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vertexloom.functions.settle import dealt
from vertexloom.operators.roi import sample_path
from vertexloom.sources.files import name_under

#: Numbers that each command takes.
TAKES = {"M": 2, "L": 2, "H": 1, "V": 1, "C": 6, "S": 4, "Q": 4, "T": 2, "A": 7, "Z": 0}
LETTERS = "MmLlHhVvCcSsQqTtAaZz"
NUMBER = r"[-+]?(?:\d+\.?\d*|\.\d+)(?:[eE][-+]?\d+)?"
#: An arc's radii, angle and flags; a flag is one digit and may stand without blanks.
ARC = rf"({NUMBER})[\s,]*({NUMBER})[\s,]*({NUMBER})[\s,]*([01])[\s,]*([01])[\s,]*(?={NUMBER}[\s,]*{NUMBER})"
#: Fixed value: the colour of regions read from paths.
COLOUR = (150, 150, 150)
#: How far straight pieces may be from the curve, in units of the file.
TOLERANCE = 0.1
#: Vertices of a segment are numbered below this.
SPAN = 1 << 24


def _flag(condition: Column) -> Column:
    return F.coalesce(condition.cast("int"), F.lit(0))


def _segments(paths: DataFrame, keys: list[str]) -> DataFrame:
    """A row for each segment: ``ix``, its command as a capital letter, whether it is relative, its numbers and its sub-path ``poly_ix``."""
    takes = F.create_map(*[F.lit(v) for item in TAKES.items() for v in item])
    commands = paths.select(*keys, F.posexplode(F.regexp_extract_all(F.coalesce("d", F.lit("")), F.lit(f"[{LETTERS}][^{LETTERS}]*"), F.lit(0))).alias("at", "text"))
    letter = F.substring("text", 1, 1)
    named = commands.select(*keys, "at", F.upper(letter).alias("cmd"), (F.upper(letter) != letter).alias("relative"), F.substring(F.col("text"), F.lit(2), F.length("text")).alias("rest"))
    rest = F.when(F.col("cmd") == "A", F.regexp_replace("rest", ARC, "$1 $2 $3 $4 $5 ")).otherwise(F.col("rest"))
    numbered = named.withColumns({"numbers": F.transform(F.regexp_extract_all(rest, F.lit(NUMBER), F.lit(0)), lambda v: v.cast("double")), "takes": F.element_at(takes, F.col("cmd"))})
    groups = F.when(F.col("takes") == 0, F.lit(1)).otherwise(F.floor(F.size("numbers") / F.greatest("takes", F.lit(1)))).cast("int")
    each = numbered.withColumn("groups", groups).filter("groups > 0").withColumn("k", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)))
    path = Window.partitionBy(*keys).orderBy("at", "k")
    opens = (F.col("cmd") == "M") & (F.col("k") == 0)
    rows = each.select(*keys, "at", "k", F.when((F.col("cmd") == "M") & (F.col("k") > 0), "L").otherwise(F.col("cmd")).alias("cmd"), "relative", F.slice("numbers", F.col("k") * F.col("takes") + 1, F.col("takes")).alias("a"), opens.alias("opens"))
    return rows.select(*keys, (F.row_number().over(path) - 1).alias("ix"), "cmd", "relative", "a", (F.sum(_flag(F.col("opens"))).over(path) - 1).cast("int").alias("poly_ix"))


def _running(rows: DataFrame, keys: list[str], order: str, sets: Column, value: Column, name: str) -> DataFrame:
    """``name``: the sum of ``value`` from the last row on that ``sets``; before the first one it counts from 0. ``name_set`` says whether there was one."""
    since = Window.partitionBy(*keys).orderBy(order)
    counted = rows.withColumns({"__sets": _flag(sets), "__value": value}).withColumn("__run", F.sum("__sets").over(since))
    return counted.withColumns({name: F.sum("__value").over(Window.partitionBy(*keys, "__run").orderBy(order)), f"{name}_set": F.col("__run") > 0}).drop("__sets", "__value", "__run")


def _placed(segments: DataFrame, keys: list[str]) -> DataFrame:
    """Segments with where they start ``x0, y0``, end ``x1, y1``, and where their sub-path starts ``sx, sy``."""
    cmd, part = F.col("cmd"), [*keys, "poly_ix"]
    moved, absolute = segments, ~F.col("relative")
    first = cmd == "M"
    for axis, skips, i in (("x", "V", -2), ("y", "H", -1)):
        own = F.when(cmd.isin("H", "V"), F.get("a", F.lit(0))).otherwise(F.element_at("a", i))
        # Where a sub-path is absolute its places are, else they are from its start on; closing it goes back to the start.
        kept = cmd == skips
        sets = first | (cmd == "Z") | (absolute & ~kept)
        value = F.when(first | (cmd == "Z") | kept, F.lit(0.0)).otherwise(own)
        placed = _running(moved.withColumn("__known", _flag(absolute & ~kept & ~first & (cmd != "Z"))), part, "ix", sets, value, f"r{axis}")
        last_set = F.last(F.when(sets, F.col("__known")), True).over(Window.partitionBy(*part).orderBy("ix"))
        moved = placed.withColumn(f"k{axis}", F.coalesce(last_set, F.lit(0)) > 0).drop("__known", f"r{axis}_set")
    # The start of each sub-path: where it is absolute, or so far from where the one before ended.
    part_order = Window.partitionBy(*part).orderBy("ix")
    ends = moved.groupBy(*part).agg(
        F.min_by(F.struct("cmd", "relative", "a"), "ix").alias("f"), F.max_by(F.struct("rx", "kx", "ry", "ky"), "ix").alias("e"),
    )
    before = Window.partitionBy(*keys).orderBy("poly_ix")
    ends = ends.withColumn("p", F.lag("e").over(before))
    for axis, i in (("x", 1), ("y", 2)):
        begun = F.when(F.col("f.cmd") == "M", F.element_at("f.a", i)).otherwise(0.0)
        free = (F.col("f.cmd") != "M") | ~F.col("f.relative")
        came = F.coalesce(F.col(f"p.r{axis}"), F.lit(0.0))
        known = free | F.coalesce(F.col(f"p.k{axis}"), F.lit(False))
        ends = _running(ends, keys, "poly_ix", known, F.when(free, begun).otherwise(begun + came), f"s{axis}")
    starts = ends.select(*part, "sx", "sy")
    joined = moved.join(starts, part)
    at = {f"{axis}1": F.when(F.col(f"k{axis}"), F.col(f"r{axis}")).otherwise(F.col(f"r{axis}") + F.col(f"s{axis}")) for axis in "xy"}
    ended = joined.withColumns(at)
    return ended.withColumns({f"{axis}0": F.coalesce(F.lag(f"{axis}1").over(part_order), F.when(first, F.col(f"s{axis}")).otherwise(0.0)) for axis in "xy"}).drop("rx", "ry", "kx", "ky")


def _with_controls(placed: DataFrame, keys: list[str]) -> DataFrame:
    """Curves' control points ``c1, c2`` in absolute places; those that aren't given mirror the one before, if that is of the same kind."""
    path, cmd = Window.partitionBy(*keys).orderBy("ix"), F.col("cmd")

    def point(i: int) -> Column:
        by = lambda axis: F.when(F.col("relative"), F.col(f"{axis}0")).otherwise(0.0)
        return F.struct((F.get("a", F.lit(i)) + by("x")).alias("x"), (F.get("a", F.lit(i + 1)) + by("y")).alias("y"))

    def mirrored(p: Column) -> Column:
        return F.struct((2 * F.col("x0") - p["x"]).alias("x"), (2 * F.col("y0") - p["y"]).alias("y"))

    here = F.struct(F.col("x0").alias("x"), F.col("y0").alias("y"))
    rows = placed.withColumns({"c2": F.when(cmd == "C", point(2)).when(cmd == "S", point(0)), "before": F.lag("cmd").over(path)})
    last = F.lag("c2").over(path)
    # A chain of T: each control is the mirror of the one before, so with signs in turn they are running sums.
    chain = F.sum(_flag(cmd != "T")).over(path)
    rows = rows.withColumn("chain", chain)
    in_chain = Window.partitionBy(*keys, "chain").orderBy("ix")
    rows = rows.withColumn("turn", F.row_number().over(in_chain) - 1)
    sign = F.when(F.col("turn") % 2 == 0, 1.0).otherwise(-1.0)
    # The chain's first T mirrors the Q before it, or starts where it is.
    begun = F.first(F.when(cmd == "Q", point(0))).over(in_chain)
    sums = {axis: F.sum(F.when(cmd == "T", sign * 2 * F.col(f"{axis}0")).otherwise(0.0)).over(in_chain) for axis in "xy"}
    # Without a Q before, the control before the first T is the place where that starts, so that its mirror is that place too.
    origin = F.coalesce(begun, F.first(F.when((F.col("turn") == 1) & (cmd == "T"), here), True).over(in_chain), F.first(F.when(cmd == "T", here), True).over(in_chain))
    # A path that begins with T has no segment before it in its chain.
    lead = F.when(F.first("cmd").over(in_chain) == "T", F.lit(-1.0)).otherwise(1.0)
    smooth = F.struct(*[(sign * (sums[axis] + lead * origin[axis])).alias(axis) for axis in "xy"])
    c1 = F.when(cmd.isin("C", "Q"), point(0)).when(cmd == "T", smooth).when(cmd == "S", F.when(F.col("before").isin("C", "S"), mirrored(last)).otherwise(here))
    return rows.withColumn("c1", c1).drop("before", "chain", "turn")


def _pieces(rows: DataFrame, keys: list[str], tolerance: float) -> DataFrame:
    """Vertices after each segment's start: an M's own, a closing line's if it has a length, a curve's by its second difference, an arc's by its sagitta."""
    cmd, x0, y0, x1, y1 = (F.col(c) for c in ("cmd", "x0", "y0", "x1", "y1"))
    arc = {"rx": F.abs(F.get("a", F.lit(0))), "ry": F.abs(F.get("a", F.lit(1)))}
    flat = (cmd == "A") & ((arc["rx"] == 0) | (arc["ry"] == 0) | ((x0 == x1) & (y0 == y1)))
    kind = F.when((cmd == "A") & ~flat, "arc").when(cmd.isin("Q", "T"), "square").when(cmd.isin("C", "S"), "cube").otherwise("line")
    rows = rows.filter(~((cmd == "Z") & (x0 == x1) & (y0 == y1))).withColumn("kind", kind)

    # Half the chord in a frame where the ellipse is a circle of radius 1, grown if it can't reach both ends.
    turned = F.radians(F.get("a", F.lit(2)))
    cos, sin = F.cos(turned), F.sin(turned)
    is_arc = F.col("kind") == "arc"
    rows = rows.withColumns({"cos": F.when(is_arc, cos), "sin": F.when(is_arc, sin), "rx": F.when(is_arc, arc["rx"]), "ry": F.when(is_arc, arc["ry"])})
    c = F.col
    rows = rows.withColumns({"u": ((x0 - x1) * c("cos") + (y0 - y1) * c("sin")) / (2 * c("rx")), "v": ((y0 - y1) * c("cos") - (x0 - x1) * c("sin")) / (2 * c("ry"))})
    rows = rows.withColumn("half", F.hypot("u", "v"))
    grown = F.greatest(c("half"), F.lit(1.0))
    rows = rows.withColumns({"rx": c("rx") * grown, "ry": c("ry") * grown, "u": c("u") / grown, "v": c("v") / grown, "half": F.least("half", F.lit(1.0))})
    side = F.when(F.get("a", F.lit(3)) != F.get("a", F.lit(4)), 1.0).otherwise(-1.0)
    off = F.when(is_arc, F.sqrt(F.greatest(F.lit(0.0), 1 - c("half") * c("half"))) / c("half") * side)
    rows = rows.withColumns({"cu": off * c("v"), "cv": -off * c("u")})
    rows = rows.withColumns({"begin": F.atan2(c("v") - c("cv"), c("u") - c("cu")), "turn": F.atan2(-c("v") - c("cv"), -c("u") - c("cu")) - F.atan2(c("v") - c("cv"), c("u") - c("cu"))})
    sweep = F.get("a", F.lit(4)) != 0
    whole = 2 * F.pi()
    rows = rows.withColumn("turn", F.when(sweep & (c("turn") <= 0), c("turn") + whole).when(~sweep & (c("turn") >= 0), c("turn") - whole).otherwise(c("turn")))
    rows = rows.withColumns({"mx": (x0 + x1) / 2 + c("rx") * c("cu") * c("cos") - c("ry") * c("cv") * c("sin"), "my": (y0 + y1) / 2 + c("rx") * c("cu") * c("sin") + c("ry") * c("cv") * c("cos")})

    def second(p: tuple, q: tuple, r: tuple) -> Column:
        return F.hypot(p[0] - 2 * q[0] + r[0], p[1] - 2 * q[1] + r[1])

    start, end, one, two = (x0, y0), (x1, y1), (c("c1.x"), c("c1.y")), (c("c2.x"), c("c2.y"))
    # A piece of a curve is off by its second difference: at most a quarter of the control points' for a square one, three quarters for a cubic one.
    square = F.sqrt(second(start, one, end) / (4 * tolerance))
    cube = F.sqrt(0.75 * F.greatest(second(start, one, two), second(one, two, end)) / tolerance)
    bent = F.abs(c("turn")) / (2 * F.acos(1 - F.least(tolerance / F.greatest("rx", "ry"), F.lit(1.0))))
    n = F.when(c("kind") == "square", square).when(c("kind") == "cube", cube).when(is_arc, bent).otherwise(1.0)
    cut = rows.withColumn("n", F.greatest(F.ceil(n), F.lit(1)).cast("int")).withColumn("i", F.explode(F.sequence(F.lit(1), F.col("n"))))
    s = F.col("i") / F.col("n")

    def bezier(*points: Column) -> Column:
        m = len(points) - 1
        choose = [1, m, m * (m - 1) // 2, 1][: m + 1] if m == 3 else [1, 2, 1]
        return reduce(lambda a, b: a + b, [k * s**j * (1 - s) ** (m - j) * p for j, (k, p) in enumerate(zip(choose, points, strict=True))])

    angle = c("begin") + c("turn") * s
    curved = {
        "x": F.when(c("kind") == "square", bezier(x0, one[0], x1)).when(c("kind") == "cube", bezier(x0, one[0], two[0], x1)).otherwise(c("mx") + c("rx") * F.cos(angle) * c("cos") - c("ry") * F.sin(angle) * c("sin")),
        "y": F.when(c("kind") == "square", bezier(y0, one[1], y1)).when(c("kind") == "cube", bezier(y0, one[1], two[1], y1)).otherwise(c("my") + c("rx") * F.cos(angle) * c("sin") + c("ry") * F.sin(angle) * c("cos")),
    }
    last = c("i") == c("n")
    return cut.select(*keys, "poly_ix", (F.col("ix").cast("long") * SPAN + F.col("i")).alias("vertex_ix"), F.when(last, x1).otherwise(curved["x"]).alias("x"), F.when(last, y1).otherwise(curved["y"]).alias("y"))


def flatten_paths(paths: DataFrame, keys: list[str], tolerance: float = TOLERANCE) -> DataFrame:
    """Vertices ``keys, poly_ix, vertex_ix, x, y`` of paths ``keys, d``: curves and arcs in straight pieces no further from them than ``tolerance``. Indexes order a path's vertices and have gaps."""
    return _pieces(_with_controls(_placed(_segments(dealt(paths, *keys), keys), keys), keys), keys, tolerance)


def sample_svg(paths: DataFrame, sample_length: float = 10.0, downscale: float = 1.0, tolerance: float = TOLERANCE) -> DataFrame:
    """Paths ``set_id, roi_ix, name, d`` as vertices ``set_id, roi_ix, poly_ix, vertex_ix, x, y, name, colour``, sampled every ``sample_length * downscale`` and scaled down."""
    each = flatten_paths(paths.select("set_id", F.struct("roi_ix", "name").alias("roi_ix"), "d"), ["set_id", "roi_ix"], tolerance)
    sampled = sample_path(each, sample_length * downscale)
    colour: Column = F.array(*[F.lit(c) for c in COLOUR])
    return sampled.select("set_id", F.col("roi_ix.roi_ix").alias("roi_ix"), "poly_ix", "vertex_ix", (F.col("x") / downscale).alias("x"), (F.col("y") / downscale).alias("y"), F.col("roi_ix.name").alias("name"), colour.alias("colour"))


def path_elements(data: bytes) -> list[dict[str, str | None]]:
    """name (structure_id) and d of each path element of an SVG file, in its order; of one that can't be read, the error alone."""
    import xml.etree.ElementTree as Xml

    try:
        found = [e for e in Xml.fromstring(data).iter() if isinstance(e.tag, str) and e.tag.rpartition("}")[2] == "path"]
    except (Xml.ParseError, UnicodeError, LookupError, ValueError) as error:
        return [{"name": None, "d": None, "error": str(error) or type(error).__name__}]
    return [{"name": e.get("structure_id"), "d": e.get("d"), "error": None} for e in found]


def read_svg_elements(spark: SparkSession, path: str) -> DataFrame:
    """``set_id, roi_ix, name, d, error``: the path elements of the SVG files under a path. A set is a file, named by its path under the given one; a file that can't be read has one row, with its error."""

    @F.pandas_udf("array<struct<name:string,d:string,error:string>>")
    def elements(content: pd.Series) -> pd.Series:
        return content.map(path_elements)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.svg").load(path)
    return files.select(name_under(spark, path, F.col("path")).alias("set_id"), F.posexplode(elements("content")).alias("roi_ix", "e")).select("set_id", "roi_ix", "e.*")


def read_svg_paths(spark: SparkSession, path: str, sample_length: float = 10.0, downscale: float = 1.0, tolerance: float = TOLERANCE) -> DataFrame:
    """All path elements of the SVG files under a path; a region's name is its structure_id, its index its place among the file's paths. Files are read once; those that can't be read give nothing here (see ``read_svg_elements``)."""
    return sample_svg(read_svg_elements(spark, path).filter("error is null"), sample_length, downscale, tolerance)
