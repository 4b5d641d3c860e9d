"""Operators on regions of interest kept as vertex tables (see ``functions.geometry``).

All are lazy DataFrame to DataFrame functions, but for ``region_membership``,
which writes its edges and counts its cells when it is called. Polygon-wise
ones shuffle once on the polygon's key; joins of intervals and of points with
polygons have an equal key (a cell, an aligned block of a run).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vertexloom.functions.geometry import POLYGON, VERTEX, after, before, distance, ring, whole
from vertexloom.functions.settle import dealt, settled

#: Pairs of a point and an edge of one cell that one task compares, and the tasks to which a cell's points are dealt at most.
PAIRS_TOGETHER, MOST_PARTS = 4_000_000, 1024
#: Runs are cut into aligned blocks of so many of the level below, in so many levels.
BLOCK, LEVELS = 8, 5


def explode_vertices(rois: DataFrame) -> DataFrame:
    """Nested regions ``set_id, roi_ix, polygons`` (arrays of arrays of x, y) as vertices with a point_ix for each set."""
    polygons = rois.select("set_id", "roi_ix", F.posexplode("polygons").alias("poly_ix", "polygon"))
    vertices = polygons.select("set_id", "roi_ix", "poly_ix", F.posexplode("polygon").alias("vertex_ix", "p")).select(*VERTEX, "p.x", "p.y")
    return with_point_index(vertices)


def nest_vertices(vertices: DataFrame) -> DataFrame:
    """The nested form of a vertex table; a region's own vertices are gathered, nothing more."""
    polygons = vertices.groupBy(*POLYGON).agg(F.array_sort(F.collect_list(F.struct("vertex_ix", "x", "y"))).alias("p"))
    polygons = polygons.select(*POLYGON, F.transform("p", lambda v: F.struct(v["x"].alias("x"), v["y"].alias("y"))).alias("p"))
    nested = polygons.groupBy("set_id", "roi_ix").agg(F.array_sort(F.collect_list(F.struct("poly_ix", "p"))).alias("all"))
    return nested.select("set_id", "roi_ix", F.transform("all", lambda q: q["p"]).alias("polygons"))


def with_point_index(vertices: DataFrame) -> DataFrame:
    """Place of each vertex among all of its set, from 0: its polygon's offset and its place there, so that no task sorts a whole set."""
    sizes = vertices.groupBy(*POLYGON).agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("set_id").orderBy("roi_ix", "poly_ix").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*POLYGON, F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
    placed = vertices.withColumn("point_ix", F.row_number().over(ring()) - 1).join(offsets, POLYGON)
    return placed.withColumn("point_ix", F.col("point_ix") + F.col("offset")).select(*vertices.columns, "point_ix")


def vertex_counts(vertices: DataFrame) -> DataFrame:
    return vertices.groupBy("set_id", "roi_ix").agg(F.count(F.lit(1)).alias("n_vertices"))


def rebind_points(vertices: DataFrame, points: DataFrame) -> DataFrame:
    """New coordinates by position in the set; a region that doesn't get all of its points stays as it is, with rebound false."""
    own = with_point_index(vertices)
    got = points.select("set_id", "point_ix", F.col("x").alias("new_x"), F.col("y").alias("new_y"))
    joined = dealt(dealt(own, "set_id", "point_ix").join(dealt(got, "set_id", "point_ix"), ["set_id", "point_ix"], "left"), "set_id", "roi_ix")
    region = Window.partitionBy("set_id", "roi_ix")
    full = F.count("new_x").over(region) == F.count(F.lit(1)).over(region)
    return joined.withColumn("rebound", full).select(*VERTEX, F.when(F.col("rebound"), F.col("new_x")).otherwise(F.col("x")).alias("x"), F.when(F.col("rebound"), F.col("new_y")).otherwise(F.col("y")).alias("y"), "rebound")


def map_points(vertices: DataFrame, x: Column | Callable, y: Column | None = None) -> DataFrame:
    """Every vertex moved: to the expressions x and y, or by ``x(xs, ys) -> (xs, ys)`` on batches of coordinates."""
    if y is not None:
        return vertices.withColumns({"x": x, "y": y})

    def run(batches: Iterator):
        for batch in batches:
            new_x, new_y = x(batch["x"].to_numpy(), batch["y"].to_numpy())
            yield batch.assign(x=new_x, y=new_y)

    return vertices.mapInPandas(run, vertices.schema)


def signed_area(vertices: DataFrame) -> DataFrame:
    """Shoelace area of each polygon; 0 for fewer than three vertices."""
    cross = F.col("x") * after("y") - F.col("y") * after("x")
    crossed = vertices.select(*POLYGON, cross.alias("cross"))
    return crossed.groupBy(*POLYGON).agg((F.when(F.count(F.lit(1)) < 3, 0.0).otherwise(F.sum("cross")) / 2).alias("area"))


def orientation(vertices: DataFrame) -> DataFrame:
    """Area and its sign; no area counts as positive."""
    return signed_area(vertices).withColumn("orientation", F.when(F.col("area") >= 0, "positive").otherwise("negative"))


def edges(vertices: DataFrame) -> DataFrame:
    return vertices.select(*VERTEX, F.col("x").alias("x0"), F.col("y").alias("y0"), after("x").alias("x1"), after("y").alias("y1"))


def run_blocks(first: Column, last: Column) -> Column:
    """Aligned blocks ``(level, block)`` of ``BLOCK ** level`` whole numbers that make up a run: few at each level but the highest."""

    def between(low: Column, high: Column, level: int) -> Column:
        found = F.transform(F.sequence(low, high), lambda k: F.struct(F.lit(level).alias("level"), k.alias("block")))
        return F.when(low <= high, found).otherwise(F.array().cast("array<struct<level:int,block:bigint>>"))

    parts = []
    for level in range(LEVELS):
        width = BLOCK**level
        low, high = F.ceil(first / width), F.floor((last + 1) / width) - 1
        if level == LEVELS - 1:
            parts.append(between(low, high, level))
            continue
        # What whole blocks of the next level cover is theirs.
        above, past = F.ceil(first / (width * BLOCK)), F.floor((last + 1) / (width * BLOCK))
        left = between(low, F.when(above < past, above * BLOCK - 1).otherwise(high), level)
        right = F.when(above < past, between(past * BLOCK, high, level)).otherwise(F.array().cast("array<struct<level:int,block:bigint>>"))
        parts += [left, right]
    return F.concat(*parts)


def blocks_with(place: Column) -> Column:
    """The blocks of all levels that hold a whole number."""
    return F.array(*[F.struct(F.lit(level).alias("level"), F.floor(place / BLOCK**level).alias("block")) for level in range(LEVELS)])


def signed_edges(vertices: DataFrame) -> DataFrame:
    """Edges of polygons of three vertices or more, others having no inside, and whether their polygon's area is negative."""
    n, area = F.count(F.lit(1)).over(Window.partitionBy(*POLYGON)), F.sum(F.col("x0") * F.col("y1") - F.col("y0") * F.col("x1")).over(Window.partitionBy(*POLYGON))
    return edges(vertices).withColumns({"n": n, "negative": area < 0}).filter("n > 2").select(*POLYGON, "negative", "x0", "y0", "x1", "y1")


def _x_at(y: Column) -> Column:
    """Where an edge is at a height; null for a level one."""
    return F.try_divide((F.col("x1") - F.col("x0")) * (y - F.col("y0")), F.col("y1") - F.col("y0")) + F.col("x0")


def _spans(y: Column) -> Column:
    return (F.col("y0") > y) != (F.col("y1") > y)


def cut_cells(signed: DataFrame, cell: float) -> DataFrame:
    """Every edge once for each square cell that it touches: ``row, col``, ``right``, how many edges cross the cell's lower line right of the cell, and ``next``, the next cell to the right that an edge touches."""
    low, high = F.least("y0", "y1"), F.greatest("y0", "y1")
    rows = signed.withColumn("row", F.explode(F.sequence(F.floor(low / cell), F.floor(high / cell))))
    bottom, flat = F.col("row") * cell, F.col("y0") == F.col("y1")
    ends = [F.when(flat, F.col(x)).otherwise(_x_at(y)) for x, y in (("x0", F.greatest(low, bottom)), ("x1", F.least(high, bottom + cell)))]
    reach = rows.withColumns({"a": F.least(*ends), "b": F.greatest(*ends)})
    slack = (F.abs("a") + F.abs("b") + cell) * 1e-9
    each = reach.withColumn("col", F.explode(F.sequence(F.floor((F.col("a") - slack) / cell), F.floor((F.col("b") + slack) / cell))))
    crosses = (~flat & _spans(bottom) & (_column_of(_x_at(bottom), cell) == F.col("col"))).cast("int")
    further = Window.partitionBy(*POLYGON, "row").orderBy(F.desc("col")).rangeBetween(Window.unboundedPreceding, -1)
    counted = each.withColumn("crosses", crosses).withColumns({"right": F.coalesce(F.sum("crosses").over(further), F.lit(0)), "next": F.min("col").over(further)})
    return counted.drop("a", "b", "crosses")


def _column_of(x: Column, cell: float) -> Column:
    """The last column whose right border isn't left of x: what counts as right of a border, everywhere here."""
    return F.ceil(x / cell) - 1


def cell_pairs(points: DataFrame, cells: DataFrame, cell: float) -> DataFrame:
    """Each point with each edge of the cut cell that it lies in, cells of very many pairs dealt to several tasks; the points of such cells only are compared with edges."""
    at, key = points.hint("merge"), ["set_id", "row", "col"]
    pairs = points.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).hint("merge").join(cells.groupBy(*key).agg(F.count(F.lit(1)).alias("m")), key)
    parts = F.ceil(F.least(F.col("n") * F.col("m") / PAIRS_TOGETHER, F.lit(MOST_PARTS))).cast("int")
    large = settled(pairs.select(*key, parts.alias("parts")).filter("parts > 1"))
    if large.isEmpty():
        return at.join(cells, key)
    at = points.join(large, key, "left").withColumn("part", F.coalesce(F.pmod(F.xxhash64("point_ix"), "parts"), F.lit(0))).drop("parts")
    several = cells.join(large, key, "left").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("parts", F.lit(1)).cast("long") - 1))).drop("parts")
    return at.hint("merge").join(several, [*key, "part"])


def region_membership(points: DataFrame, vertices: DataFrame, cell: float | None = None) -> DataFrame:
    """Pairs of a point and a region of the same set that it lies in.

    Inside a polygon: an odd number of its edges cross the ray to the right.
    Inside a region: inside any positive polygon or inside any negative one,
    but not both.

    Polygons are covered by square cells (as large as an edge is long on
    average, if no size is given). A cell that no edge touches lies inside as
    a whole or outside: runs of inner cells are cut into blocks of 1, 8, 64
    and more cells, and a point finds those that hold it by an equal join.
    A point in a cell that edges touch is compared with these alone: the
    parity at the cell's lower right corner is known, edges between that
    corner and the point's height change it, and then those between the point
    and the cell's right border.

    Points are joined by merging: Spark doesn't count what an explode makes of
    a small table, and would broadcast all points through the driver.
    """
    signed = settled(signed_edges(vertices.filter("x is not null and y is not null")))
    if cell is None:
        cell = signed.agg(F.avg(F.greatest(F.abs(F.col("x1") - F.col("x0")), F.abs(F.col("y1") - F.col("y0"))))).first()[0] or 1.0
    cells = cut_cells(signed, cell)
    at = points.select("set_id", "point_ix", F.col("x").alias("px"), F.col("y").alias("py"), F.floor(F.col("y") / cell).alias("row"), F.floor(F.col("x") / cell).alias("col"))

    runs = cells.filter("right % 2 = 1 and next > col + 1").select(*POLYGON, "negative", "row", "col", "next").distinct()
    blocks = runs.select(*POLYGON, "negative", "row", F.explode(run_blocks(F.col("col") + 1, F.col("next") - 1)).alias("b")).select(*POLYGON, "negative", "row", "b.*")
    keyed = at.withColumn("b", F.explode(blocks_with(F.col("col")))).select("set_id", "point_ix", "row", "b.*")
    whole = keyed.hint("merge").join(blocks, ["set_id", "row", "level", "block"]).select(*POLYGON, "point_ix", "negative")

    pairs = cell_pairs(at, cells, cell)
    bottom, py, low, high = F.col("row") * cell, F.col("py"), F.least("y0", "y1"), F.greatest("y0", "y1")
    right_of = lambda x: _column_of(x, cell) > F.col("col")
    side_at = lambda y: right_of(F.when(y == F.col("y0"), F.col("x0")).when(y == F.col("y1"), F.col("x1")).otherwise(_x_at(y)))
    flat, met = F.col("y0") == F.col("y1"), _spans(py)
    # An edge's sides of the border where it comes into the strip from the corner's height to the point's, and where it leaves it.
    enters = F.when(low > bottom, side_at(low)).otherwise(right_of(_x_at(bottom)))
    leaves = F.when(met, right_of(_x_at(py))).otherwise(side_at(high))
    within = F.when(flat, (low > bottom) & (low <= py)).otherwise((high > bottom) & (low <= py))
    turns = within & F.when(flat, right_of(F.col("x0")) != right_of(F.col("x1"))).otherwise(enters != leaves)
    passes = ~flat & met & (F.col("px") < _x_at(py)) & ~right_of(_x_at(py))
    changes = turns.cast("int") + passes.cast("int")
    cut = pairs.groupBy(*POLYGON, "point_ix", "negative").agg((F.first("right") + F.sum(changes)).alias("n")).filter("n % 2 = 1").drop("n")
    inside = whole.unionByName(cut).groupBy("set_id", "point_ix", "roi_ix").agg(F.bool_or(~F.col("negative")).alias("positive"), F.bool_or("negative").alias("negative"))
    return inside.filter(F.col("positive") != F.col("negative")).select("set_id", "point_ix", "roi_ix")


def split_subpaths(commands: DataFrame, base: tuple[float, float] = (0.0, 0.0)) -> DataFrame:
    """Path commands ``path_id, cmd_ix, cmd, x, y`` as polygons, with their kind.

    A polygon begins at every M. What is from a curve on is dropped, as are
    sub-paths of a lone M. One of three commands becomes the rectangle of its
    extent, placed at its first vertex. ``base`` is added to all vertices.
    """
    path = Window.partitionBy("path_id").orderBy("cmd_ix").rowsBetween(Window.unboundedPreceding, 0)
    part = Window.partitionBy("path_id", "poly_ix")
    numbered = commands.withColumn("poly_ix", F.sum((F.col("cmd") == "M").cast("int")).over(path) - 1)
    curved = numbered.withColumn("curve", F.bool_or(F.col("cmd").isin("Q", "C")).over(part)).withColumn("upto", F.bool_or("curve").over(path))
    counted = curved.filter(~F.col("upto")).withColumn("n", F.count(F.lit(1)).over(part) + 1).filter("n > 2 and cmd in ('M', 'L')")
    moved = counted.select("path_id", "poly_ix", (F.row_number().over(part.orderBy("cmd_ix")) - 1).alias("vertex_ix"), (F.col("x") + base[0]).alias("x"), (F.col("y") + base[1]).alias("y"), "n")
    lines = moved.filter("n != 4").select("path_id", "poly_ix", "vertex_ix", "x", "y", F.lit("polygon").alias("kind"))
    boxes = moved.filter("n = 4").groupBy("path_id", "poly_ix").agg(F.min_by(F.struct("x", "y"), "vertex_ix").alias("p"), (F.max("x") - F.min("x")).alias("w"), (F.max("y") - F.min("y")).alias("h"))
    corners = F.array(*[F.struct((F.col("p.x") + F.col("w") * i).alias("x"), (F.col("p.y") + F.col("h") * j).alias("y")) for i, j in ((0, 0), (1, 0), (1, 1), (0, 1))])
    boxes = boxes.select("path_id", "poly_ix", F.posexplode(corners).alias("vertex_ix", "c")).select("path_id", "poly_ix", "vertex_ix", "c.x", "c.y", F.lit("rectangle").alias("kind"))
    return lines.unionByName(boxes)


def plain_shapes(shapes: DataFrame, tolerance: float = 0.1) -> DataFrame:
    """Plain shapes ``path_id, kind, a`` as vertices ``path_id, poly_ix, vertex_ix, x, y, kind``, all numbers cut to whole ones first.

    ``a`` holds x, y, width and height of a ``rectangle`` or ``ellipse``, both
    ends of a ``line``, and x, y by turns of a ``polygon``. An ellipse is
    outlined from its right-most point on, by angles in as many equal steps,
    eight at least, as keep the outline within ``tolerance``. Other kinds, and
    shapes that lack numbers, give nothing.
    """
    whole = shapes.select("path_id", "kind", F.transform("a", lambda v: v.cast("bigint").cast("double")).alias("a")).filter(F.size("a") >= F.when(F.col("kind") == "polygon", 2).otherwise(4))
    x, y, w, h = (F.get("a", F.lit(i)) for i in range(4))
    point = lambda px, py: F.struct(px.alias("x"), py.alias("y"))
    box = F.array(*[point(x + w * i, y + h * j) for i, j in ((0, 0), (1, 0), (1, 1), (0, 1))])
    half = F.greatest(F.abs(w), F.abs(h)) / 2
    steps = F.greatest(F.lit(8), F.ceil(F.pi() / F.acos(1 - F.least(F.coalesce(F.try_divide(F.lit(tolerance), half), F.lit(1.0)), F.lit(1.0))))).cast("int")
    around = F.transform(F.sequence(F.lit(0), steps - 1), lambda k: point(x + w / 2 + w / 2 * F.cos(2 * F.pi() * k / steps), y + h / 2 + h / 2 * F.sin(2 * F.pi() * k / steps)))
    pairs = F.transform(F.sequence(F.lit(0), F.floor(F.size("a") / 2).cast("int") - 1), lambda k: point(F.get("a", 2 * k), F.get("a", 2 * k + 1)))
    vertices = F.when(F.col("kind") == "rectangle", box).when(F.col("kind") == "ellipse", around).when(F.col("kind") == "line", F.array(point(x, y), point(w, h))).when(F.col("kind") == "polygon", pairs)
    return whole.select("path_id", "kind", F.posexplode(vertices).alias("vertex_ix", "p")).select("path_id", F.lit(0).alias("poly_ix"), "vertex_ix", "p.x", "p.y", "kind")


def bounding_boxes(vertices: DataFrame) -> DataFrame:
    """Whole-number bounds of each region."""
    low_x, low_y = F.floor(F.min("x")), F.floor(F.min("y"))
    return vertices.groupBy("set_id", "roi_ix").agg(low_x.alias("x"), low_y.alias("y"), (F.ceil(F.max("x")) - low_x).alias("width"), (F.ceil(F.max("y")) - low_y).alias("height"))


def canvas_size(vertices: DataFrame, least: int = 100) -> DataFrame:
    """Size, for each set, of the image from the origin that holds its regions; parts at negative places are cut off."""
    boxes = bounding_boxes(vertices)
    return boxes.groupBy("set_id").agg(F.greatest(F.lit(least), F.max(F.col("x") + F.col("width"))).cast("long").alias("width"), F.greatest(F.lit(least), F.max(F.col("y") + F.col("height"))).cast("long").alias("height"))


def region_runs(vertices: DataFrame) -> DataFrame:
    """Runs ``set_id, roi_ix, y, a, b`` of pixels whose centres lie in a region, which is what ``region_membership`` says of them.

    Scan lines: each edge gives its crossing with the centre line of each row
    it spans; sorted crossings of a polygon pair up to runs. Where a region's
    runs begin and end, the numbers of its positive and negative polygons are
    counted on, and between two such places they stay.
    """
    spans = signed_edges(vertices).filter("y0 != y1")
    first, last = F.ceil(F.least("y0", "y1") - 0.5), F.ceil(F.greatest("y0", "y1") - 0.5) - 1
    rows = spans.withColumns({"first": first, "last": last}).filter("first <= last").withColumn("row", F.explode(F.sequence("first", "last")))
    line = Window.partitionBy(*POLYGON, "row").orderBy("at")
    paired = rows.select(*POLYGON, "negative", "row", _x_at(F.col("row") + 0.5).alias("at")).withColumns({"k": F.row_number().over(line), "end": F.lead("at").over(line)}).filter("k % 2 = 1")
    runs = paired.select("set_id", "roi_ix", "negative", F.col("row").alias("y"), F.ceil(F.col("at") - 0.5).alias("a"), F.ceil(F.col("end") - 0.5).alias("past")).filter("a < past")
    steps = runs.select("set_id", "roi_ix", "y", "negative", F.explode(F.array(F.struct(F.col("a").alias("x"), F.lit(1).alias("by")), F.struct(F.col("past").alias("x"), F.lit(-1).alias("by")))).alias("s"))
    sums = steps.groupBy("set_id", "roi_ix", "y", F.col("s.x").alias("x")).agg(*[F.sum(F.when(F.col("negative") == n, F.col("s.by")).otherwise(0)).alias(f"n{int(n)}") for n in (False, True)])
    upto = Window.partitionBy("set_id", "roi_ix", "y").orderBy("x")
    held = sums.select("set_id", "roi_ix", "y", F.col("x").alias("a"), (F.lead("x").over(upto) - 1).alias("b"), *[F.sum(n).over(upto).alias(n) for n in ("n0", "n1")])
    return held.filter("(n0 > 0) != (n1 > 0)").select("set_id", "roi_ix", "y", "a", "b")


def top_runs(runs: DataFrame) -> DataFrame:
    """Runs of each line with the greatest ``roi_ix`` there, by intervals: however many regions lie above each other, no pixel is looked at.

    A run is cut into aligned blocks, of which each keeps the greatest region.
    Between two neighbouring run ends of a line the regions stay the same, and
    they are those of the blocks that hold the first pixel.
    """
    line = ["set_id", "y"]
    blocks = runs.select(*line, "roi_ix", F.explode(run_blocks(F.col("a"), F.col("b"))).alias("k")).groupBy(*line, "k.level", "k.block").agg(F.max("roi_ix").alias("roi_ix"))
    places = runs.select(*line, F.explode(F.array(F.col("a"), F.col("b") + 1)).alias("a")).distinct()
    pieces = places.withColumn("b", F.lead("a").over(Window.partitionBy(*line).orderBy("a")) - 1).filter("b is not null")
    held = pieces.withColumn("k", F.explode(blocks_with(F.col("a")))).select(*line, "a", "b", "k.*").join(blocks, [*line, "level", "block"])
    return held.groupBy(*line, "a", "b").agg(F.max("roi_ix").alias("roi_ix"))


def rasterize_rois(vertices: DataFrame, label_step: int = 2, size: tuple[int, int] | None = None) -> DataFrame:
    """Label image ``set_id, y, x, label`` of each set; pixels without a region aren't listed.

    The k-th region of a set has label ``label_step * k + 1``, and later
    regions cover earlier ones. Regions are painted by runs of pixels, so
    that rows grow with edges times the rows they span; pixels are made last.
    """
    order = Window.partitionBy("set_id").orderBy("roi_ix")
    labels = vertices.select("set_id", "roi_ix").distinct().withColumn("label", (F.row_number().over(order) - 1) * label_step + 1)
    runs = region_runs(vertices).withColumn("a", F.greatest("a", F.lit(0).cast("long"))).filter("y >= 0")
    if size is not None:
        runs = runs.withColumn("b", F.least("b", F.lit(size[0] - 1).cast("long"))).filter(F.col("y") < size[1])
    top = top_runs(runs.filter("a <= b")).join(labels, ["set_id", "roi_ix"])
    return top.select("set_id", "y", F.explode(F.sequence("a", "b")).alias("x"), "label")


def _stretches(vertices: DataFrame, closed: bool) -> DataFrame:
    """Segments with the arc length where they start and end; the whole length of the polygon beside."""
    to_x = after("x") if closed else F.lead("x").over(ring())
    to_y = after("y") if closed else F.lead("y").over(ring())
    lengths = vertices.select(*VERTEX, F.col("x").alias("x0"), F.col("y").alias("y0"), to_x.alias("x1"), to_y.alias("y1")).withColumn("length", F.coalesce(distance("x0", "y0", "x1", "y1"), F.lit(0.0)))
    upto = ring().rowsBetween(Window.unboundedPreceding, 0)
    return lengths.withColumn("end", F.sum("length").over(upto)).withColumns({"start": F.col("end") - F.col("length"), "total": F.sum("length").over(whole())})


def _samples(stretches: DataFrame, step: float, first: int) -> DataFrame:
    """Vertices at whole multiples of ``step`` from ``first`` on, each made by the segment it falls in."""
    low = F.greatest(F.ceil(F.col("start") / step), F.lit(first))
    high = F.ceil(F.col("end") / step) - 1
    held = stretches.withColumns({"low": low, "high": high}).filter("low <= high and length > 0")
    at = held.withColumn("k", F.explode(F.sequence("low", "high"))).withColumn("part", (F.col("k") * step - F.col("start")) / F.col("length"))
    return at.select(*POLYGON, "k", "total", (F.col("x0") + F.col("part") * (F.col("x1") - F.col("x0"))).alias("x"), (F.col("y0") + F.col("part") * (F.col("y1") - F.col("y0"))).alias("y"))


def sample_path(vertices: DataFrame, step: float) -> DataFrame:
    """Open paths sampled by arc length: int(length / step) vertices, from the first one on."""
    found = _samples(_stretches(vertices, closed=False), step, 0).filter(F.col("k") < F.floor(F.col("total") / step))
    return found.select(*POLYGON, F.col("k").alias("vertex_ix"), "x", "y")


def resample_polygon(vertices: DataFrame, step: float) -> DataFrame:
    """Closed polygons sampled every ``step``: at step, 2 step, ... before the end, then the first vertex; a lone vertex gives nothing."""
    stretches = _stretches(vertices, closed=True)
    found = _samples(stretches, step, 1).select(*POLYGON, (F.col("k") - 1).alias("vertex_ix"), "x", "y")
    ends = stretches.groupBy(*POLYGON).agg(F.first("total").alias("total"), F.count(F.lit(1)).alias("n"), F.min_by(F.struct("x0", "y0"), "vertex_ix").alias("p")).filter("n > 1")
    last = F.greatest(F.ceil(F.col("total") / step) - 1, F.lit(0))
    return found.unionByName(ends.select(*POLYGON, last.alias("vertex_ix"), F.col("p.x0").alias("x"), F.col("p.y0").alias("y")))


def _half_way(x: Column, y: Column, xb: Column, yb: Column, xa: Column, ya: Column) -> tuple[Column, Column]:
    """A point moved half-way onto the chord of its neighbours; left where the chord has no length."""
    length = F.sqrt((xa - xb) ** 2 + (ya - yb) ** 2)
    dx, dy = F.try_divide(xa - xb, length), F.try_divide(ya - yb, length)
    off = (x - xb) * dy - (y - yb) * dx
    return F.coalesce(x - 0.5 * off * dy, x), F.coalesce(y + 0.5 * off * dx, y)


def smooth_open(vertices: DataFrame) -> DataFrame:
    """Every vertex between the ends moved half-way onto the chord of its neighbours, all at once."""
    n = {"xb": F.lag("x").over(ring()), "yb": F.lag("y").over(ring()), "xa": F.lead("x").over(ring()), "ya": F.lead("y").over(ring())}
    wide = vertices.withColumns(n)
    x, y = _half_way(*[F.col(c) for c in ("x", "y", "xb", "yb", "xa", "ya")])
    return wide.select(*VERTEX, x.alias("x"), y.alias("y"))


def smooth_movable(vertices: DataFrame) -> DataFrame:
    """As ``smooth_open`` on closed rings, but only vertices whose column ``movable`` is true; that column goes, others go along."""
    n = {"xb": before("x"), "yb": before("y"), "xa": after("x"), "ya": after("y")}
    x, y = _half_way(*[F.col(c) for c in ("x", "y", "xb", "yb", "xa", "ya")])
    moved = {"x": F.when(F.col("movable"), x).otherwise(F.col("x")), "y": F.when(F.col("movable"), y).otherwise(F.col("y"))}
    return vertices.withColumns(n).select(*[moved.get(c, F.col(c)).alias(c) for c in vertices.columns if c != "movable"])


def smooth_constrained(vertices: DataFrame, corners: DataFrame) -> DataFrame:
    """As ``smooth_open`` on closed rings, but only vertices whose lattice corner ``set_id, x, y`` is listed as movable."""
    free = corners.filter("movable").select("set_id", F.col("x").alias("cx"), F.col("y").alias("cy"), "movable")
    own = vertices.select(*VERTEX, "x", "y").withColumns({"cx": F.col("x").cast("int"), "cy": F.col("y").cast("int")})
    return smooth_movable(own.join(free, ["set_id", "cx", "cy"], "left").drop("cx", "cy"))


def unique_roi_names(rois: DataFrame) -> DataFrame:
    """Repeated names of a set get -1, -2, ... in region order; a made name that equals another is flagged."""
    same = Window.partitionBy("set_id", "name").orderBy("roi_ix")
    k = F.row_number().over(same) - 1
    named = rois.withColumn("unique_name", F.when(k == 0, F.col("name")).otherwise(F.concat_ws("-", "name", k.cast("string"))))
    return named.withColumn("collides", F.count(F.lit(1)).over(Window.partitionBy("set_id", "unique_name")) > 1)


def roi_names_from_labels(labels: DataFrame) -> DataFrame:
    """The whole part of each label as a name."""
    return labels.withColumn("name", F.col("label").cast("int").cast("string"))
