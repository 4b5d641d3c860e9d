"""Queries of the region operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vertexloom.functions.settle import folder
from vertexloom.operators import roi
from vertexloom.plans import fixtures as fx
from vertexloom.plans.fixtures import cte
from vertexloom.plans.registry import query
from vertexloom.sources import tables

WRAP = "coalesce(lead({0}) OVER w, first_value({0}) OVER f)"
RING = "WINDOW w AS (PARTITION BY set_id, roi_ix, poly_ix ORDER BY vertex_ix), f AS (PARTITION BY set_id, roi_ix, poly_ix ORDER BY vertex_ix ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)"


def area_sql(source: str) -> str:
    return f"""SELECT set_id, roi_ix, poly_ix, CASE WHEN count(*) < 3 THEN 0 ELSE sum(c) / 2 END AS area FROM (
  SELECT set_id, roi_ix, poly_ix, x * {WRAP.format("y")} - y * {WRAP.format("x")} AS c FROM {source} {RING}) GROUP BY ALL"""


def rounded(df: DataFrame, *columns: str, places: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, places) + F.lit(0.0) for c in columns})


@query("roi_orientation_summary", cte("op") + f", a AS ({area_sql('op')}) SELECT CASE WHEN area >= 0 THEN 'positive' ELSE 'negative' END AS orientation, count(*) AS n_polygons, round(sum(area), 2) AS total_area FROM a GROUP BY 1")
def orientation_summary(spark, sf_dir):
    turned = roi.orientation(fx.order_polygons(spark, sf_dir))
    return turned.groupBy("orientation").agg(F.count(F.lit(1)).alias("n_polygons"), F.round(F.sum("area"), 2).alias("total_area"))


@query("r01_explode_vertices", cte("cr") + " SELECT *, row_number() OVER (PARTITION BY set_id ORDER BY roi_ix, poly_ix, vertex_ix) - 1 AS point_ix FROM cr")
def explode_vertices(spark, sf_dir):
    return roi.explode_vertices(roi.nest_vertices(fx.customer_rois(spark, sf_dir)))


@query("r02_vertex_counts", cte("cr") + " SELECT set_id, roi_ix, count(*) AS n_vertices FROM cr GROUP BY ALL")
def vertex_counts(spark, sf_dir):
    return roi.vertex_counts(fx.customer_rois(spark, sf_dir))


@query(
    "r03_rebind_points",
    cte("cr")
    + """, i AS (SELECT *, row_number() OVER (PARTITION BY set_id ORDER BY roi_ix, poly_ix, vertex_ix) - 1 AS p FROM cr),
b AS (SELECT *, bool_and(NOT (set_id % 3 = 0 AND p >= 7)) OVER (PARTITION BY set_id, roi_ix) AS rebound FROM i)
SELECT set_id, roi_ix, poly_ix, vertex_ix, CASE WHEN rebound THEN x + 1 ELSE x END AS x, CASE WHEN rebound THEN y * 2 ELSE y END AS y, rebound FROM b""",
)
def rebind_points(spark, sf_dir):
    """Sets of every third customer get seven points only."""
    vertices = fx.customer_rois(spark, sf_dir)
    points = roi.with_point_index(vertices).filter("not (set_id % 3 = 0 and point_ix >= 7)").select("set_id", "point_ix", (F.col("x") + 1).alias("x"), (F.col("y") * 2).alias("y"))
    return roi.rebind_points(vertices, points)


@query("r04_map_points", cte("op") + " SELECT set_id, roi_ix, poly_ix, vertex_ix, round(x + y / 2, 6) + 0.0 AS x, round(y - x / 4, 6) + 0.0 AS y FROM op")
def map_points(spark, sf_dir):
    return rounded(roi.map_points(fx.order_polygons(spark, sf_dir), F.col("x") + F.col("y") / 2, F.col("y") - F.col("x") / 4), "x", "y")


@query("u03_map_points_by_function", cte("cr") + " SELECT set_id, roi_ix, poly_ix, vertex_ix, round(x * 0.5 - y, 6) + 0.0 AS x, round(y + 3 * x, 6) + 0.0 AS y FROM cr")
def map_points_by_function(spark, sf_dir):
    """Points moved by a function on batches of coordinates."""
    return rounded(roi.map_points(fx.customer_rois(spark, sf_dir), lambda x, y: (x * 0.5 - y, y + 3 * x)), "x", "y")


@query("r05_signed_area", cte("op") + f", a AS ({area_sql('op')}) SELECT set_id, roi_ix, poly_ix, round(area, 6) + 0.0 AS area FROM a")
def signed_area(spark, sf_dir):
    return rounded(roi.signed_area(fx.order_polygons(spark, sf_dir)), "area")


@query("r06_orientation", cte("cr") + f", a AS ({area_sql('cr')}) SELECT set_id, roi_ix, poly_ix, round(area, 6) + 0.0 AS area, CASE WHEN area >= 0 THEN 'positive' ELSE 'negative' END AS orientation FROM a")
def orientation(spark, sf_dir):
    return rounded(roi.orientation(fx.customer_rois(spark, sf_dir)), "area")


@query(
    "r07_region_membership",
    cte("cr")
    + f""", a AS ({area_sql("cr")}),
e AS (SELECT set_id, roi_ix, poly_ix, x AS x0, y AS y0, {WRAP.format("x")} AS x1, {WRAP.format("y")} AS y1 FROM cr {RING}),
p AS (SELECT c_custkey AS set_id, k AS point_ix, 5.3 + 9 * k AS px, 10.7 + 18 * k AS py FROM customer, range(5) r(k)),
i AS (SELECT set_id, point_ix, roi_ix, poly_ix FROM p JOIN e USING (set_id)
  WHERE (y0 > py) <> (y1 > py) AND px < (x1 - x0) * (py - y0) / (y1 - y0) + x0 GROUP BY ALL HAVING count(*) % 2 = 1)
SELECT set_id, point_ix, roi_ix FROM i JOIN a USING (set_id, roi_ix, poly_ix) GROUP BY ALL HAVING bool_or(area >= 0) <> bool_or(area < 0)""",
)
def region_membership(spark, sf_dir):
    """Five points of each customer against the regions of the customer's orders."""
    points = fx.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("set_id"), F.explode(F.sequence(F.lit(0), F.lit(4))).alias("point_ix"))
    points = points.withColumns({"x": 5.3 + 9 * F.col("point_ix"), "y": 10.7 + 18 * F.col("point_ix")})
    return roi.region_membership(points, fx.customer_rois(spark, sf_dir))


@query(
    "r08_split_subpaths",
    cte("pc")
    + """, n AS (SELECT *, sum((cmd = 'M')::INT) OVER (PARTITION BY path_id ORDER BY cmd_ix) - 1 AS poly_ix FROM pc),
k AS (SELECT *, min(CASE WHEN cmd = 'Q' THEN poly_ix END) OVER (PARTITION BY path_id) AS bad, count(*) OVER (PARTITION BY path_id, poly_ix) AS n,
  row_number() OVER (PARTITION BY path_id, poly_ix ORDER BY cmd_ix) - 1 AS vertex_ix FROM n),
g AS (SELECT * FROM k WHERE n > 1 AND (bad IS NULL OR poly_ix < bad)),
b AS (SELECT path_id, poly_ix, arg_min(x, vertex_ix) AS fx, arg_min(y, vertex_ix) AS fy, max(x) - min(x) AS w, max(y) - min(y) AS h FROM g WHERE n = 3 GROUP BY ALL)
SELECT path_id, poly_ix, vertex_ix, round(x, 6) AS x, round(y, 6) AS y, 'polygon' AS kind FROM g WHERE n <> 3
UNION ALL SELECT path_id, poly_ix, i, round(fx + w * (i IN (1, 2))::INT, 6), round(fy + h * (i IN (2, 3))::INT, 6), 'rectangle' FROM b, range(4) r(i)""",
)
def split_subpaths(spark, sf_dir):
    return rounded(roi.split_subpaths(fx.path_commands(spark, sf_dir)), "x", "y")


@query(
    "r08_plain_shapes",
    """WITH sh AS (SELECT DISTINCT l_orderkey * 10 + l_linenumber AS path_id, ['rectangle', 'ellipse', 'line', 'polygon'][(l_linenumber % 4 + 1)::INT] AS kind, trunc(l_quantity + 0.7) AS x, trunc(0 - l_extendedprice / 1000) AS y, trunc(l_partkey % 90 + 0.9) AS w, trunc(l_suppkey % 40 + 0.4) AS h FROM lineitem),
st AS (SELECT *, greatest(8, ceil(pi() / acos(1 - least(CASE WHEN greatest(w, h) = 0 THEN 1 ELSE 0.1 / (greatest(w, h) / 2) END, 1))))::INT AS n FROM sh),
v AS (SELECT path_id, i AS vertex_ix, x + w * (i IN (1, 2))::INT AS x, y + h * (i IN (2, 3))::INT AS y, kind FROM sh, range(4) r(i) WHERE kind = 'rectangle'
  UNION ALL SELECT path_id, i, CASE i WHEN 0 THEN x ELSE w END, CASE i WHEN 0 THEN y ELSE h END, kind FROM sh, range(2) r(i) WHERE kind = 'line'
  UNION ALL SELECT path_id, i, CASE i WHEN 0 THEN x WHEN 1 THEN w ELSE x END, CASE i WHEN 0 THEN y WHEN 1 THEN h ELSE h END, kind FROM sh, range(3) r(i) WHERE kind = 'polygon'
  UNION ALL SELECT path_id, i, x + w / 2 + w / 2 * cos(2 * pi() * i / n), y + h / 2 + h / 2 * sin(2 * pi() * i / n), kind FROM (SELECT *, unnest(range(n)) AS i FROM st WHERE kind = 'ellipse'))
SELECT path_id, 0 AS poly_ix, vertex_ix, round(x, 6) + 0.0 AS x, round(y, 6) + 0.0 AS y, kind FROM v""",
)
def plain_shapes(spark, sf_dir):
    """A rectangle, ellipse, line or triangle for each line of an order; lines whose whole numbers are equal make one shape."""
    lines = fx.table(spark, sf_dir, "lineitem")
    kind = F.element_at(F.array(*[F.lit(k) for k in ("rectangle", "ellipse", "line", "polygon")]), (F.col("l_linenumber") % 4 + 1).cast("int"))
    x, y, w, h = F.col("l_quantity") + 0.7, 0 - F.col("l_extendedprice") / 1000, F.col("l_partkey") % 90 + 0.9, F.col("l_suppkey") % 40 + 0.4
    a = F.when(kind == "polygon", F.array(x, y, w, h, x, h)).otherwise(F.array(x, y, w, h))
    shapes = lines.select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("path_id"), kind.alias("kind"), a.alias("a"))
    shapes = shapes.withColumn("cut", F.transform("a", lambda v: v.cast("bigint"))).dropDuplicates(["path_id", "kind", "cut"])
    return rounded(roi.plain_shapes(shapes), "x", "y")


@query("r09_bounding_boxes", cte("cr") + " SELECT set_id, roi_ix, floor(min(x))::BIGINT AS x, floor(min(y))::BIGINT AS y, (ceil(max(x)) - floor(min(x)))::BIGINT AS width, (ceil(max(y)) - floor(min(y)))::BIGINT AS height FROM cr GROUP BY ALL")
def bounding_boxes(spark, sf_dir):
    return roi.bounding_boxes(fx.customer_rois(spark, sf_dir))


@query("r10_canvas_size", cte("cr") + " SELECT set_id, greatest(100, ceil(max(x)))::BIGINT AS width, greatest(100, ceil(max(y)))::BIGINT AS height FROM cr GROUP BY ALL")
def canvas_size(spark, sf_dir):
    return roi.canvas_size(fx.customer_rois(spark, sf_dir))


@query(
    "r11_rasterize_rois",
    cte("ep")
    + f""", a AS ({area_sql("ep")}),
l AS (SELECT set_id, roi_ix, 2 * (row_number() OVER (PARTITION BY set_id ORDER BY roi_ix) - 1) + 1 AS label,
  greatest(0, floor(min(x)))::INT AS ax, ceil(max(x))::INT AS bx, greatest(0, floor(min(y)))::INT AS ay, ceil(max(y))::INT AS b_y FROM ep GROUP BY set_id, roi_ix),
e AS (SELECT set_id, roi_ix, x AS x0, y AS y0, {WRAP.format("x")} AS x1, {WRAP.format("y")} AS y1 FROM ep {RING}),
py AS (SELECT *, unnest(range(ay, b_y + 1)) AS y FROM l),
c AS (SELECT roi_ix, label, set_id, ax, bx, y, (x1 - x0) * (y + 0.5 - y0) / (y1 - y0) + x0 AS cut FROM py JOIN e USING (set_id, roi_ix) WHERE (y0 > y + 0.5) <> (y1 > y + 0.5)),
px AS (SELECT *, unnest(range(ax, bx + 1)) AS x FROM c),
i AS (SELECT set_id, roi_ix, label, y, x FROM px WHERE x + 0.5 < cut GROUP BY ALL HAVING count(*) % 2 = 1)
SELECT set_id, y, x, max(label) AS label FROM i GROUP BY set_id, y, x""",
)
def rasterize_rois(spark, sf_dir):
    return roi.rasterize_rois(fx.embedding_polygons(spark, sf_dir))


def _stretch_sql(source: str, closed: bool) -> str:
    x, y = (WRAP.format("x"), WRAP.format("y")) if closed else ("lead(x) OVER w", "lead(y) OVER w")
    return f"""s AS (SELECT set_id, roi_ix, poly_ix, vertex_ix, x, y, {x} AS x1, {y} AS y1 FROM {source} {RING}),
d AS (SELECT *, coalesce(sqrt((x1 - x) ** 2 + (y1 - y) ** 2), 0) AS len FROM s),
q AS (SELECT *, sum(len) OVER (PARTITION BY set_id, roi_ix, poly_ix ORDER BY vertex_ix) AS e, sum(len) OVER (PARTITION BY set_id, roi_ix, poly_ix) AS total FROM d)"""


@query(
    "r12_sample_path",
    cte("op") + ", " + _stretch_sql("op", False) + """,
k AS (SELECT *, unnest(range(ceil((e - len) / 10)::INT, ceil(e / 10)::INT)) AS k FROM q WHERE len > 0)
SELECT set_id, roi_ix, poly_ix, k AS vertex_ix, round(x + (k * 10 - e + len) / len * (x1 - x), 6) + 0.0 AS x, round(y + (k * 10 - e + len) / len * (y1 - y), 6) + 0.0 AS y FROM k WHERE k < floor(total / 10)""",
)
def sample_path(spark, sf_dir):
    return rounded(roi.sample_path(fx.order_polygons(spark, sf_dir), 10.0), "x", "y")


@query(
    "r13_resample_polygon",
    cte("op") + ", " + _stretch_sql("op", True) + """,
k AS (SELECT *, unnest(range(greatest(1, ceil((e - len) / 7.5))::INT, ceil(e / 7.5)::INT)) AS k FROM q WHERE len > 0),
z AS (SELECT set_id, roi_ix, poly_ix, any_value(total) AS total, arg_min(x, vertex_ix) AS x, arg_min(y, vertex_ix) AS y FROM q GROUP BY ALL HAVING count(*) > 1)
SELECT set_id, roi_ix, poly_ix, k - 1 AS vertex_ix, round(x + (k * 7.5 - e + len) / len * (x1 - x), 6) + 0.0 AS x, round(y + (k * 7.5 - e + len) / len * (y1 - y), 6) + 0.0 AS y FROM k
UNION ALL SELECT set_id, roi_ix, poly_ix, greatest(ceil(total / 7.5) - 1, 0)::BIGINT, round(x, 6), round(y, 6) FROM z""",
)
def resample_polygon(spark, sf_dir):
    return rounded(roi.resample_polygon(fx.order_polygons(spark, sf_dir), 7.5), "x", "y")


def _smooth_sql(source: str, near: str, allowed: str) -> str:
    return f""", n AS (SELECT set_id, roi_ix, poly_ix, vertex_ix, x, y, {near} FROM {source} {RING}),
c AS (SELECT *, nullif(sqrt((xa - xb) ** 2 + (ya - yb) ** 2), 0) AS len FROM n),
o AS (SELECT *, (xa - xb) / len AS dx, (ya - yb) / len AS dy, (x - xb) * ((ya - yb) / len) - (y - yb) * ((xa - xb) / len) AS off FROM c)
SELECT set_id, roi_ix, poly_ix, vertex_ix, round(CASE WHEN {allowed} THEN coalesce(x - 0.5 * off * dy, x) ELSE x END, 6) + 0.0 AS x, round(CASE WHEN {allowed} THEN coalesce(y + 0.5 * off * dx, y) ELSE y END, 6) + 0.0 AS y FROM o"""


@query("r14_smooth_open", cte("op") + _smooth_sql("op", "lag(x) OVER w AS xb, lag(y) OVER w AS yb, lead(x) OVER w AS xa, lead(y) OVER w AS ya", "true"))
def smooth_open(spark, sf_dir):
    return rounded(roi.smooth_open(fx.order_polygons(spark, sf_dir)), "x", "y")


@query(
    "r15_smooth_constrained",
    cte("op")
    + _smooth_sql("op", ", ".join(f"coalesce(lag({c}) OVER w, last_value({c}) OVER f) AS {c}b, {WRAP.format(c)} AS {c}a" for c in "xy"), "(trunc(x) + trunc(y)) % 2 = 0"),
)
def smooth_constrained(spark, sf_dir):
    """Corners of an even sum may move."""
    vertices = fx.order_polygons(spark, sf_dir)
    corners = vertices.select("set_id", F.col("x").cast("int").alias("x"), F.col("y").cast("int").alias("y")).distinct().withColumn("movable", (F.col("x") + F.col("y")) % 2 == 0)
    return rounded(roi.smooth_constrained(vertices, corners), "x", "y")


@query(
    "r16_unique_roi_names",
    cte("rn")
    + """, k AS (SELECT *, row_number() OVER (PARTITION BY set_id, name ORDER BY roi_ix) - 1 AS k FROM rn),
u AS (SELECT set_id, roi_ix, name, CASE WHEN k = 0 THEN name ELSE name || '-' || k END AS unique_name FROM k)
SELECT *, count(*) OVER (PARTITION BY set_id, unique_name) > 1 AS collides FROM u""",
)
def unique_roi_names(spark, sf_dir):
    return roi.unique_roi_names(fx.roi_names(spark, sf_dir))


@query("r17_roi_names_from_labels", cte("lab") + " SELECT DISTINCT image_id, label, trunc(label)::INT::VARCHAR AS name FROM lab")
def roi_names_from_labels(spark, sf_dir):
    return roi.roi_names_from_labels(fx.label_raster(spark, sf_dir).select("image_id", "label").distinct())


@query(
    "s08_read_rois",
    cte("cr", "rn") + " SELECT 'vertices' AS part, set_id, roi_ix, poly_ix, vertex_ix, x, y, NULL AS name FROM cr WHERE vertex_ix > 0 UNION ALL SELECT 'rois', set_id, roi_ix, NULL, NULL, NULL, NULL, name FROM rn",
)
def read_rois(spark, sf_dir):
    """Region tables written and read again; first vertices are written without a place, and so dropped."""
    path = folder(spark, "rois")
    vertices = fx.customer_rois(spark, sf_dir).withColumn("x", F.when(F.col("vertex_ix") > 0, F.col("x")))
    tables.write_rois(fx.roi_names(spark, sf_dir), vertices, path)
    rois, back = tables.read_rois(spark, path)
    return back.withColumn("part", F.lit("vertices")).unionByName(rois.withColumn("part", F.lit("rois")), allowMissingColumns=True)
