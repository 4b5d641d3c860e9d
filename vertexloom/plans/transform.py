"""Queries of the transform and image pair operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vertexloom.functions.settle import folder
from vertexloom.operators import transform
from vertexloom.plans import fixtures as fx
from vertexloom.plans.fixtures import cte, recursive
from vertexloom.plans.registry import query
from vertexloom.plans.roi import rounded
from vertexloom.sources import tables

LINKED = ", li AS (SELECT *, row_number() OVER w - 1 AS place, lag(step) OVER w AS prev_step FROM ch WINDOW w AS (PARTITION BY chain_id ORDER BY step)), lk AS (SELECT chain_id, step, kind, params, prev_step FROM li WHERE place = step)"


def moved_sql(points: str) -> str:
    """``pts`` has the points of ``points`` (chain_id, id columns k, x, y) after all linked steps of their chain."""
    x = "CASE kind WHEN 'translation' THEN x + params[1] WHEN 'euler' THEN cos(params[1]) * (x - params[4]) - sin(params[1]) * (y - params[5]) + params[4] + params[2] ELSE params[1] * (x - params[7]) + params[2] * (y - params[8]) + params[7] + params[5] END"
    y = "CASE kind WHEN 'translation' THEN y + params[2] WHEN 'euler' THEN sin(params[1]) * (x - params[4]) + cos(params[1]) * (y - params[5]) + params[5] + params[3] ELSE params[3] * (x - params[7]) + params[4] * (y - params[8]) + params[8] + params[6] END"
    return f""", go AS (SELECT chain_id, k, x::DOUBLE AS x, y::DOUBLE AS y, 0::BIGINT AS done FROM {points}
  UNION ALL SELECT go.chain_id, k, {x}, {y}, done + 1 FROM go JOIN lk ON lk.chain_id = go.chain_id AND lk.step = done),
pts AS (SELECT chain_id, k, arg_max(x, done) AS x, arg_max(y, done) AS y FROM go GROUP BY chain_id, k)"""


def _customer_points(spark, sf_dir) -> DataFrame:
    """Corners of customers' orders: a point for each line."""
    cr = fx.customer_rois(spark, sf_dir)
    return cr.select(F.col("set_id").alias("chain_id"), "roi_ix", "poly_ix", "vertex_ix", "x", "y")


CUSTOMER_POINTS = "(SELECT set_id AS chain_id, {'r': roi_ix, 'p': poly_ix, 'v': vertex_ix} AS k, x, y FROM cr)"


def _linked(spark, sf_dir) -> DataFrame:
    return transform.relink_chain(fx.chains(spark, sf_dir)).drop("prev_step")


@query("t01_transform_points", recursive(cte("cr", "ch0", "ch") + LINKED + moved_sql(CUSTOMER_POINTS) + " SELECT chain_id, k.r AS roi_ix, k.p AS poly_ix, k.v AS vertex_ix, round(x, 6) + 0.0 AS x, round(y, 6) + 0.0 AS y FROM pts"))
def transform_points(spark, sf_dir):
    return rounded(transform.transform_points(_customer_points(spark, sf_dir), _linked(spark, sf_dir)), "x", "y")


@query("t02_relink_chain", cte("ch0", "ch") + LINKED + " SELECT chain_id, step, kind, params, prev_step FROM lk")
def relink_chain(spark, sf_dir):
    return transform.relink_chain(fx.chains(spark, sf_dir))


@query("s07_read_chains", cte("ch0", "ch") + LINKED + " SELECT chain_id, step, kind, params, prev_step FROM lk")
def read_chains(spark, sf_dir):
    """Chains written as a table and read again: up to their gaps."""
    path = folder(spark, "chains")
    tables.write_chains(fx.chains(spark, sf_dir), path)
    return tables.read_chains(spark, path)


@query(
    "s07_read_chain_settings",
    cte("ch0", "ch")
    + LINKED
    + """, st AS (SELECT o_custkey AS chain_id, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS step, o_orderpriority AS priority, o_orderstatus AS status FROM orders),
sk AS (SELECT * FROM st WHERE NOT (chain_id % 5 = 0 AND step >= 3) AND NOT (chain_id % 2 = 0 AND step = 1 AND chain_id % 3 = 0)),
sl AS (SELECT *, row_number() OVER (PARTITION BY chain_id ORDER BY step) - 1 AS place FROM sk)
SELECT coalesce(lk.chain_id, sl.chain_id) AS chain_id, coalesce(lk.step, sl.step) AS step, kind, params, prev_step, priority, status FROM lk FULL JOIN (SELECT * FROM sl WHERE place = step) sl ON lk.chain_id = sl.chain_id AND lk.step = sl.step""",
)
def read_chain_settings(spark, sf_dir):
    """Chains and settings written together and read again: both up to their own gaps, some steps with settings alone."""
    order = Window.partitionBy("o_custkey").orderBy("o_orderkey")
    kept = fx.table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("chain_id"), (F.row_number().over(order) - 1).alias("step"), F.create_map(F.lit("priority"), "o_orderpriority", F.lit("status"), "o_orderstatus").alias("settings"))
    kept = kept.filter("not (chain_id % 5 = 0 and step >= 3) and not (chain_id % 2 = 0 and step = 1 and chain_id % 3 = 0)")
    path = folder(spark, "chains")
    tables.write_chains(fx.chains(spark, sf_dir), path, kept)
    rows = tables.read_chain_settings(spark, path)
    return rows.select("chain_id", "step", "kind", "params", "prev_step", F.col("settings")["priority"].alias("priority"), F.col("settings")["status"].alias("status"))


@query("t03_final_transform", cte("ch0", "ch") + " SELECT chain_id, max(step) AS step, arg_max(kind, step) AS kind, arg_max(params, step) AS params FROM ch GROUP BY chain_id")
def final_transform(spark, sf_dir):
    return transform.final_transform(fx.chains(spark, sf_dir))


@query("t04_invert_chain", cte("cr") + " SELECT set_id AS chain_id, roi_ix, poly_ix, vertex_ix, round(x, 5) + 0.0 AS x, round(y, 5) + 0.0 AS y FROM cr")
def invert_chain(spark, sf_dir):
    """Points mapped by their chain and back again: where they were."""
    chains = _linked(spark, sf_dir)
    there = transform.transform_points(_customer_points(spark, sf_dir), chains)
    return rounded(transform.transform_points(there, transform.invert_chain(chains)), "x", "y", places=5)


IMAGE_POINTS = "(SELECT image_id + 1 AS chain_id, {'i': image_id, 'y': y, 'x': x} AS k, x, y FROM gray)"


def _chained_images(spark, sf_dir) -> DataFrame:
    return fx.gray_raster(spark, sf_dir).select("image_id", (F.col("image_id") + 1).alias("chain_id"), "y", "x", "v")


@query(
    "t05_transform_image",
    recursive(
        cte("gray", "ch0", "ch")
        + LINKED
        + moved_sql(IMAGE_POINTS)
        + """, f AS (SELECT k.i AS image_id, chain_id, k.y AS y, k.x AS x, floor(x)::INT AS fx, floor(y)::INT AS fy, x - floor(x) AS wx, y - floor(y) AS wy FROM pts)
SELECT f.image_id, chain_id, f.y, f.x, round(coalesce(sum((CASE WHEN i = 1 THEN wx ELSE 1 - wx END) * (CASE WHEN j = 1 THEN wy ELSE 1 - wy END) * v), 0), 6) + 0.0 AS v
FROM f CROSS JOIN range(2) a(i) CROSS JOIN range(2) b(j) LEFT JOIN gray g ON g.image_id = f.image_id AND g.x = fx + i AND g.y = fy + j GROUP BY f.image_id, chain_id, f.y, f.x"""
    ),
)
def transform_image(spark, sf_dir):
    return rounded(transform.transform_image(_chained_images(spark, sf_dir), _linked(spark, sf_dir)), "v")


@query(
    "t05_transform_image_nearest",
    recursive(
        cte("gray", "ch0", "ch")
        + LINKED
        + moved_sql(IMAGE_POINTS)
        + " SELECT k.i AS image_id, chain_id, k.y AS y, k.x AS x, round(coalesce(v, 0), 6) + 0.0 AS v FROM pts LEFT JOIN gray g ON g.image_id = k.i AND g.x = floor(pts.x + 0.5)::INT AND g.y = floor(pts.y + 0.5)::INT"
    ),
)
def transform_image_nearest(spark, sf_dir):
    return rounded(transform.transform_image(_chained_images(spark, sf_dir), _linked(spark, sf_dir), 0), "v")


def _mirror_sql(i: str, n: str) -> str:
    return f"CASE WHEN abs({i}) > {n} - 1 THEN 2 * ({n} - 1) - abs({i}) ELSE abs({i}) END"


#: Cubic spline coefficients by direct convolution with the prefilter's impulse response, 30 pixels to either side, mirrored at the ends.
SPLINE = ", hh AS (SELECT image_id, max(x) + 1 AS w, max(y) + 1 AS h FROM gray GROUP BY image_id), zz AS (SELECT d, -6 * z / (1 - z * z) * z ** abs(d) AS q FROM range(-30, 31) r(d), (SELECT sqrt(3) - 2 AS z))" + "".join(
    f""", {name} AS (SELECT p.image_id, p.y, p.x, sum(q * s.v) AS v FROM {source} p JOIN hh USING (image_id) CROSS JOIN zz JOIN {source} s ON s.image_id = p.image_id AND s.{other} = p.{other} AND s.{along} = {_mirror_sql(f"(p.{along} + d)", f"hh.{size}")} GROUP BY ALL)"""
    for name, source, along, other, size in (("c1", "gray", "x", "y", "w"), ("c2", "c1", "y", "x", "h"))
)
TAPS = ", tp AS (SELECT * FROM (VALUES (-1), (0), (1), (2)) v(i))"


def _tap_sql(i: str, t: str) -> str:
    return f"CASE {i} WHEN -1 THEN (1 - {t}) ** 3 / 6 WHEN 0 THEN (3 * {t} ** 3 - 6 * {t} ** 2 + 4) / 6 WHEN 1 THEN (-3 * {t} ** 3 + 3 * {t} ** 2 + 3 * {t} + 1) / 6 ELSE {t} ** 3 / 6 END"


@query(
    "t05_cubic",
    recursive(
        cte("gray", "ch0", "ch")
        + LINKED
        + moved_sql(IMAGE_POINTS)
        + SPLINE
        + TAPS
        + f""", f AS (SELECT k.i AS image_id, chain_id, k.y AS y, k.x AS x, floor(pts.x)::INT AS fx, floor(pts.y)::INT AS fy, pts.x - floor(pts.x) AS wx, pts.y - floor(pts.y) AS wy, pts.x BETWEEN 0 AND w - 1 AND pts.y BETWEEN 0 AND h - 1 AS inside, w, h FROM pts JOIN hh ON hh.image_id = k.i),
b AS (SELECT f.image_id, chain_id, f.y, f.x, sum(({_tap_sql("a.i", "wx")}) * ({_tap_sql("b.i", "wy")}) * c2.v) AS v FROM f CROSS JOIN tp a CROSS JOIN tp b
  JOIN c2 ON c2.image_id = f.image_id AND c2.x = {_mirror_sql("(fx + a.i)", "w")} AND c2.y = {_mirror_sql("(fy + b.i)", "h")} WHERE inside GROUP BY ALL)
SELECT f.image_id, f.chain_id, f.y, f.x, round(coalesce(b.v, 0), 6) + 0.0 AS v FROM f LEFT JOIN b ON b.image_id = f.image_id AND b.chain_id = f.chain_id AND b.y = f.y AND b.x = f.x"""
    ),
)
def transform_image_cubic(spark, sf_dir):
    return rounded(transform.transform_image(_chained_images(spark, sf_dir), _linked(spark, sf_dir), 3), "v")


PAIRS = ", pr AS (SELECT a.image_id AS pair_id, a.y AS y, a.x AS x, a.v + 1 AS fixed, b.v + 1 AS moving FROM gray a JOIN gray b ON b.image_id = a.image_id + 1 AND b.y = a.y AND b.x = a.x)"


def _pairs(spark, sf_dir) -> DataFrame:
    """Each image and the next one."""
    gray = fx.gray_raster(spark, sf_dir)
    fixed = gray.select(F.col("image_id").alias("pair_id"), "y", "x", (F.col("v") + 1).alias("fixed"))
    moving = gray.select((F.col("image_id") - 1).alias("pair_id"), "y", "x", (F.col("v") + 1).alias("moving"))
    return fixed.join(moving, ["pair_id", "y", "x"])


@query(
    "t06_pair_similarity",
    cte("gray")
    + PAIRS
    + """, s AS (SELECT *, min(fixed) OVER p AS fl, max(fixed) OVER p AS fh, min(moving) OVER p AS ml, max(moving) OVER p AS mh FROM pr WINDOW p AS (PARTITION BY pair_id)),
j AS (SELECT pair_id, least(31, floor((fixed - fl) / (fh - fl) * 32)) AS bf, least(31, floor((moving - ml) / (mh - ml) * 32)) AS bm, count(*) AS k FROM s GROUP BY ALL),
t AS (SELECT pair_id, k, sum(k) OVER (PARTITION BY pair_id) AS n, sum(k) OVER (PARTITION BY pair_id, bf) AS nf, sum(k) OVER (PARTITION BY pair_id, bm) AS nm FROM j)
SELECT pair_id, round(sum(k / n * ln(k * n / (nf * nm))), 6) AS mutual_information, any_value(d) AS mean_square FROM t
JOIN (SELECT pair_id, round(avg((fixed - moving) ** 2), 6) AS d FROM pr GROUP BY pair_id) USING (pair_id) GROUP BY pair_id""",
)
def pair_similarity(spark, sf_dir):
    return rounded(transform.pair_similarity(_pairs(spark, sf_dir)), "mutual_information", "mean_square")


SOFT = """, cp AS (SELECT pair_id, 0 AS c, y, x, fixed, moving FROM pr UNION ALL SELECT pair_id, 1, y, x, 2 * fixed, moving * moving FROM pr),
ce AS (SELECT pair_id, c, min(fixed) AS fl, max(fixed) AS fh, min(moving) AS ml, max(moving) AS mh FROM cp GROUP BY ALL),
cb AS (SELECT pair_id, c, least(29, floor((fixed - fl) * 28 / (fh - fl) + 2)) AS bf, (moving - ml) * 28 / (mh - ml) + 2 AS place FROM cp JOIN ce USING (pair_id, c)),
ct AS (SELECT *, least(29, floor(place)) AS low, place - least(29, floor(place)) AS t FROM cb)"""


@query(
    "t06_weighted_similarity",
    cte("gray")
    + PAIRS
    + SOFT
    + TAPS
    + f""", j AS (SELECT pair_id, c, bf, low + i AS bm, sum({_tap_sql("i", "t")}) AS w FROM ct CROSS JOIN tp GROUP BY ALL HAVING sum({_tap_sql("i", "t")}) > 0),
s AS (SELECT *, sum(w) OVER (PARTITION BY pair_id, c) AS n, sum(w) OVER (PARTITION BY pair_id, c, bf) AS nf, sum(w) OVER (PARTITION BY pair_id, c, bm) AS nm FROM j),
m AS (SELECT pair_id, c, sum(w / n * ln(w * n / (nf * nm))) AS info FROM s GROUP BY ALL),
d AS (SELECT pair_id, c, avg((fixed - moving) ** 2) AS square FROM cp GROUP BY ALL)
SELECT pair_id, round(sum(info * (3 - 2 * c) / 4), 6) AS mutual_information, round(sum(square * (3 - 2 * c) / 4), 6) AS mean_square FROM m JOIN d USING (pair_id, c) GROUP BY pair_id""",
)
def weighted_similarity(spark, sf_dir):
    """Two channels, the first one counting three times as much."""
    one = _pairs(spark, sf_dir).withColumn("c", F.lit(0))
    both = one.unionByName(one.withColumns({"c": F.lit(1), "fixed": 2 * F.col("fixed"), "moving": F.col("moving") * F.col("moving")}))
    return rounded(transform.weighted_similarity(both, {0: 0.75, 1: 0.25}), "mutual_information", "mean_square")


def _gauss_sql(source: str, name: str, sigma: float, keys: str) -> str:
    """``name`` has ``source`` (keys, y, x, v) smoothed along x, then y, over the pixels within three deviations."""
    out, last = "", source
    for i, (along, other) in enumerate((("x", "y"), ("y", "x"))):
        to = name if i else f"{name}_x"
        on = " AND ".join(f"p.{k} = s.{k}" for k in keys.split(", "))
        out += f""", {to} AS (SELECT {", ".join(f"p.{k}" for k in keys.split(", "))}, p.y, p.x, sum(s.v * exp(-0.5 * (d / {sigma}) ** 2)) / sum(exp(-0.5 * (d / {sigma}) ** 2)) AS v
  FROM {last} p CROSS JOIN range(-ceil(3 * {sigma})::INT, ceil(3 * {sigma})::INT + 1) r(d) JOIN {last} s ON {on} AND s.{other} = p.{other} AND s.{along} = p.{along} + d GROUP BY ALL)"""
        last = to
    return out


@query(
    "t07_smoothing_pyramid",
    cte("gray") + _gauss_sql("gray", "g0", 4.0, "image_id") + _gauss_sql("gray", "g1", 1.0, "image_id")
    + " SELECT image_id, 0 AS level, y, x, round(v, 6) + 0.0 AS v FROM g0 UNION ALL SELECT image_id, 1, y, x, round(v, 6) + 0.0 FROM g1",
)
def smoothing_pyramid(spark, sf_dir):
    return rounded(transform.smoothing_pyramid(fx.gray_raster(spark, sf_dir), [(8, 8), (2, 2)]), "v")


@query(
    "t07_recursive_pyramid",
    cte("gray") + _gauss_sql("gray", "g1", 1.0, "image_id") + ", k1 AS (SELECT image_id, y // 2 AS y, x // 2 AS x, v FROM g1 WHERE y % 2 = 0 AND x % 2 = 0)"
    + _gauss_sql("k1", "g0", 2.0, "image_id") + ", k0 AS (SELECT image_id, y // 4 AS y, x // 4 AS x, v FROM g0 WHERE y % 4 = 0 AND x % 4 = 0)"
    + " SELECT image_id, 0 AS level, y::INT AS y, x::INT AS x, round(v, 6) + 0.0 AS v FROM k0 UNION ALL SELECT image_id, 1, y::INT, x::INT, round(v, 6) + 0.0 FROM k1",
)
def recursive_pyramid(spark, sf_dir):
    return rounded(transform.recursive_pyramid(fx.gray_raster(spark, sf_dir), [(8, 8), (2, 2)]), "v")


@query(
    "t07_image_pyramid",
    cte("gray") + " SELECT image_id, level, (y // f)::INT AS y, (x // f)::INT AS x, round(avg(v), 6) + 0.0 AS v FROM gray, (VALUES (0, 8), (1, 4), (2, 2)) l(level, f) GROUP BY ALL",
)
def image_pyramid(spark, sf_dir):
    return rounded(transform.image_pyramid(fx.gray_raster(spark, sf_dir), [(8, 8), (4, 4), (2, 2)]), "v")


@query(
    "t08_initial_alignment",
    cte("gray") + PAIRS + " SELECT pair_id, round(sum(moving * x) / sum(moving) - sum(fixed * x) / sum(fixed), 6) + 0.0 AS tx, round(sum(moving * y) / sum(moving) - sum(fixed * y) / sum(fixed), 6) + 0.0 AS ty FROM pr GROUP BY pair_id",
)
def initial_alignment(spark, sf_dir):
    return rounded(transform.initial_alignment(_pairs(spark, sf_dir)), "tx", "ty")


@query(
    "t08_initial_alignment_by_middles",
    cte("gray") + """, m AS (SELECT image_id, max(x) FILTER (v > 0) + min(x) FILTER (v > 0) AS x, max(y) FILTER (v > 0) + min(y) FILTER (v > 0) AS y, min(x) FILTER (v > 0) AS ox, min(y) FILTER (v > 0) AS oy FROM gray WHERE NOT (x < image_id % 5 OR y < image_id % 3) GROUP BY image_id)
SELECT a.image_id AS pair_id, (b.x - a.x) / 2 AS tx, (b.y - a.y) / 2 AS ty, (b.ox - a.ox)::DOUBLE AS origin_tx, (b.oy - a.oy)::DOUBLE AS origin_ty FROM m a JOIN m b ON b.image_id = a.image_id + 1""",
)
def initial_alignment_by_middles(spark, sf_dir):
    """The pixels over 0 of images that lack some rows and columns, by their middles and by their origins."""
    gray = fx.gray_raster(spark, sf_dir).filter("v > 0 and not (x < image_id % 5 or y < image_id % 3)")
    fixed = gray.select(F.col("image_id").alias("pair_id"), "y", "x", F.col("v").alias("fixed"))
    moving = gray.select((F.col("image_id") - 1).alias("pair_id"), "y", "x", F.col("v").alias("moving"))
    pairs = fixed.join(moving, ["pair_id", "y", "x"], "full")
    middles, origins = (transform.initial_alignment(pairs, method) for method in ("GeometricalCenter", "Origins"))
    both = middles.join(origins.withColumnsRenamed({"tx": "origin_tx", "ty": "origin_ty"}), "pair_id")
    return both.dropna()


@query(
    "t09_sample_pixels",
    cte("gray") + ", o AS (SELECT image_id, y, x, row_number() OVER (PARTITION BY image_id ORDER BY xor(xor(x::BIGINT * 73856093, y::BIGINT * 19349663), 83492791 * 3) % 2147483647, y, x) AS k FROM gray) SELECT image_id, y, x FROM o WHERE k <= 512",
)
def sample_pixels(spark, sf_dir):
    """512 pixels of each image: the sample is what the operator is for."""
    return transform.sample_pixels(fx.gray_raster(spark, sf_dir), 512, 3).select("image_id", "y", "x")


@query(
    "t09_sample_coordinates",
    cte("gray")
    + """, e AS (SELECT image_id, min(x) AS lx, max(x) AS hx, min(y) AS ly, max(y) AS hy FROM gray GROUP BY image_id),
m AS (SELECT *, xor(xor(k * 73856093, image_id * 19349663), 7 * 83492791 + 2 * 2654435761) % 2147483647 AS mixed FROM e, range(300) r(k)),
u AS (SELECT *, (mixed * 48271 + 1) % 2147483647 * 48271 % 2147483647 AS u FROM m),
p AS (SELECT image_id, k, lx + u / 2147483647 * (hx - lx) AS x, ly + (u * 48271 % 2147483647) / 2147483647 * (hy - ly) AS y FROM u)
SELECT p.image_id, k, round(p.x, 6) AS x, round(p.y, 6) AS y, round(sum(g.v * (1 - abs(g.x - p.x)) * (1 - abs(g.y - p.y))), 6) + 0.0 AS v
FROM p JOIN gray g ON g.image_id = p.image_id AND g.x IN (floor(p.x), floor(p.x) + 1) AND g.y IN (floor(p.y), floor(p.y) + 1) GROUP BY p.image_id, k, p.x, p.y""",
)
def sample_coordinates(spark, sf_dir):
    """300 places of each image off the lattice, those of the third iteration."""
    return rounded(transform.sample_coordinates(fx.gray_raster(spark, sf_dir), 300, 7, 2), "x", "y", "v")


@query("t09_samplers", cte("gray") + " SELECT 'Grid' AS sampler, image_id, x::DOUBLE AS x, y::DOUBLE AS y, round(v, 6) + 0.0 AS v FROM gray WHERE x % 3 = 0 AND y % 2 = 0 UNION ALL SELECT 'Full', image_id, x, y, round(v, 6) + 0.0 FROM gray")
def samplers(spark, sf_dir):
    gray = fx.gray_raster(spark, sf_dir)
    grid, full = (transform.sample(gray, s, spacing=(3, 2)).select(F.lit(s).alias("sampler"), "*") for s in ("Grid", "Full"))
    return rounded(grid.unionByName(full), "v")


@query(
    "t10_deformation_stats",
    recursive(
        cte("cr", "ch0", "ch")
        + LINKED
        + moved_sql(CUSTOMER_POINTS)
        + """, d AS (SELECT chain_id AS set_id, (p.x - c.x) ** 2 + (p.y - c.y) ** 2 AS s FROM pts p JOIN cr c ON c.set_id = p.chain_id AND c.roi_ix = k.r AND c.poly_ix = k.p AND c.vertex_ix = k.v)
SELECT set_id, round(avg(sqrt(s)), 5) AS mean, round(max(sqrt(s)), 5) AS greatest, round(sqrt(avg(s)), 5) AS rms FROM d GROUP BY set_id"""
    ),
)
def deformation_stats(spark, sf_dir):
    points = _customer_points(spark, sf_dir)
    both = transform.transform_points(points.withColumns({"in_x": F.col("x"), "in_y": F.col("y")}), _linked(spark, sf_dir))
    renamed = both.select(F.col("chain_id").alias("set_id"), "in_x", "in_y", F.col("x").alias("out_x"), F.col("y").alias("out_y"))
    return rounded(transform.deformation_stats(renamed), "mean", "greatest", "rms", places=5)
