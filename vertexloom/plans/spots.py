"""Queries of the spot and section operators and of the file forms."""

from __future__ import annotations

from pyspark.sql import functions as F

from vertexloom.functions.settle import folder
from vertexloom.operators import sections, spots
from vertexloom.plans import fixtures as fx
from vertexloom.plans.fixtures import cte
from vertexloom.plans.registry import query
from vertexloom.plans.roi import _stretch_sql, rounded
from vertexloom.sources import frames, points, svg
from vertexloom.sources import spots as spot_files
from vertexloom.sources.files import write_files


@query(
    "p01_name_spots",
    cte("sp")
    + """, k AS (SELECT *, row_number() OVER (PARTITION BY file ORDER BY spot_ix) AS i, count(*) OVER (PARTITION BY file) AS n FROM sp)
SELECT file, spot_ix, 'Point_' || lpad(i::VARCHAR, length(n::VARCHAR)::INT, '0') || '_int:' || printf('%.2f', round(intensity, 2)) || '_prob:' || printf('%.2f', probability) AS name FROM k""",
)
def name_spots(spark, sf_dir):
    return spots.name_spots(fx.spots(spark, sf_dir).withColumn("intensity", F.round("intensity", 2))).select("file", "spot_ix", "name")


@query("p02_spot_positions", cte("sp") + " SELECT file, spot_ix, (z + 1)::INT AS slice, 1 AS channel, t AS frame FROM sp")
def spot_positions(spark, sf_dir):
    return spots.spot_positions(fx.spots(spark, sf_dir)).select("file", "spot_ix", "slice", "channel", "frame")


@query("p03_spot_counts", cte("sp") + ", f AS (SELECT DISTINCT file FROM sp), g AS (SELECT file, count(*) AS n FROM sp WHERE probability > 0.8 GROUP BY file) SELECT file, coalesce(n, 0) AS n_spots, n IS NULL AS is_empty FROM f LEFT JOIN g USING (file)")
def spot_counts(spark, sf_dir):
    all_spots = fx.spots(spark, sf_dir)
    return spots.spot_counts(all_spots.filter("probability > 0.8"), all_spots)


@query("g02_filter_detections", cte("sp") + " SELECT file, spot_ix, probability FROM sp WHERE probability >= 0.5")
def filter_detections(spark, sf_dir):
    return spots.filter_detections(fx.spots(spark, sf_dir), 0.5).select("file", "spot_ix", "probability")


@query(
    "s01_read_spots",
    cte("sp")
    + """, o AS (SELECT *, row_number() OVER (PARTITION BY file ORDER BY spot_ix) - 1 AS line FROM sp)
SELECT file, t, line AS spot_ix, x, y, CASE WHEN line % 3 = 0 THEN 0.0 ELSE z END AS z, round(intensity, 6) AS intensity, probability FROM o WHERE line % 5 <> 4""",
)
def read_spots(spark, sf_dir):
    """Spot files written from the events and read: every third line without z, every fifth with a bad number."""
    s = fx.spots(spark, sf_dir)
    number = [F.col(c).cast("string") for c in ("z", "y", "x", "intensity", "probability")]
    line = F.when(F.col("spot_ix") % 5 == 4, F.lit("bad,2,3,1,1")).when(F.col("spot_ix") % 3 == 0, F.concat_ws(",", *number[1:])).otherwise(F.concat_ws(",", *number))
    files = s.groupBy("file").agg(F.array_sort(F.collect_list(F.struct("spot_ix", line.alias("line")))).alias("rows"))
    texts = files.select("file", F.concat(F.lit("\naxes\n"), F.array_join(F.transform("rows", lambda r: r["line"]), "\n")).alias("value"))
    path = folder(spark, "spots")
    write_files(texts, path)
    return rounded(spot_files.read_spots(spark, path), "intensity")


#: Point and path files hold 512 orders each.
GROUP = 512


@query(
    "s02_read_transformed_points",
    cte("op")
    + f""" SELECT 'points' || (set_id // {GROUP}) || '.txt' AS file, set_id * 100 + vertex_ix AS point_ix, round(x, 5) AS in_x, round(y, 5) AS in_y,
  round(x + 7.5, 5) AS out_x, round(y - 3.25, 5) + 0.0 AS out_y, 7.5::DOUBLE AS d_x, -3.25::DOUBLE AS d_y FROM op""",
)
def read_transformed_points(spark, sf_dir):
    """Files of moved points, written and read; other lines stand between them."""
    op = fx.order_polygons(spark, sf_dir).withColumns({"file": F.concat(F.lit("points"), F.floor(F.col("set_id") / GROUP).cast("string"), F.lit(".txt")), "point_ix": F.col("set_id") * 100 + F.col("vertex_ix")})
    text = "Point\t%d\t; InputIndex = [ 1 2 ]\t; InputPoint = [ %.5f %.5f ]\t; OutputIndexFixed = [ 3 4 ]\t; OutputPoint = [ %.5f %.5f ]\t; Deformation = [ 7.5 -3.25 ]"
    line = F.format_string(text, "point_ix", F.round("x", 5), F.round("y", 5), F.round(F.col("x") + 7.5, 5), F.round(F.col("y") - 3.25, 5))
    files = op.groupBy("file").agg(F.array_sort(F.collect_list(F.struct("point_ix", line.alias("line")))).alias("rows"))
    path = folder(spark, "moved")
    write_files(files.select("file", F.concat(F.lit("a first line\n"), F.array_join(F.transform("rows", lambda r: r["line"]), "\n\n")).alias("value")), path)
    read = points.read_transformed_points(spark, path)
    columns = [F.col(c)[i].alias(f"{name}_{a}") for c, name in (("input", "in"), ("output", "out"), ("deformation", "d")) for i, a in enumerate("xy")]
    return rounded(read.select("file", "point_ix", *columns), "out_y", places=5)


@query(
    "s03_write_points",
    cte("op")
    + f""" SELECT set_id // {GROUP} AS set_id, 'point' || chr(10) || count(*) || chr(10) || string_agg(x::INT || chr(9) || floor(y)::INT, chr(10) ORDER BY set_id * 100 + vertex_ix) || chr(10) AS value
FROM op GROUP BY set_id // {GROUP}""",
)
def write_points(spark, sf_dir):
    """A point file for each set, written and read as text."""
    op = fx.order_polygons(spark, sf_dir)
    path = folder(spark, "points")
    points.write_points(op.select(F.floor(F.col("set_id") / GROUP).alias("set_id"), (F.col("set_id") * 100 + F.col("vertex_ix")).alias("point_ix"), F.array(F.col("x").cast("int"), F.floor("y").cast("int")).alias("pos")), path)
    return spark.read.schema("value string, set_id long").text(path, wholetext=True)


@query(
    "s04_read_svg_paths",
    cte("op")
    + f""", p AS (SELECT set_id, vertex_ix, x, y, set_id % 3 AS kind FROM op),
b AS (SELECT set_id, kind, count(*) AS n, min(vertex_ix) FILTER (true) AS v FROM p GROUP BY ALL),
m AS (SELECT set_id, 0 AS poly_ix, vertex_ix * 100 AS vertex_ix, x, y FROM p
  UNION ALL SELECT p.set_id, 0, b.n * 100 + i, (1 - i / k) ** 2 * x + 2 * (i / k) * (1 - i / k) * (x + 40) + (i / k) ** 2 * (x + 80), (1 - i / k) ** 2 * y + 2 * (i / k) * (1 - i / k) * (y + 60) + (i / k) ** 2 * y
    FROM p JOIN b ON b.set_id = p.set_id AND p.vertex_ix = b.n - 1 AND b.kind = 1, (SELECT k, unnest(range(1, k + 1)) AS i FROM (SELECT ceil(sqrt(120 / (4 * 0.1)))::INT AS k)) r
  UNION ALL SELECT p.set_id, 0, b.n * 100 + i, x + 30 - 30 * cos(pi() * i / k), y - 30 * sin(pi() * i / k)
    FROM p JOIN b ON b.set_id = p.set_id AND p.vertex_ix = b.n - 1 AND b.kind = 2, (SELECT k, unnest(range(1, k + 1)) AS i FROM (SELECT ceil(pi() / (2 * acos(1 - 0.1 / 30)))::INT AS k)) r
  UNION ALL SELECT p.set_id, 1, b.n * 100 + 100 + i, x + [5, 65, 65][i + 1], y + [5, 5, 45][i + 1]
    FROM p JOIN b ON b.set_id = p.set_id AND p.vertex_ix = b.n - 1 AND b.kind = 0, range(3) r(i)),
w AS (SELECT set_id // {GROUP} AS f, set_id, poly_ix, vertex_ix, x, y FROM m),
v AS (SELECT 'paths' || f || '.svg' AS set_id, dense_rank() OVER (PARTITION BY f ORDER BY set_id) - 1 AS roi_ix, 'order' || set_id AS name, poly_ix, vertex_ix, x, y FROM w), """
    + _stretch_sql("v", False).replace("SELECT set_id, roi_ix, poly_ix, vertex_ix, x, y,", "SELECT set_id, roi_ix, name, poly_ix, vertex_ix, x, y,", 1)
    + """,
k AS (SELECT *, unnest(range(ceil((e - len) / 20)::INT, ceil(e / 20)::INT)) AS k FROM q WHERE len > 0)
SELECT set_id, roi_ix, poly_ix, k AS vertex_ix, round((x + (k * 20 - e + len) / len * (x1 - x)) / 2, 6) + 0.0 AS x, round((y + (k * 20 - e + len) / len * (y1 - y)) / 2, 6) + 0.0 AS y, name FROM k WHERE k < floor(total / 20)""",
)
def read_svg_paths(spark, sf_dir):
    """SVG files written from the orders' lines and read back at half their size: by turns with a second sub-path in relative commands, a curve, and an arc of half a circle."""
    op = fx.order_polygons(spark, sf_dir)
    point = F.concat_ws(",", F.col("x").cast("string"), F.col("y").cast("string"))
    paths = op.groupBy("set_id").agg(F.array_sort(F.collect_list(F.struct("vertex_ix", point.alias("p")))).alias("v"))
    kind = F.col("set_id") % 3
    end = F.when(kind == 0, " m 5,5 h 60 v 40").when(kind == 1, " q 40 60 80 0").otherwise(" a30,30 0 0160,0")
    d = F.concat(F.lit("M"), F.array_join(F.transform("v", lambda v: v["p"]), " L "), end)
    element = F.concat(F.lit('<path structure_id="order'), F.col("set_id").cast("string"), F.lit('" d="'), d, F.lit('"/>'))
    texts = paths.groupBy(F.concat(F.lit("paths"), F.floor(F.col("set_id") / GROUP).cast("string"), F.lit(".svg")).alias("file")).agg(F.array_sort(F.collect_list(F.struct("set_id", element.alias("e")))).alias("all"))
    value = F.concat(F.lit('<svg xmlns="http://www.w3.org/2000/svg"><g>\n'), F.array_join(F.transform("all", lambda e: e["e"]), "\n"), F.lit("\n</g></svg>"))
    path = folder(spark, "svg")
    write_files(texts.select("file", value.alias("value")), path)
    return rounded(svg.read_svg_paths(spark, path, 10.0, 2.0).drop("colour"), "x", "y")


@query("s05_list_frames", cte("fr") + " SELECT file, regexp_extract(file, '^(.*?)-t', 1) AS title, regexp_extract(file, '-t(\\d+)', 1)::INT AS t, CASE WHEN file LIKE '%masks.tif' THEN 'mask' ELSE 'input' END AS role, length(file) AS length FROM fr")
def list_frames(spark, sf_dir):
    """Frames and masks written to a folder and listed; empty files among them aren't."""
    files, path = fx.frames(spark, sf_dir), folder(spark, "frames")
    empty = files.select(F.concat(F.lit("empty-"), "file").alias("file"), F.lit("").alias("value"))
    write_files(files.select("file", F.col("file").alias("value")).unionByName(empty), path)
    return frames.list_frames(spark, path).drop("path", "modificationTime")


@query(
    "s06_match_outputs",
    "SELECT 'u' || (user_id % 50) AS title, dayofyear(ts) AS t, 'mask' AS role, CASE WHEN max(event_id) % 5 = 0 THEN 'missing' ELSE 'found' END AS status FROM events GROUP BY 1, 2",
)
def match_frames(spark, sf_dir):
    return frames.match_outputs(frames.catalogue(fx.frames(spark, sf_dir)))


@query("g04_section_index", cte("sec") + " SELECT series, path, regexp_extract(path, '_s(\\d+)', 1)::INT AS section FROM sec")
def section_index(spark, sf_dir):
    return sections.section_index(fx.sections(spark, sf_dir))


NUMBERED = ", n AS (SELECT series, path, regexp_extract(path, '_s(\\d+)', 1)::INT AS section FROM sec)"


@query("g05_order_sections", cte("sec") + NUMBERED + " SELECT *, row_number() OVER (PARTITION BY series ORDER BY section) - 1 AS place FROM n")
def order_sections(spark, sf_dir):
    return sections.order_sections(sections.section_index(fx.sections(spark, sf_dir)))


@query("g06_space_sections", cte("sec") + NUMBERED + " SELECT *, (section - min(section) OVER (PARTITION BY series)) * 2.5::DOUBLE AS depth FROM n")
def space_sections(spark, sf_dir):
    return sections.space_sections(sections.section_index(fx.sections(spark, sf_dir)), 2.5)


@query("g06_missing_sections", cte("sec") + NUMBERED + ", g AS (SELECT series, unnest(range(min(section), max(section) + 1)) AS section FROM n GROUP BY series) SELECT series, section::INT AS section FROM g ANTI JOIN n USING (series, section)")
def missing_sections(spark, sf_dir):
    return sections.missing_sections(sections.section_index(fx.sections(spark, sf_dir)))
