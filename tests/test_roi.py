"""Region operators on cases worked by hand."""

import math
import random

import pytest
from pyspark.sql import functions as F

from vertexloom.operators import roi

SCHEMA = "set_id int, roi_ix int, poly_ix int, vertex_ix int, x double, y double"


def polygon(spark, *points, roi_ix=0, poly_ix=0):
    return spark.createDataFrame([(0, roi_ix, poly_ix, i, float(x), float(y)) for i, (x, y) in enumerate(points)], SCHEMA)


def places(df):
    return [(round(r.x, 9), round(r.y, 9)) for r in df.orderBy("vertex_ix").collect()]


SQUARE = [(0, 0), (4, 0), (4, 4), (0, 4)]


def test_resample(spark):
    square = polygon(spark, *SQUARE)
    assert places(roi.resample_polygon(square, 4)) == [(4, 0), (4, 4), (0, 4), (0, 0)]
    assert places(roi.resample_polygon(square, 100)) == [(0, 0)]
    assert places(roi.resample_polygon(polygon(spark, (1, 1)), 1)) == []


def test_sample_path(spark):
    assert places(roi.sample_path(polygon(spark, (0, 0), (10, 0)), 3)) == [(0, 0), (3, 0), (6, 0)]


def test_area(spark):
    assert roi.signed_area(polygon(spark, *SQUARE)).first().area == 16
    assert roi.signed_area(polygon(spark, *SQUARE[::-1])).first().area == -16
    two = roi.orientation(polygon(spark, (0, 0), (1, 1))).first()
    assert (two.area, two.orientation) == (0, "positive")


def test_membership_of_a_square_with_a_hole(spark):
    hole = [(1, 1), (1, 3), (3, 3), (3, 1)]
    both = polygon(spark, *SQUARE).unionByName(polygon(spark, *hole, poly_ix=1))
    points = spark.createDataFrame([(0, 0, 0.5, 0.5), (0, 1, 2.0, 2.0), (0, 2, 9.0, 9.0)], "set_id int, point_ix int, x double, y double")
    for band in (1.0, 16.0):
        assert [r.point_ix for r in roi.region_membership(points, both, band).collect()] == [0]
    assert [r.point_ix for r in roi.region_membership(points, polygon(spark, *hole)).collect()] == [1]


def test_membership_in_a_large_band_is_dealt(spark, monkeypatch):
    """One set whose points and edges fill few bands gives the same pairs in parts."""
    rows = [(0, i, 0, k, 3.0 * (i % 40) + x, 5.0 * (i // 40) + y) for i in range(200) for k, (x, y) in enumerate([(0, 0), (4, 0), (4, 4), (0, 4)])]
    vertices = spark.createDataFrame(rows, SCHEMA)
    points = spark.range(3000).selectExpr("0 as set_id", "cast(id as int) as point_ix", "(id * 37 % 1200) / 10.0 + 0.05 as x", "(id * 11 % 250) / 10.0 + 0.05 as y")
    whole = sorted(map(tuple, roi.region_membership(points, vertices).collect()))
    monkeypatch.setattr(roi, "PAIRS_TOGETHER", 10_000)
    assert sorted(map(tuple, roi.region_membership(points, vertices).collect())) == whole and len(whole) > 1000


def crossings(ring, px, py):
    """Edges that the ray to the right of a point meets."""
    hits = 0
    for (x0, y0), (x1, y1) in zip(ring, ring[1:] + ring[:1], strict=True):
        if (y0 > py) != (y1 > py) and px < (x1 - x0) * (py - y0) / (y1 - y0) + x0:
            hits += 1
    return hits


def ring_area(ring):
    return sum(a[0] * b[1] - a[1] * b[0] for a, b in zip(ring, ring[1:] + ring[:1], strict=True)) / 2


def regions_at(regions, px, py):
    """Regions (lists of rings) that a point lies in, by all edges."""
    out = []
    for k, rings in enumerate(regions):
        held = [ring_area(r) >= 0 for r in rings if crossings(r, px, py) % 2]
        if any(held) != (not all(held)):
            out.append(k)
    return out


def made_regions(rng, n, whole):
    """Random polygons, crossing themselves, with level edges, repeated vertices and vertices on cell borders."""
    number = (lambda: float(rng.randint(-12, 12))) if whole else (lambda: rng.uniform(-12, 12))
    return [[[(number(), number()) for _ in range(rng.randint(1, 9))] for _ in range(rng.randint(1, 3))] for _ in range(n)]


def region_table(spark, regions):
    return spark.createDataFrame([(0, k, j, i, x, y) for k, rings in enumerate(regions) for j, ring in enumerate(rings) for i, (x, y) in enumerate(ring)], SCHEMA)


@pytest.mark.parametrize(("whole", "cell"), [(True, 1.0), (True, 4.0), (True, 3.7), (True, None), (False, 0.5), (False, None), (False, 50.0)])
def test_membership_against_all_edges(spark, whole, cell):
    rng = random.Random(6)
    regions = made_regions(rng, 12, whole)
    places = [(x / 2, y / 2) for x in range(-26, 27) for y in range(-26, 27)] if whole else [(rng.uniform(-13, 13), rng.uniform(-13, 13)) for _ in range(2500)]
    places += [p for rings in regions for ring in rings for p in ring]
    points = spark.createDataFrame([(0, i, float(x), float(y)) for i, (x, y) in enumerate(places)], "set_id int, point_ix int, x double, y double")
    got = sorted(map(tuple, roi.region_membership(points, region_table(spark, regions), cell).collect()))
    assert got == [(0, i, k) for i, (x, y) in enumerate(places) for k in regions_at(regions, x, y)]


def test_cells_spare_comparisons(spark):
    """A disc of many edges: of points all over it only those in the cells of its rim are compared, with few edges each."""
    n = 4000
    ring = [(1000 * math.cos(2 * math.pi * k / n), 1000 * math.sin(2 * math.pi * k / n)) for k in range(n)]
    points = spark.range(10_000).selectExpr("0 as set_id", "cast(id as int) as point_ix", "(id % 100) * 20.0 - 990 as x", "(id div 100) * 20.0 - 990 as y")
    vertices = polygon(spark, *ring)
    found = {r.point_ix for r in roi.region_membership(points, vertices).collect()}
    assert found == {i for i in range(10_000) if crossings(ring, (i % 100) * 20.0 - 990, (i // 100) * 20.0 - 990) % 2}
    cell = 8.0
    cells = roi.cut_cells(roi.signed_edges(vertices), cell)
    at = points.selectExpr("set_id", "point_ix", "x as px", "y as py", f"floor(y / {cell}) as row", f"floor(x / {cell}) as col")
    pairs = roi.cell_pairs(at, cells, cell).count()
    edges_of_a_row = 2 * n * 20 / 2000  # what bands of a cell's height would compare with at least
    assert 0 < pairs < 10_000 and pairs < 10_000 * edges_of_a_row / 50


def test_blocks_of_runs(spark):
    runs = [(a, b) for a in (-70, -9, -1, 0, 1, 7, 8, 60) for b in (-9, -1, 0, 6, 7, 8, 63, 64, 700, 5000) if a <= b]
    rows = spark.createDataFrame(runs, "a long, b long").withColumn("k", F.explode(roi.run_blocks(F.col("a"), F.col("b")))).select("a", "b", "k.*").collect()
    covered = {run: [] for run in runs}
    for r in rows:
        covered[r.a, r.b].extend(range(r.block * roi.BLOCK**r.level, (r.block + 1) * roi.BLOCK**r.level))
    assert all(sorted(v) == list(range(a, b + 1)) for (a, b), v in covered.items())
    assert len(rows) < 40 * len(runs)


@pytest.mark.parametrize("whole", [True, False])
def test_painting_against_all_pixels(spark, whole):
    """Regions above each other, with holes, partly outside the image."""
    regions = made_regions(random.Random(8), 25, whole)
    got = {(r.x, r.y): r.label for r in roi.rasterize_rois(region_table(spark, regions)).collect()}
    want = {}
    for x in range(14):
        for y in range(14):
            held = regions_at(regions, x + 0.5, y + 0.5)
            if held:
                want[x, y] = 2 * max(held) + 1
    assert got == want


def test_painted_rows(spark):
    """Wide squares above each other: rows on the way grow with edges and lines, not with pixels."""
    side, n = 2000, 6
    vertices = region_table(spark, [[[(k, k), (side - k, k), (side - k, side - k), (k, side - k)]] for k in map(float, range(n))])
    runs = roi.region_runs(vertices)
    assert runs.count() <= n * side
    top = roi.top_runs(runs)
    assert top.count() <= 2 * n * side
    assert top.selectExpr("sum(b - a + 1)").first()[0] == side * side


def test_rasterize(spark):
    pixels = roi.rasterize_rois(polygon(spark, (0, 0), (2, 0), (2, 1), (0, 1)).unionByName(polygon(spark, (1, 0), (3, 0), (3, 1), (1, 1), roi_ix=1)))
    assert {(r.x, r.y): r.label for r in pixels.collect()} == {(0, 0): 1, (1, 0): 3, (2, 0): 3}
    assert {r.label for r in roi.rasterize_rois(polygon(spark, *SQUARE), label_step=1, size=(2, 2)).collect()} == {1}


def test_rebind_needs_all_points(spark):
    two = polygon(spark, (0, 0), (1, 0)).unionByName(polygon(spark, (5, 5), (6, 6), roi_ix=1))
    points = spark.createDataFrame([(0, i, 9.0, 9.0) for i in range(3)], "set_id int, point_ix int, x double, y double")
    rows = {(r.roi_ix, r.vertex_ix): (r.x, r.rebound) for r in roi.rebind_points(two, points).collect()}
    assert rows == {(0, 0): (9.0, True), (0, 1): (9.0, True), (1, 0): (5.0, False), (1, 1): (6.0, False)}


def test_names(spark):
    rois = spark.createDataFrame([(0, i, n) for i, n in enumerate("AABA")], "set_id int, roi_ix int, name string")
    assert [r.unique_name for r in roi.unique_roi_names(rois).orderBy("roi_ix").collect()] == ["A", "A-1", "B", "A-2"]
    clash = spark.createDataFrame([(0, i, n) for i, n in enumerate(["A", "A", "A-1"])], "set_id int, roi_ix int, name string")
    assert [r.collides for r in roi.unique_roi_names(clash).orderBy("roi_ix").collect()] == [False, True, True]


def test_smooth(spark):
    assert places(roi.smooth_open(polygon(spark, (0, 0), (1, 2), (2, 0)))) == [(0, 0), (1, 1), (2, 0)]
    assert places(roi.smooth_open(polygon(spark, (0, 0), (1, 2), (0, 0)))) == [(0, 0), (1, 2), (0, 0)]
    corners = spark.createDataFrame([(0, 0, 0, True), (0, 4, 4, False)], "set_id int, x int, y int, movable boolean")
    assert places(roi.smooth_constrained(polygon(spark, *SQUARE), corners)) == [(1, 1), (4, 0), (4, 4), (0, 4)]


def test_map_points_by_function(spark):
    assert places(roi.map_points(polygon(spark, *SQUARE), lambda x, y: (x + 1, -y))) == [(1, 0), (5, 0), (5, -4), (1, -4)]


def test_subpaths(spark):
    rows = [("p", 0, "M", 1.0, 1.0), ("p", 1, "L", 3.0, 1.0), ("p", 2, "L", 3.0, 4.0), ("p", 3, "M", 7.0, 7.0), ("p", 4, "M", 0.0, 0.0), ("p", 5, "L", 1.0, 0.0), ("p", 6, "L", 1.0, 1.0), ("p", 7, "L", 0.0, 1.0), ("p", 8, "M", 5.0, 5.0), ("p", 9, "Q", 6.0, 6.0), ("p", 10, "M", 8.0, 8.0), ("p", 11, "L", 9.0, 9.0)]
    made = roi.split_subpaths(spark.createDataFrame(rows, "path_id string, cmd_ix int, cmd string, x double, y double"), (10.0, 0.0))
    kinds = {r.poly_ix: r.kind for r in made.collect()}
    assert kinds == {0: "rectangle", 2: "polygon"}
    assert places(made.filter("poly_ix = 0")) == [(11, 1), (13, 1), (13, 4), (11, 4)]


def test_plain_shapes(spark):
    rows = [(0, "rectangle", [1.9, -1.9, 4.2, 2.8]), (1, "line", [0.5, 0.5, 9.9, -9.9]), (2, "polygon", [0.9, 1.1, 5.0, 5.5, 2.2]), (3, "ellipse", [10.7, 20.2, 40.9, 20.1]), (4, "ellipse", [1.0, 1.0, 0.9, 0.9]), (5, "star", [1.0] * 4), (6, "line", [1.0])]
    made = roi.plain_shapes(spark.createDataFrame(rows, "path_id int, kind string, a array<double>"))
    of = lambda k: places(made.filter(f"path_id = {k}"))
    assert of(0) == [(1, -1), (5, -1), (5, 1), (1, 1)]
    assert of(1) == [(0, 0), (9, -9)] and of(2) == [(0, 1), (5, 5)] and of(5) == of(6) == []
    round_ = of(3)
    assert round_[0] == (50, 30) and all(((x - 30) / 20) ** 2 + ((y - 30) / 10) ** 2 == pytest.approx(1) for x, y in round_)
    widest = max(20 - math.hypot((a[0] + b[0]) / 2 - 30, ((a[1] + b[1]) / 2 - 30) * 2) for a, b in zip(round_, round_[1:] + round_[:1], strict=True))
    assert widest < 0.1 + 1e-6 and len(round_) < 40
    assert of(4) == [(1, 1)] * 8


def test_nest_and_explode(spark):
    vertices = polygon(spark, *SQUARE).unionByName(polygon(spark, (0, 0), (1, 1), poly_ix=1))
    back = roi.explode_vertices(roi.nest_vertices(vertices))
    assert sorted(map(tuple, back.drop("point_ix").collect())) == sorted(map(tuple, vertices.collect()))
    assert sorted(r.point_ix for r in back.collect()) == list(range(6))


@pytest.mark.parametrize("op", [roi.signed_area, roi.vertex_counts, roi.bounding_boxes, roi.canvas_size, roi.smooth_open, roi.rasterize_rois, lambda v: roi.resample_polygon(v, 1.0)])
def test_empty(spark, op):
    assert op(spark.createDataFrame([], SCHEMA)).count() == 0


def test_canvas(spark):
    assert roi.canvas_size(polygon(spark, (-5, -5), (130.5, 20))).first()[1:] == (131, 100)
    assert roi.bounding_boxes(polygon(spark, (-0.5, 0.2), (1.5, 1))).first()[2:] == (-1, 0, 3, 1)
    assert roi.roi_names_from_labels(spark.createDataFrame([(1.2,), (1.7,)], "label double")).select(F.collect_set("name")).first()[0] == ["1"]


def test_membership_broadcasts_no_points(spark, tmp_path):
    """Spark takes the rows that a small table is exploded to for as small as the table."""
    spark.range(300).selectExpr("id set_id").write.parquet(str(tmp_path / "sets"))
    points = spark.read.parquet(str(tmp_path / "sets")).selectExpr("set_id", "explode(sequence(0, 4)) point_ix").selectExpr("set_id", "point_ix", "2.0 * point_ix - 1 x", "1.5D y")
    vertices = spark.range(300).selectExpr("id set_id", "0 roi_ix", "0 poly_ix", "explode(array((0, 0D, 0D), (1, 6D, 0D), (2, 6D, 6D), (3, 0D, 6D))) v").selectExpr("set_id", "roi_ix", "poly_ix", "v.col1 vertex_ix", "v.col2 x", "v.col3 y")
    for cell in (0.5, 4.0):
        inside = roi.region_membership(points.withColumn("x", points.x.cast("double")), vertices, cell)
        assert "BroadcastExchange" not in inside._jdf.queryExecution().executedPlan().toString()
        assert sorted((r.set_id, r.point_ix) for r in inside.collect()) == [(s, k) for s in range(300) for k in (1, 2, 3)]


def test_plain_shapes_of_lines_that_are_equal_as_whole_numbers(spark, tmp_path):
    from oracle import spark_rows, sql_rows

    from vertexloom.plans import registry
    from vertexloom.plans import roi as _  # noqa: F401  registers the query

    rows = [(1, line, 7.0, 1000.0 * k + more, part, 3) for line in range(1, 5) for k in (5, 9) for more in (0.0, 420.0) for part in (17, 107)]
    table = spark.createDataFrame(rows, "l_orderkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_partkey long, l_suppkey long")
    table.write.parquet(str(tmp_path / "lineitem.parquet"))
    name = "r08_plain_shapes"
    sql = registry.oracle_sql()[name].replace("FROM lineitem", f"FROM read_parquet('{tmp_path}/lineitem.parquet/*.parquet')")
    assert spark_rows(registry.queries()[name](spark, str(tmp_path))) == sql_rows(sql, str(tmp_path / "none"))
