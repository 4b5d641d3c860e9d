"""Label image operators: hand cases and what must always hold."""

import random

import pytest

from vertexloom.operators import raster, roi


def image(spark, *rows, image_id=0):
    return spark.createDataFrame([(image_id, y, x, float(v)) for y, row in enumerate(rows) for x, v in enumerate(row)], "image_id int, y int, x int, label double")


def rings(spark, mode, *rows):
    traced = raster.simplify_rings(raster.trace_rings(raster.boundary_edges(image(spark, *rows)).filter("label = 1")), mode)
    out = {}
    for r in traced.orderBy("ring_id", "vertex_ix").collect():
        out.setdefault(r.ring_id, []).append((r.x, r.y))
    return list(out.values())


def area(ring):
    return sum(a[0] * b[1] - a[1] * b[0] for a, b in zip(ring, ring[1:] + ring[:1], strict=True)) / 2


def test_diagonals(spark):
    assert sorted(map(len, rings(spark, "keep_all", "10", "01"))) == [4, 4]
    (one,) = rings(spark, "keep_all", "01", "10")
    assert len(one) == 8 and one.count((1, 1)) == 2


def test_hole(spark):
    made = rings(spark, "keep_all", "111", "101", "111")
    assert sorted((len(r), area(r)) for r in made) == [(4, 1), (12, -9)]
    wide = rings(spark, "all", "11111", "10001", "11111")
    assert sorted((len(r), area(r)) for r in wide) == [(4, -15), (4, 3)]


@pytest.mark.parametrize("gathered", [0, 60])
def test_rings_of_large_objects_are_chained_by_joins(spark, gathered):
    """However many edges may be gathered, the rings are the same."""
    rnd = random.Random(4)
    labels = image(spark, *[[rnd.randrange(3) if x < 9 else 7 for x in range(24)] for _ in range(16)]).unionByName(image(spark, "010", "101", "010", image_id=1))
    edges = raster.boundary_edges(labels)
    rows = [sorted(map(tuple, raster.trace_rings(edges, n).select("image_id", "label", "ring_id", "vertex_ix", "x", "y").collect())) for n in (gathered, raster.GATHERED)]
    assert rows[0] == rows[1] and len(rows[0]) == edges.count()


@pytest.mark.parametrize("seed", range(3))
def test_round_trip(spark, seed):
    """Outlines that keep every vertex give the labels back when they are burnt in again."""
    rnd = random.Random(seed)
    labels = image(spark, *[[rnd.randrange(3) for _ in range(9)] for _ in range(7)])
    traced = raster.trace_rings(raster.boundary_edges(labels))
    by_label = {}
    for r in traced.orderBy("ring_id", "vertex_ix").collect():
        by_label.setdefault(r.label, {}).setdefault(r.ring_id, []).append((r.x, r.y))
    counts = {r.label: r["count"] for r in labels.groupBy("label").count().collect()}
    assert {k: -sum(map(area, v.values())) for k, v in by_label.items()} == counts
    vertices = traced.selectExpr("image_id as set_id", "cast(label as int) as roi_ix", "ring_id as poly_ix", "vertex_ix", "cast(x as double) as x", "cast(y as double) as y")
    burnt = {(r.y, r.x): (r.label - 1) / 2 for r in roi.rasterize_rois(vertices).collect()}
    present = sorted(counts)
    assert burnt == {(r.y, r.x): present.index(r.label) for r in labels.collect()}


def test_vectorize_shares_borders(spark):
    made = raster.vectorize_labels(image(spark, "1122", "1122", "1222"))
    points = {}
    for r in made.collect():
        points.setdefault(r.name, set()).add((r.x, r.y))
    assert set(points) == {"1", "2"}
    inner = {p for p in points["1"] if 0 < p[0] < 4 and 0 < p[1] < 3}
    assert inner and inner <= points["2"]


def test_one_pixel_and_empty(spark):
    assert raster.label_stats(image(spark, "5")).first()[1:] == (5.0, 1, 0, 0, 0, 0, 0.0, 0.0, 4)
    empty = image(spark, "1").filter("label > 9")
    assert raster.vectorize_labels(empty).count() == 0
    assert [r.label for r in raster.label_mask(image(spark, "123"), 2).collect()] == [2.0]
    with pytest.raises(ValueError):
        raster.simplify_rings(empty, "movable")


def brute_rings(rows):
    """Rings of each label by walking its unit edges: (label, the turns in order from the smallest start)."""
    h, w = len(rows), len(rows[0])
    at = lambda y, x: ("pixel", rows[y][x]) if 0 <= y < h and 0 <= x < w else None
    out = set()
    for label in {v for row in rows for v in row}:
        edges = {}
        for y in range(h):
            for x in range(w):
                if rows[y][x] == label:
                    for side, (dy, dx), a, b in (("upper", (-1, 0), (x + 1, y), (x, y)), ("left", (0, -1), (x, y), (x, y + 1)), ("lower", (1, 0), (x, y + 1), (x + 1, y + 1)), ("right", (0, 1), (x + 1, y + 1), (x + 1, y))):
                        if at(y + dy, x + dx) != ("pixel", label):
                            edges.setdefault(a, []).append((side, b))
        left = {(a, side): b for a, many in edges.items() for side, b in many}
        while left:
            start = min(left, key=lambda k: (k[0][1], k[0][0], raster.SIDES.index(k[1])))
            ring, (a, side) = [], start
            while (a, side) in left:
                ring.append(a)
                b = left.pop((a, side))
                nexts = [s for s, _ in edges[b] if (b, s) in left or (b, s) == start]
                side = raster.TURNS[side] if len(edges[b]) > 1 else (nexts or [None])[0]
                a = b
            n = len(ring)
            turns = tuple(p for i, p in enumerate(ring) if (p[0] - ring[i - 1][0]) * (ring[(i + 1) % n][1] - p[1]) != (p[1] - ring[i - 1][1]) * (ring[(i + 1) % n][0] - p[0]))
            out.add((label, turns))
    return out


def as_rings(traced):
    out = {}
    for r in traced.orderBy("vertex_ix").collect():
        out.setdefault((r.label, r.ring_id), []).append((r.x, r.y))
    return {(label, tuple(ring)) for (label, _), ring in out.items()}


@pytest.mark.parametrize("gathered", [0, 40, raster.GATHERED])
def test_segments_and_null_labels(spark, gathered):
    """Pixels without a label are an object: at the border, on diagonals, all of an image."""
    rnd = random.Random(9)
    made = [[[None if i == j else 1.0 for i in range(4)] for j in range(4)], [[None, None], [None, None]], [[rnd.choice([None, 0.0, 1.0]) for _ in range(11)] for _ in range(8)]]
    for rows in made:
        labels = spark.createDataFrame([(0, y, x, v) for y, row in enumerate(rows) for x, v in enumerate(row)], "image_id int, y int, x int, label double")
        want = brute_rings(rows)
        assert as_rings(raster.trace_rings(raster.boundary_segments(labels), gathered)) == want
        assert as_rings(raster.simplify_rings(raster.trace_rings(raster.boundary_edges(labels), gathered), "all")) == want
        assert sum(r.area for r in raster.label_stats(labels).collect()) == len(rows) * len(rows[0])
        names = {r.name for r in raster.vectorize_labels(labels).collect()}
        assert names == {None if v is None else str(int(v)) for row in rows for v in row}


def test_open_edges_raise(spark):
    edges = raster.boundary_edges(image(spark, "11", "11")).filter("side <> 'left'")
    for gathered in (0, raster.GATHERED):
        with pytest.raises(Exception, match="don't close"):
            raster.trace_rings(edges, gathered).count()


def test_rows_grow_with_turns(spark):
    """A large image of two discs of squares and a background: what is traced are the turns, not the pixels of the borders."""
    wide = 2048
    labels = spark.range(wide * wide).selectExpr("0 as image_id", f"cast(id div {wide} as int) as y", f"cast(id % {wide} as int) as x").selectExpr("*", "case when x between 200 and 899 and y between 100 and 1599 then 1.0D when x between 1200 and 1900 and y between 900 and 1000 then 2.0D else 0.0D end as label")
    pieces = raster.boundary_segments(labels).cache()
    assert pieces.count() == 4 * 5
    assert sorted((r.label, r["count"]) for r in raster.trace_rings(pieces).groupBy("label").count().collect()) == [(0.0, 12), (1.0, 4), (2.0, 4)]
