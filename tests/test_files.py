"""Readers and writers on files of their own, and what works on rows of files."""

import math
import random
import re

import pytest
from pyspark.sql import functions as F

from vertexloom.operators import frames, sections, spots, transform
from vertexloom.sources.frames import list_frames, match_outputs
from vertexloom.sources.points import read_transformed_points, write_points
from vertexloom.sources.spots import read_spots
from vertexloom.sources.svg import SPAN, flatten_paths, read_svg_elements, read_svg_paths
from vertexloom.sources.tables import read_chain_settings, read_chains, read_rois, write_chains, write_rois
from vertexloom.streaming.spots import stream_spots


def put(folder, **files):
    for name, text in files.items():
        (folder / name.replace("__", "-").replace("_dot_", ".")).write_text(text)
    return str(folder)


def test_spots(spark, tmp_path):
    path = put(tmp_path, **{"a-t2b-t10.csv": "\nhead\n1,2,3,0.4\n0,1,2,3,0.5,,\nbad,2,3,1,1\n1,2\n", "plain.csv": "only a head\n", "notes.txt": "0,1\n1,2,3,4"})
    rows = read_spots(spark, path).orderBy("spot_ix").collect()
    assert [(r.file, r.t, r.x, r.y, r.z, r.intensity, r.probability) for r in rows] == [("a-t2b-t10.csv", 2, 2.0, 1.0, 0.0, 3.0, 0.4), ("a-t2b-t10.csv", 2, 2.0, 1.0, 0.0, 3.0, 0.5)]
    named = [r.name for r in spots.name_spots(read_spots(spark, path)).orderBy("spot_ix").collect()]
    assert named == ["Point_1_int:3.00_prob:0.40", "Point_2_int:3.00_prob:0.50"]
    files = spark.createDataFrame([("a-t2b-t10.csv",), ("plain.csv",)], "file string")
    assert sorted(map(tuple, spots.spot_counts(read_spots(spark, path), files).collect())) == [("a-t2b-t10.csv", 2, False), ("plain.csv", 0, True)]
    query = stream_spots(spark, path).writeStream.format("memory").queryName("arrived").start()
    query.processAllAvailable()
    query.stop()
    assert spark.table("arrived").count() == 2


def test_points(spark, tmp_path):
    line = "Point\t3\t; InputIndex = [ 1 2 ]\t; InputPoint = [ 1.5 2.0 ]\t; OutputIndexFixed = [ 2 2 ]\t; OutputPoint = [ 2.5 -1e-1 ]\t; Deformation = [ 1.0 0.0 ]\nnoise\n"
    (tmp_path / "in").mkdir()
    row = read_transformed_points(spark, put(tmp_path / "in", **{"outputpoints.txt": line})).first()
    assert (row.point_ix, row.input, row.output, row.deformation) == (3, [1.5, 2.0], [2.5, -0.1], [1.0, 0.0])
    points = spark.createDataFrame([("s", 1, [3.0, 4.0]), ("s", 0, [1.0, 2.5])], "set_id string, point_ix int, pos array<double>")
    write_points(points, str(tmp_path / "out"))
    assert spark.read.text(str(tmp_path / "out"), wholetext=True).first().value == "point\n2\n1.0\t2.5\n3.0\t4.0\n"


NUMBERS = {"M": 2, "L": 2, "H": 1, "V": 1, "C": 6, "S": 4, "Q": 4, "T": 2, "A": 7, "Z": 0}
NUMBER = r"[-+]?(?:\d+\.?\d*|\.\d+)(?:[eE][-+]?\d+)?"


def exact_path(d):
    """Pieces (sub-path, points at 200 places after the start, or one for a line) of a path's text, one command after another."""
    out, x, y, sx, sy, last, control, part = [], 0.0, 0.0, 0.0, 0.0, "", (0.0, 0.0), -1
    for letter, rest in re.findall(r"([MmLlHhVvCcSsQqTtAaZz])([^MmLlHhVvCcSsQqTtAaZz]*)", d):
        command, n = letter.upper(), NUMBERS[letter.upper()]
        if command == "A":
            rest = re.sub(rf"({NUMBER})[\s,]*({NUMBER})[\s,]*({NUMBER})[\s,]*([01])[\s,]*([01])[\s,]*(?={NUMBER}[\s,]*{NUMBER})", r"\1 \2 \3 \4 \5 ", rest)
        numbers = [float(v) for v in re.findall(NUMBER, rest)]
        for k in range(len(numbers) // n if n else 1):
            g, (bx, by) = numbers[k * n : k * n + n], (x, y) if letter.islower() else (0.0, 0.0)
            start, points = (x, y), None
            if command == "Z":
                end = (sx, sy)
            elif command in "HV":
                end = (bx + g[0], y) if command == "H" else (x, by + g[0])
            else:
                end = (bx + g[-2], by + g[-1])
            if command == "M" and k == 0:
                part, sx, sy = part + 1, *end
            if command in "CSQT":
                given = [(bx + g[i], by + g[i + 1]) for i in range(0, len(g) - 2, 2)]
                if command in "ST":
                    given.insert(0, (2 * x - control[0], 2 * y - control[1]) if last in ("CS" if command == "S" else "QT") and last else start)
                control, ends = given[-1], [start, *given, end]
                m = len(ends) - 1
                points = [tuple(sum(math.comb(m, j) * u**j * (1 - u) ** (m - j) * p[c] for j, p in enumerate(ends)) for c in (0, 1)) for u in (i / 200 for i in range(1, 201))]
            elif command == "A" and g[0] and g[1] and start != end:
                points = arc_places(start, *g[:5], end)
            if command != "Z" or start != end:
                out.append((part, points or [end], points is not None))
            (x, y), last = end, command
    return out


def arc_places(start, rx, ry, turned, large, sweep, end):
    """200 places on an elliptical arc, by trying both centres."""
    t = math.radians(turned)
    spin = lambda p, s: (p[0] * math.cos(s) - p[1] * math.sin(s), p[0] * math.sin(s) + p[1] * math.cos(s))
    rx, ry = abs(rx), abs(ry)
    a, b = ((q[0] / rx, q[1] / ry) for q in (spin(start, -t), spin(end, -t)))
    half = math.dist(a, b) / 2
    grown = max(half, 1.0)
    a, b = ((p[0] / grown, p[1] / grown) for p in (a, b))
    mid, h = ((a[0] + b[0]) / 2, (a[1] + b[1]) / 2), math.sqrt(max(0.0, 1 - (half / grown) ** 2))
    across = ((a[1] - b[1]) / math.dist(a, b), (b[0] - a[0]) / math.dist(a, b))
    for side in (h, -h):
        c = (mid[0] + side * across[0], mid[1] + side * across[1])
        begin, stop = math.atan2(a[1] - c[1], a[0] - c[0]), math.atan2(b[1] - c[1], b[0] - c[0])
        turn = (stop - begin) % (2 * math.pi) if sweep else -((begin - stop) % (2 * math.pi))
        if (abs(turn) > math.pi) == bool(large) or h == 0:
            break
    return [spin(((c[0] + math.cos(begin + turn * i / 200)) * rx * grown, (c[1] + math.sin(begin + turn * i / 200)) * ry * grown), t) for i in range(1, 201)]


def distance_to(p, a, b):
    dx, dy = b[0] - a[0], b[1] - a[1]
    u = max(0.0, min(1.0, ((p[0] - a[0]) * dx + (p[1] - a[1]) * dy) / (dx * dx + dy * dy))) if (dx, dy) != (0, 0) else 0.0
    return math.dist(p, (a[0] + u * dx, a[1] + u * dy))


def flat_paths(spark, texts, tolerance=0.1):
    rows = flatten_paths(spark.createDataFrame(list(enumerate(texts)), "id int, d string"), ["id"], tolerance).orderBy("id", "vertex_ix").collect()
    out = {i: [] for i in range(len(texts))}
    for r in rows:
        out[r.id].append((r.vertex_ix // SPAN, r.poly_ix, (r.x, r.y)))
    return out


PATHS = [
    "M0 0 H2 V2 Z m5,5 l1,0", "m1 1 h 30 v -20 z", "M1 2 3 4 5 6 z l1 1 m2 2 3 3 z m1 0 h4", "m1,1 m2,2 l1 0 z m1 1 z m1 1 v3 h-2 V9 h1", "M0 0 Q1 2 2 0 T4 0 C4 1 5 1 5 0 S6 -1 6 0", "M0 0 T4 5 t3 3 q10 10 5 0 t7 7 t1 -9 T3 3 L9 9 T1 1", "M5 5 s10 20 30 -4 S9 9 0 0 c1 2 30 4 50 6 s7 8 9 9 Q1 1 2 2 S4 4 30 5",
    "M0 0 a5,5 0 0110,0 A5 5 0 0 1 0 0", "M0 0 A5 5 0 0 0 10 0", "M0 0 A 4 2 90 1 0 0 8", "M0 0 A0 5 0 0 1 3 4 A5 5 0 0 1 3 4", "M0 0 A1 1 0 0 1 10 0", "m3 3 a30 10 25 1 1 20 -5 a30 10 25 1 0 -20 5 30 10 -40 0 1 9 9", "L5 5 H9", "", None, "M1e1-5.5.5 L-1-2", "Z M3 3 Z L4 4 M9 9 Z Z l1 1",
]


def test_paths_keep_within_the_tolerance(spark):
    """Against one command after another: lines are the same, and no place of a curve is further from its pieces than the tolerance."""
    rng = random.Random(12)
    commands = "MmLlHhVvCcSsQqTtAaZz"

    def numbers(letter):
        if letter in "Aa":
            return f"{rng.randint(0, 40)} {rng.randint(1, 40)} {rng.randint(-90, 90)} {rng.randint(0, 1)} {rng.randint(0, 1)} {rng.randint(-50, 50)} {rng.randint(-50, 50)}"
        return " ".join(str(rng.randint(-50, 50)) for _ in range(NUMBERS[letter.upper()] * rng.randint(1, 3)))

    texts = PATHS + ["M1 1 " + " ".join(letter + numbers(letter) for letter in rng.choices(commands, k=rng.randint(1, 25))) for _ in range(60)]
    made = flat_paths(spark, texts)
    for i, text in enumerate(texts):
        by_segment = {}
        for segment, part, p in made[i]:
            by_segment.setdefault((segment, part), []).append(p)
        want = exact_path(text or "")
        got = list(by_segment.items())
        assert [part for (_, part), _ in got] == [part for part, *_ in want], text
        start = (0.0, 0.0)
        for (_, pieces), (_, places, curved) in zip(got, want, strict=True):
            assert pieces[-1] == pytest.approx(places[-1], abs=1e-7), text
            line = [start, *pieces]
            if curved:
                assert max(min(distance_to(p, a, b) for a, b in zip(line, line[1:], strict=False)) for p in places) < 0.1 + 1e-6, text
            else:
                assert len(pieces) == 1
            start = pieces[-1]


def test_large_curves(spark):
    """A curve of 10,000 units has as many pieces as it needs, and a small one few."""
    texts = ["M0 0 C0 10000 10000 10000 10000 0", "M0 0 Q1 2 2 0", "M0 0 A5000 5000 0 0 1 10000 0"]
    made = flat_paths(spark, texts, 0.5)
    assert 90 < len(made[0]) < 200 and len(made[1]) == 3 and 90 < len(made[2]) < 200
    for i in (0, 2):
        line = [p for *_, p in made[i]]
        for _, places, curved in exact_path(texts[i])[1:]:
            assert curved and max(min(distance_to(p, a, b) for a, b in zip(line, line[1:], strict=False)) for p in places) < 0.5


def test_svg(spark, tmp_path):
    svg = '<svg><g><path structure_id="7" d="M0,0 L40,0"/><path structure_id="8" d="m 1 1 h 30 v -20 z"/></g></svg>'
    rows = read_svg_paths(spark, put(tmp_path, **{"a.svg": svg}), 10.0, 2.0).orderBy("name", "vertex_ix").collect()
    assert [(r.x, r.y) for r in rows if r.name == "7"] == [(0.0, 0.0), (10.0, 0.0)]
    assert rows[0].colour == [150, 150, 150]
    assert sorted({(r.roi_ix, r.name) for r in rows}) == [(0, "7"), (1, "8")]


def test_svg_files_of_one_name_and_broken_ones(spark, tmp_path):
    for name, d in (("a", "M0 0 L40 0"), ("b", "M1000 0 L1040 0"), ("a/b c%20+é", "M5 5 L45 5")):
        (tmp_path / name).mkdir(exist_ok=True)
        (tmp_path / name / "x.svg").write_text(f'<svg><path structure_id="7" d="{d}"/></svg>')
    (tmp_path / "cut.svg").write_text('<svg><path d="M0 0')
    (tmp_path / "bytes.svg").write_bytes(b'<?xml version="1.0" encoding="utf-8"?><svg><path d="\xff"/></svg>')
    (tmp_path / "empty.svg").write_text("")
    rows = read_svg_paths(spark, str(tmp_path), 10.0).collect()
    assert {s: sorted(r.x for r in rows if r.set_id == s) for s in {r.set_id for r in rows}} == {"a/x.svg": [0.0, 10.0, 20.0, 30.0], "b/x.svg": [1000.0, 1010.0, 1020.0, 1030.0], "a/b c%20+é/x.svg": [5.0, 15.0, 25.0, 35.0]}
    errors = {r.set_id: r.error for r in read_svg_elements(spark, str(tmp_path)).filter("error is not null").collect()}
    assert {"cut.svg", "bytes.svg"} <= set(errors) <= {"cut.svg", "bytes.svg", "empty.svg"} and all(errors.values())


def test_files_of_one_name_in_two_folders(spark, tmp_path):
    line = "Point\t%d\t; InputIndex = [ 1 2 ]\t; InputPoint = [ 1.5 2.0 ]\t; OutputIndexFixed = [ 2 2 ]\t; OutputPoint = [ 2.5 1 ]\t; Deformation = [ 1.0 0.0 ]\n"
    for i, name in enumerate(("one", "two-t5")):
        (tmp_path / name).mkdir()
        (tmp_path / name / "s-t3.csv").write_text("head\n1,2,3,0.4\n")
        (tmp_path / name / "s-t3.tif").write_text("x")
        (tmp_path / name / "out.txt").write_text(line % i)
    spots_read = {(r.file, r.t, r.spot_ix) for r in read_spots(spark, str(tmp_path)).collect()}
    assert spots_read == {("one/s-t3.csv", 3, 0), ("two-t5/s-t3.csv", 3, 0)}
    assert {r.file for r in read_transformed_points(spark, f"file://{tmp_path}").collect()} == {"one/out.txt", "two-t5/out.txt"}
    assert {r.file for r in read_spots(spark, f"{tmp_path}/*").collect()} == {"one/s-t3.csv", "two-t5/s-t3.csv"}
    assert {r.file for r in read_spots(spark, f"{tmp_path}/one/s-t3.csv").collect()} == {"s-t3.csv"}
    listed = list_frames(spark, str(tmp_path)).filter("role in ('input', 'spots') and file like '%s-t3%'").collect()
    assert {(r.title, r.t) for r in listed} == {("one/s", 3), ("two-t5/s", 3)}


def test_settings_beside_chains(spark, tmp_path):
    chains = spark.createDataFrame([("c", k, "translation", [1.0, float(k)]) for k in (0, 1, 3)], "chain_id string, step int, kind string, params array<double>")
    settings = spark.createDataFrame([("c", 0, {"Metric": "A"}), ("c", 1, {"Metric": "B", "Bins": "32"}), ("c", 2, {"Metric": "C"}), ("c", 4, {"Metric": "D"}), ("d", 1, {"Metric": "E"})], "chain_id string, step int, settings map<string,string>")
    write_chains(chains, str(tmp_path / "c"), settings)
    rows = {(r.chain_id, r.step): (r.kind, r.prev_step, r.settings) for r in read_chain_settings(spark, str(tmp_path / "c")).collect()}
    assert rows == {("c", 0): ("translation", None, {"Metric": "A"}), ("c", 1): ("translation", 0, {"Metric": "B", "Bins": "32"}), ("c", 2): (None, None, {"Metric": "C"})}
    assert sorted(r.step for r in read_chains(spark, str(tmp_path / "c")).collect()) == [0, 1]
    write_chains(chains, str(tmp_path / "plain"))
    assert {r.settings for r in read_chain_settings(spark, str(tmp_path / "plain")).collect()} == {None}


def test_frames(spark, tmp_path):
    put(tmp_path, **{"mov-t1.tif": "x", "mov-t1_cp_masks.tif": "x", "mov-t2.tif": "x", "mov-t2.csv": "x", "mov-t3.tif": ""})
    listed = list_frames(spark, str(tmp_path))
    assert sorted((r.title, r.t, r.role) for r in listed.collect()) == [("mov", 1, "input"), ("mov", 1, "mask"), ("mov", 2, "input"), ("mov", 2, "spots")]
    assert sorted(map(tuple, match_outputs(listed).collect())) == [("mov", 1, "mask", "found"), ("mov", 2, "mask", "missing")]


def test_tables(spark, tmp_path):
    rois = spark.createDataFrame([("a", 0, "n"), ("a", None, "lost")], "set_id string, roi_ix int, name string")
    vertices = spark.createDataFrame([("a", 0, 0, 0, 1.0, 2.0), ("a", 0, 0, 1, None, 2.0)], "set_id string, roi_ix int, poly_ix int, vertex_ix int, x double, y double")
    write_rois(rois, vertices, str(tmp_path / "r"))
    assert [f.count() for f in read_rois(spark, str(tmp_path / "r"))] == [1, 1]
    chains = spark.createDataFrame([("c", 0, "translation", [1.0, 2.0]), ("c", 1, "translation", [3.0, 4.0]), ("c", 3, "translation", [0.0, 0.0])], "chain_id string, step int, kind string, params array<double>")
    write_chains(chains, str(tmp_path / "c"))
    back = read_chains(spark, str(tmp_path / "c"))
    assert sorted((r.step, r.prev_step) for r in back.collect()) == [(0, None), (1, 0)]
    point = spark.createDataFrame([("c", 0.0, 0.0), ("unknown", 5.0, 5.0)], "chain_id string, x double, y double")
    assert sorted((r.x, r.y) for r in transform.transform_points(point, back).collect()) == [(4.0, 6.0), (5.0, 5.0)]


def plane_of(width, height, **options):
    """One plane's pixels, made by Spark."""
    return options["spark"].range(width * height).selectExpr("0 as image_id", "1 as c", "0 as z", "1 as t", f"cast(id div {width} as int) as y", f"cast(id % {width} as int) as x", "cast(id % 1000 as double) as v")


def test_planes_with_gaps(spark):
    rows = [(0, 1, 0, 1, 1, 0, 5.0), (0, 1, 0, 1, 1, 2, 7.0), (0, 1, 0, 1, 1, 2, 6.0), (0, 1, 0, 1, 3, 1, None), (1, 1, 0, 1, 0, 0, 2.0)]
    planes = frames.pack_planes(spark.createDataFrame(rows, "image_id int, c int, z int, t int, y int, x int, v double"))
    assert {r.image_id: (r.width, r.height, r.data) for r in planes.collect()} == {0: (3, 4, [0, 0, 0, 5, 0, 6, 0, 0, 0, 0, 0, 0]), 1: (1, 1, [2])}
    assert frames.pack_planes(plane_of(1, 0, spark=spark)).count() == 0


def test_large_planes_take_time_by_the_pixel(spark):
    import time

    def pack(width, keep="true"):
        began = time.perf_counter()
        packed = frames.pack_planes(plane_of(width, width, spark=spark).filter(keep)).select(F.size("data").alias("n"), F.aggregate("data", F.lit(0.0), lambda a, v: a + v).alias("s")).first()
        assert packed.n == width * width
        return time.perf_counter() - began, packed.s

    pack(120)
    small, _ = pack(240)
    large, total = pack(1024)
    assert total == sum(i % 1000 for i in range(1 << 20)) and large < 18 * small + 5
    assert pack(1024, "x % 7 != 3 or x = 1023")[1] < total


def test_percentiles_of_a_large_image(spark):
    import numpy as np

    pixels = plane_of(500, 400, spark=spark).withColumn("v", F.when(F.col("v") < 300, 1.0).otherwise(F.xxhash64("x", "y") % 100_000 / 7.0))
    values = np.array([r.v for r in pixels.select("v").collect()])
    for shares in ([0.03, 0.998], [0.0, 1.0, 0.5, 0.29, 0.30]):
        assert frames.percentiles(pixels, shares, bins=64).first().p == pytest.approx(list(np.quantile(values, shares)))
    plan = frames.percentile_normalize(pixels).select("v")
    low, high = np.quantile(values, [0.03, 0.998])
    assert sorted(r.v for r in plan.collect()) == pytest.approx(sorted((values - low) / (high - low)))
    assert frames.percentile_normalize(pixels.filter("v < 0 and v > 0")).count() == 0


def test_large_images_are_sampled_and_moved_in_parts(spark):
    pixels = plane_of(700, 600, spark=spark)
    chosen = transform.sample_pixels(pixels, 2048, 5)
    assert chosen.count() == 2048 and chosen.columns == pixels.columns
    key = lambda r: ((r.x * 73856093) ^ (r.y * 19349663) ^ (5 * 83492791)) % 2147483647
    order = sorted((key(r), r.y, r.x) for r in pixels.select("x", "y").collect())[:2048]
    assert sorted((key(r), r.y, r.x) for r in chosen.collect()) == order
    assert transform.sample_pixels(pixels.limit(10), 2048).count() == 10
    chain = spark.createDataFrame([("c", 0, "translation", [0.25, -1.5])], "chain_id string, step int, kind string, params array<double>")
    moved = transform.transform_image(pixels.withColumn("chain_id", F.lit("c")), chain)
    at = {(r.y, r.x): r.v for r in moved.filter("y < 4 or x > 697").collect()}
    value = lambda y, x: float((y * 700 + x) % 1000) if 0 <= y < 600 and 0 <= x < 700 else 0.0
    for (y, x), v in at.items():
        assert v == pytest.approx(sum(w * u * value(y - 2 + j, x + i) for i, w in ((0, 0.75), (1, 0.25)) for j, u in ((0, 0.5), (1, 0.5))))


def test_thickness_zero_and_shared_folders(spark):
    files = sections.section_index(spark.createDataFrame([("a", "x_s004.png"), ("a", "x_s001.png")], "series string, path string"))
    assert {r.depth for r in sections.space_sections(files, 0.0).collect()} == {0.0}
    from vertexloom.functions import settle

    class Session:
        conf, master = {}, "spark://host:7077"

    Session.sparkContext = Session
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        settle.folder(Session, "x")


def test_corpus_queries_that_cannot_be_imported(monkeypatch):
    """A missing package leaves the library's queries; a mistake inside the subpackage is raised."""
    import builtins
    import importlib.util

    import __spark_entry__

    own = builtins.__import__

    def missing(name):
        def fake(module, *args, **options):
            if module == "vertexloom.llm" or module.startswith("vertexloom.llm."):
                raise ModuleNotFoundError(f"No module named {name!r}", name=name)
            return own(module, *args, **options)

        return fake

    monkeypatch.setattr(builtins, "__import__", missing("regex"))
    with pytest.warns(UserWarning, match="regex"):
        assert len(__spark_entry__.queries()) >= 62
    monkeypatch.setattr(importlib.util, "find_spec", lambda name: object())
    monkeypatch.setattr(builtins, "__import__", missing("vertexloom.llm.mistyped"))
    with pytest.raises(ModuleNotFoundError, match="mistyped"):
        __spark_entry__.queries()
    monkeypatch.setattr(importlib.util, "find_spec", lambda name: None)
    monkeypatch.setattr(builtins, "__import__", missing("vertexloom.llm"))
    with pytest.warns(UserWarning, match="vertexloom.llm"):
        assert len(__spark_entry__.queries()) >= 62


def test_planes(spark):
    pixels = spark.createDataFrame([(0, 1, 0, t, y, x, float(t * 10 + y * 2 + x)) for t in (1, 2) for y in range(2) for x in range(2)], "image_id int, c int, z int, t int, y int, x int, v double")
    planes = frames.pack_planes(pixels)
    assert sorted(map(tuple, frames.unpack_planes(planes).collect())) == sorted(map(tuple, pixels.collect()))
    uneven = frames.apply_per_plane(planes, lambda a: a[:1] if a[0, 0] > 15 else a)
    try:
        uneven.collect()
        raise AssertionError("sizes differ")
    except Exception as error:
        assert "differ in size" in str(error)


def test_sections(spark):
    files = sections.section_index(spark.createDataFrame([("a", "x_s004.png"), ("a", "x_s001.png"), ("a", "x_s002.png"), ("b", "none.png")], "series string, path string"))
    assert {r.path: r.section for r in files.collect()} == {"x_s004.png": 4, "x_s001.png": 1, "x_s002.png": 2, "none.png": None}
    assert [tuple(r) for r in sections.missing_sections(files).collect()] == [("a", 3)]
    depth = {r.section: r.depth for r in sections.space_sections(files).filter("series = 'a'").collect()}
    assert depth == {1: 0.0, 2: 1.0, 4: 3.0}


def test_constant_image_and_tiles(spark):
    flat = spark.createDataFrame([(0, 0, y, x, 3.0) for y in range(2) for x in range(4)], "image_id int, z int, y int, x int, v double")
    assert {r.v for r in frames.percentile_normalize(flat).collect()} == {0.0}
    sizes = spark.createDataFrame([(0, 4, 2, 1)], "image_id int, width int, height int, depth int")
    assert {(r.x, r.tile_x) for r in frames.tile_pixels(flat, sizes, 1, 2).collect()} == {(0, 0), (1, 0), (2, 1), (3, 1)}
    assert {r.tile_x for r in frames.tile_pixels(flat, sizes, -1, 2).collect()} == {0}
    assert spots.filter_detections(flat.select(F.lit(0.1).alias("probability")), -1).count() == 8


def test_folders_for_workers(spark):
    """A folder without a scheme is on Spark's default file system; one that workers can't open is refused before anything runs."""
    from vertexloom.functions.settle import place_for_workers
    from vertexloom.sources.files import write_files

    assert place_for_workers(spark, "/some/where") == "file:///some/where"
    assert place_for_workers(spark, "file:/some/where") == place_for_workers(spark, "file:///some/where") == "file:///some/where"
    assert place_for_workers(spark, "s3a://bucket/a b") == "s3://bucket/a b"
    assert place_for_workers(spark, "hdfs://name:8020/a") == "hdfs://name:8020/a"
    for folder in ("dbfs:/a", "wasbs://c@host/a"):
        with pytest.raises(ValueError, match="can't write named files"):
            write_files(spark.createDataFrame([("a", "b")], "file string, value string"), folder)
    spark._jsc.hadoopConfiguration().set("fs.defaultFS", "hdfs://name:8020")
    try:
        assert place_for_workers(spark, "/some/where") == "hdfs://name:8020/some/where"
    except Exception as error:  # without a client for it, naming it is enough
        assert "name" in str(error) or "hdfs" in str(error).lower()
    finally:
        spark._jsc.hadoopConfiguration().set("fs.defaultFS", "file:///")
