"""Interpolation, pyramids, similarity and samplers against loops."""

import math
import random

import numpy as np
import pytest

from vertexloom.operators import transform


def image(spark, array, image_id=0):
    return spark.createDataFrame([(image_id, y, x, float(v)) for y, row in enumerate(array) for x, v in enumerate(row)], "image_id int, y int, x int, v double")


def spline_through(values):
    """Coefficients of the cubic spline through mirrored values, by solving for them."""
    n = len(values)
    if n == 1:
        return np.array(values, float)
    a = np.zeros((n, n))
    for k in range(n):
        a[k, k] += 4 / 6
        a[k, k - 1 if k else 1] += 1 / 6
        a[k, k + 1 if k < n - 1 else n - 2] += 1 / 6
    return np.linalg.solve(a, values)


def cubic(t):
    t = abs(t)
    return 2 / 3 - t * t + t**3 / 2 if t < 1 else (2 - t) ** 3 / 6 if t < 2 else 0.0


def spline_at(c, x, y):
    h, w = c.shape
    if not (0 <= x <= w - 1 and 0 <= y <= h - 1):
        return 0.0

    def mirrored(i, n):
        i = abs(i)
        return 0 if n == 1 else 2 * (n - 1) - i if i > n - 1 else i

    return sum(cubic(y - j) * cubic(x - i) * c[mirrored(j, h), mirrored(i, w)] for j in range(math.floor(y) - 1, math.floor(y) + 3) for i in range(math.floor(x) - 1, math.floor(x) + 3))


@pytest.mark.parametrize("shape", [(9, 14), (3, 200), (130, 2), (64, 65), (1, 7), (1, 1)])
def test_cubic_spline(spark, shape):
    """Coefficients over several blocks, short ones and single lines; the spline goes through the pixels."""
    rng = np.random.default_rng(3)
    array = rng.normal(size=shape)
    want = np.apply_along_axis(spline_through, 0, np.apply_along_axis(spline_through, 1, array))
    got = np.zeros(shape)
    for r in transform.spline_coefficients(image(spark, array), ["image_id"]).collect():
        got[r.y, r.x] = r.v
    assert np.allclose(got, want, atol=1e-11)
    places = [(float(x), float(y)) for y in range(shape[0]) for x in range(shape[1])][:50] + [(rng.uniform(-1, shape[1]), rng.uniform(-1, shape[0])) for _ in range(200)]
    rows = spark.createDataFrame([(0, k, x, y) for k, (x, y) in enumerate(places)], "image_id int, k int, x double, y double")
    values = {r.k: r.v for r in transform.interpolated(rows, image(spark, array), ["image_id"], 3).collect()}
    assert len(values) == len(places)
    for k, (x, y) in enumerate(places):
        assert values[k] == pytest.approx(spline_at(want, x, y), abs=1e-10)
        if x == int(x) and y == int(y) and 0 <= x < shape[1] and 0 <= y < shape[0]:
            assert values[k] == pytest.approx(array[int(y), int(x)], abs=1e-10)
    with pytest.raises(ValueError):
        transform.interpolated(rows, image(spark, array), ["image_id"], 2)


def test_smoothing_equals_direct_convolution(spark):
    """Across strips, with factors of each axis, and around pixels that aren't there."""
    rng = random.Random(2)
    pixels = {(y, x): rng.random() for y in range(5) for x in range(150) if rng.random() < 0.9}
    df = spark.createDataFrame([(0, y, x, v) for (y, x), v in pixels.items()] + [(0, 0, 500, None)], "image_id int, y int, x int, v double")

    def smooth(values, sigma, axis):
        reach, out = math.ceil(3 * sigma), {}
        for y, x in values:
            near = [(d, (y, x + d) if axis else (y + d, x)) for d in range(-reach, reach + 1)]
            weights = [(math.exp(-0.5 * (d / sigma) ** 2), values[p]) for d, p in near if p in values]
            out[y, x] = sum(w * v for w, v in weights) / sum(w for w, _ in weights)
        return out

    got = {(r.level, r.y, r.x): r.v for r in transform.smoothing_pyramid(df, [(16, 2), (1, 3)]).collect()}
    for level, (fx, fy) in enumerate([(16, 2), (1, 3)]):
        want = smooth(smooth(pixels, fx / 2, 1), fy / 2, 0)
        assert {(y, x): v for (k, y, x), v in got.items() if k == level} == pytest.approx(want, abs=1e-12)
    few = {(r.y, r.x): r.v for r in transform.smoothing_pyramid(df, [(16, 2)], shrink=True).collect()}
    assert few == pytest.approx({(y // 2, x // 16): got[0, y, x] for y, x in pixels if y % 2 == 0 and x % 16 == 0})
    with pytest.raises(ValueError):
        transform.recursive_pyramid(df, [(3, 3), (2, 2)])


def test_similarity_of_channels(spark):
    """Soft histograms by loops; an image is most similar to itself, and weights count."""
    rng = random.Random(5)
    rows = [(0, c, y, x, (f := rng.random()), f if c == 0 else rng.random()) for c in (0, 1) for y in range(20) for x in range(20)] + [(1, 0, 0, 0, 5.0, 5.0), (1, 0, 0, 1, 5.0, 5.0), (1, 0, 0, 2, None, 1.0)]
    df = spark.createDataFrame(rows, "pair_id int, c int, y int, x int, fixed double, moving double")
    joint = {}
    for *_, f, m in (r for r in rows if r[:2] == (0, 1)):
        own = [r for r in rows if r[:2] == (0, 1)]
        lo, hi = min(r[5] for r in own), max(r[5] for r in own)
        flo, fhi = min(r[4] for r in own), max(r[4] for r in own)
        at, bf = (m - lo) / (hi - lo) * 28 + 2, min(29, math.floor((f - flo) / (fhi - flo) * 28 + 2))
        for b in range(32):
            if cubic(at - b):
                joint[bf, b] = joint.get((bf, b), 0) + cubic(at - b)
    got = {(r.bf, r.bm): r.w for r in transform.soft_histograms(df).filter("pair_id = 0 and c = 1 and w > 1e-12").collect()}
    assert got == pytest.approx({k: w for k, w in joint.items() if w > 1e-12})
    n = sum(joint.values())
    mutual = sum(w / n * math.log(w * n / (sum(v for k, v in joint.items() if k[0] == f) * sum(v for k, v in joint.items() if k[1] == m))) for (f, m), w in joint.items())
    by = {name: {r.pair_id: r for r in transform.weighted_similarity(df, weights).collect()} for name, weights in (("one", {1: 1.0}), ("zero", {0: 1.0}), ("equal", None), ("none", {}))}
    assert by["one"][0].mutual_information == pytest.approx(mutual)
    assert by["zero"][0].mutual_information > 2 * by["one"][0].mutual_information and by["zero"][0].mean_square == 0
    assert by["equal"][0].mutual_information == pytest.approx((by["one"][0].mutual_information + by["zero"][0].mutual_information) / 2)
    assert by["equal"][1].mutual_information == pytest.approx(0) and by["none"][0].mutual_information == 0


def test_samplers(spark):
    pixels = image(spark, np.arange(600).reshape(20, 30)).unionByName(image(spark, np.ones((4, 4)), 1))
    one, two, again = ({(r.image_id, r.k): (r.x, r.y, r.v) for r in transform.sample_coordinates(pixels, 100, 5, i).collect()} for i in (0, 1, 0))
    assert one == again and len(one) == 200 and not set(one.values()) & set(two.values())
    for (i, _), (x, y, v) in one.items():
        assert 0 <= x <= (29, 3)[i] and 0 <= y <= (19, 3)[i]
        assert v == pytest.approx(30 * y + x if i == 0 else 1)
    xs = [x for (i, _), (x, *_) in one.items() if i == 0]
    assert min(xs) < 5 and max(xs) > 24 and abs(sum(xs) / len(xs) - 14.5) < 3
    counts = {s: transform.sample(pixels, s, 50, 1, 0, (7, 3)).groupBy("image_id").count().orderBy("image_id").collect() for s in ("Random", "Grid", "Full", "RandomCoordinate")}
    assert {s: [r["count"] for r in rows] for s, rows in counts.items()} == {"Random": [50, 16], "Grid": [35, 2], "Full": [600, 16], "RandomCoordinate": [50, 50]}
    first, later = ({(r.x, r.y) for r in transform.sample_pixels(pixels, 50, 1, i).filter("image_id = 0").collect()} for i in (0, 1))
    assert first != later
    with pytest.raises(ValueError):
        transform.sample(pixels, "Other")
