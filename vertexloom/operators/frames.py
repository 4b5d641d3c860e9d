"""Operators on pixels ``image_id, c, z, t, y, x, v``, on planes that pack them, and on frames of time-lapses."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vertexloom.functions.settle import settled

#: Bins of the first pass over an image's values.
BINS = 4096
#: Rows of an image whose pixels meet what is known of it together.
ROWS = 64
PLANE = ["image_id", "c", "z", "t"]
FRAME = ["image_id", "t"]

#: A worker's model, by the call that it belongs to.
_models: dict[str, Callable] = {}


def split_frames(pixels: DataFrame, images: DataFrame) -> DataFrame:
    """Pixels with the frame that they belong to: all channels and slices of one time point, named after it."""
    named = pixels.join(images.select("image_id", "title"), "image_id")
    return named.withColumn("frame", F.concat_ws("-t", "title", F.col("t").cast("string")))


def concat_frames(frames: list[DataFrame], as_float: bool = True) -> DataFrame:
    """Results of frames, of any depth, as one stack, in float unless ``as_float`` is off; times are numbered from 1 without gaps."""
    out = None
    for frame in frames:
        same = frame.withColumn("v", F.col("v").cast("float")) if as_float else frame
        out = same if out is None else out.unionByName(same)
    times = out.select("image_id", "t").distinct().withColumn("new_t", F.row_number().over(Window.partitionBy("image_id").orderBy("t")))
    return out.join(times, ["image_id", "t"]).drop("t").withColumnRenamed("new_t", "t")


def carry_metadata(result: DataFrame, images: DataFrame, suffix: str) -> DataFrame:
    """Results with their source image's calibration and its short title (up to the first dot) and the tool's name."""
    short = F.substring_index("title", ".", 1)
    known = images.select("image_id", F.concat_ws("-", short, F.lit(suffix)).alias("title"), *[c for c in images.columns if c not in ("image_id", "title")])
    return result.join(known, "image_id")


def split_channels(rgb: DataFrame) -> DataFrame:
    """Packed colours ``rgb`` as three channels, from 1, of values from 0 to 255."""
    parts = F.array(*[F.shiftright("rgb", 16 - 8 * i).bitwiseAND(255).cast("double") for i in range(3)])
    return rgb.select(*[c for c in rgb.columns if c != "rgb"], F.posexplode(parts).alias("c", "v")).withColumn("c", F.col("c") + 1)


def merge_channels(pixels: DataFrame) -> DataFrame:
    """Three channels back to packed colours; values are cut off at 0 and 255."""
    keys = [c for c in pixels.columns if c not in ("c", "v")]
    byte = F.least(F.greatest(F.floor("v"), F.lit(0)), F.lit(255)).cast("int")
    parts = [F.coalesce(F.max(F.when(F.col("c") == i + 1, F.shiftleft("byte", 16 - 8 * i))), F.lit(0)) for i in range(3)]
    return pixels.withColumn("byte", byte).groupBy(*keys).agg((parts[0] + parts[1] + parts[2]).alias("rgb"))


def pack_planes(pixels: DataFrame) -> DataFrame:
    """One row for each plane: width, height and its values row by row; missing pixels are 0, and of a pixel given twice the lower value counts.

    A plane's pixels are gathered and sorted once; a plane with gaps is
    filled from each pixel's distance to the one before it.
    """
    value = F.coalesce(F.col("v").cast("float"), F.lit(0.0).cast("float"))
    gathered = pixels.groupBy(*PLANE).agg((F.max("x") + 1).alias("width"), (F.max("y") + 1).alias("height"), F.collect_list(F.struct("y", "x", value.alias("v"))).alias("p"))
    area = (F.col("width").cast("long") * F.col("height")).cast("int")
    at = gathered.select(*PLANE, "width", "height", area.alias("area"), F.transform(F.array_sort("p"), lambda p: F.struct((p["y"].cast("long") * F.col("width") + p["x"]).cast("int").alias("i"), p["v"].alias("v"))).alias("p"))
    before = lambda k: F.when(k > 0, F.get("p", k - 1)["i"]).otherwise(-1)
    zeros = lambda n: F.array_repeat(F.lit(0.0).cast("float"), n)
    filled = F.flatten(F.transform("p", lambda p, k: F.when(p["i"] == before(k), F.array().cast("array<float>")).otherwise(F.concat(zeros(p["i"] - before(k) - 1), F.array(p["v"])))))
    tail = zeros(F.col("area") - 1 - F.element_at("p", -1)["i"])
    dense = (F.size("p") == F.col("area")) & ~F.exists(F.transform("p", lambda p, k: p["i"] != k), lambda wrong: wrong)
    return at.select(*PLANE, "width", "height", F.when(dense, F.transform("p", lambda p: p["v"])).otherwise(F.concat(filled, tail)).alias("data"))


def unpack_planes(planes: DataFrame) -> DataFrame:
    each = planes.select(*PLANE, "width", F.posexplode("data").alias("i", "v"))
    return each.select(*PLANE, F.floor(F.col("i") / F.col("width")).cast("int").alias("y"), (F.col("i") % F.col("width")).cast("int").alias("x"), F.col("v").cast("double").alias("v"))


def apply_per_plane(planes: DataFrame, function: Callable) -> DataFrame:
    """``function(2-D array) -> 2-D array`` on every plane; all planes of an image must come out in one size."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = [function(data.reshape(h, w)) for data, h, w in zip(batch["data"], batch["height"], batch["width"], strict=True)]
            yield batch.assign(data=[o.astype("float32").ravel() for o in out], height=[o.shape[0] for o in out], width=[o.shape[1] for o in out])

    made = planes.mapInPandas(run, planes.schema)
    image = Window.partitionBy("image_id")
    odd = (F.min("width").over(image) != F.max("width").over(image)) | (F.min("height").over(image) != F.max("height").over(image))
    return made.withColumn("width", F.when(odd, F.raise_error(F.lit("planes of an image differ in size"))).otherwise(F.col("width")).cast("int"))


def model_of(call: str, load: Callable) -> Callable:
    """The worker's model of a call: loaded once, and kept for later tasks until another call's is wanted."""
    if call not in _models:
        _models.clear()
        _models[call] = load()
    return _models[call]


def whole_groups(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """Rows that arrive sorted by ``keys``, group by group: the open group's rows are held back until the next group begins."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        if not len(batch):
            continue
        values = batch[keys]
        same = values.eq(values.shift()) | (values.isna() & values.shift().isna())
        starts = [0, *[i for i in range(1, len(batch)) if not same.iloc[i].all()]]
        for start, end in zip(starts, [*starts[1:], len(batch)], strict=True):
            part = batch.iloc[start:end]
            if held:
                before, now = held[-1][keys].iloc[-1], part[keys].iloc[0]
                if not ((before == now) | (before.isna() & now.isna())).all():
                    yield pd.concat(held, ignore_index=True)
                    held = []
            held.append(part)
    if held:
        yield pd.concat(held, ignore_index=True)


def run_on_frames(planes: DataFrame, load: Callable, schema: str) -> DataFrame:
    """Inference on whole frames: ``load()`` gives a model once per worker, ``model(planes) -> rows`` runs once on each frame, with all its slices and channels, in the order of z, then c.

    A frame's planes are sorted next to each other in one task and may come in
    several batches; the open frame is held back, so that no model sees a part
    of one. A task holds a frame and a batch at a time.
    """
    call = uuid.uuid4().hex

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = model_of(call, load)
        for frame in whole_groups(batches, FRAME):
            yield model(frame)

    return planes.repartition(*FRAME).sortWithinPartitions(*FRAME, "z", "c").mapInPandas(run, schema)


def _ends(pixels: DataFrame) -> DataFrame:
    """Of each image: the least and greatest value, their number, and its first and last row."""
    known = pixels.filter("v is not null").groupBy("image_id")
    return settled(known.agg(F.min("v").alias("low"), F.max("v").alias("high"), F.count(F.lit(1)).alias("n"), F.min("y").alias("top"), F.max("y").alias("bottom")))


def _with_image(pixels: DataFrame, thin: DataFrame, *on: str, how: str = "inner") -> DataFrame:
    """Pixels with what ``thin`` says of their image (and of ``on``): it is copied to every block of rows from ``top`` to ``bottom``, so that a large image is in many tasks."""
    several = thin.withColumn("__rows", F.explode(F.sequence(F.floor(F.col("top") / ROWS), F.floor(F.col("bottom") / ROWS)))).drop("top", "bottom")
    return pixels.withColumn("__rows", F.floor(F.col("y") / ROWS)).join(several, ["image_id", "__rows", *on], how).drop("__rows")


def percentiles(pixels: DataFrame, shares: list[float], bins: int = BINS, ends: DataFrame | None = None) -> DataFrame:
    """``image_id, p``: exact percentiles of each image's values, between the two nearest ones where needed.

    A first pass counts values in equal bins between an image's ends, a
    second one counts the distinct values of only the bins that hold the
    wanted places. No task sees more of an image than its bins and one bin,
    and pixels meet what is known of their image by blocks of rows.
    """
    ends = _ends(pixels) if ends is None else ends
    share = F.coalesce(F.try_divide(F.col("v") - F.col("low"), F.col("high") - F.col("low")), F.lit(0.0))
    binned = _with_image(pixels.filter("v is not null"), ends).select("image_id", "y", "v", F.least(F.floor(share * bins), F.lit(bins - 1)).cast("int").alias("bin"))
    places = F.array(*[F.struct(F.lit(i).alias("which"), (F.lit(s) * (F.col("n") - 1)).alias("place")) for i, s in enumerate(shares)])
    wanted = ends.select("image_id", "top", "bottom", F.explode(places).alias("w")).select("image_id", "top", "bottom", "w.*")
    wanted = wanted.select("image_id", "top", "bottom", "which", "place", F.explode(F.array_distinct(F.array(F.floor("place"), F.ceil("place")))).alias("rank"))

    def holding(counts: DataFrame, *keys: str, order: str) -> DataFrame:
        """Rows of counts with the ranks, from 0, before and at the end of them."""
        upto = F.sum("k").over(Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0))
        return counts.withColumn("upto", upto)

    bins_of = holding(binned.groupBy("image_id", "bin").agg(F.count(F.lit(1)).alias("k")), "image_id", order="bin")
    held = wanted.join(bins_of, "image_id").filter((F.col("rank") < F.col("upto")) & (F.col("rank") >= F.col("upto") - F.col("k")))
    held = settled(held.select("image_id", "top", "bottom", "which", "place", "rank", "bin", (F.col("rank") - F.col("upto") + F.col("k")).alias("inside")))
    some = _with_image(binned, held.select("image_id", "bin", "top", "bottom").distinct(), "bin").groupBy("image_id", "bin", "v").agg(F.count(F.lit(1)).alias("k"))
    values = held.join(holding(some, "image_id", "bin", order="v"), ["image_id", "bin"]).filter((F.col("inside") < F.col("upto")) & (F.col("inside") >= F.col("upto") - F.col("k")))
    part = F.col("place") - F.floor("place")
    weight = F.when(F.col("rank") == F.floor("place"), 1 - part).otherwise(part)
    each = values.groupBy("image_id", "which").agg(F.sum(F.col("v") * weight).alias("p"))
    return each.groupBy("image_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("which", "p"))), lambda q: q["p"]).alias("p"))


def percentile_normalize(pixels: DataFrame, low: float = 3.0, high: float = 99.8) -> DataFrame:
    """Values of each image scaled so that the two percentiles become 0 and 1; an image of one value becomes 0."""
    ends = _ends(pixels)
    known = settled(percentiles(pixels, [low / 100, high / 100], ends=ends).join(ends.select("image_id", "top", "bottom"), "image_id"))
    joined = _with_image(pixels, known, how="left")
    return joined.withColumn("v", F.coalesce(F.try_divide(F.col("v") - F.col("p")[0], F.col("p")[1] - F.col("p")[0]), F.lit(0.0))).drop("p")


def tile_pixels(pixels: DataFrame, sizes: DataFrame, n_y: int, n_x: int, n_z: int | None = None) -> DataFrame:
    """Pixels with the tile that holds them; untiled (0) unless every number is over -1, counting z only where it is given."""
    numbers = [n for n in (n_z, n_y, n_x) if n is not None]
    joined = pixels.join(sizes.select("image_id", "width", "height", "depth"), "image_id")
    if min(numbers) <= -1:
        return joined.withColumns({"tile_z": F.lit(0), "tile_y": F.lit(0), "tile_x": F.lit(0)}).drop("width", "height", "depth")
    tile = {k: F.floor(F.col(c) * n / F.col(size)).cast("int") for k, c, n, size in (("tile_z", "z", n_z or 1, "depth"), ("tile_y", "y", n_y, "height"), ("tile_x", "x", n_x, "width"))}
    return joined.withColumns(tile).drop("width", "height", "depth")
