"""Queries of the frame and pixel operators."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from vertexloom.operators import frames
from vertexloom.plans import fixtures as fx
from vertexloom.plans.fixtures import cte
from vertexloom.plans.registry import query
from vertexloom.plans.roi import rounded


@query("i01_split_frames", cte("gray", "img") + " SELECT image_id, c, z, gray.t AS t, y, x, v, title, title || '-t' || gray.t AS frame FROM gray JOIN img USING (image_id)")
def split_frames(spark, sf_dir):
    return frames.split_frames(fx.gray_raster(spark, sf_dir), fx.images(spark, sf_dir))


@query("i02_concat_frames", cte("gray") + " SELECT image_id, c, z, k + 1 AS t, y, x, round(v * (1 - 2 * k), 5) + 0.0 AS v FROM gray, range(2) r(k)")
def concat_frames(spark, sf_dir):
    """Each image at times 1 and 5, the second one negative."""
    gray = fx.gray_raster(spark, sf_dir)
    later = gray.withColumns({"t": F.lit(5), "v": (-F.col("v")).cast("float")})
    return frames.concat_frames([gray, later]).withColumn("v", F.round(F.col("v").cast("double"), 5) + 0.0)


@query("i03_carry_metadata", cte("gray", "img") + " SELECT image_id, c, z, t, y, x, round(v, 5) + 0.0 AS v, split_part(title, '.', 1) || '-cellmask' AS title, width, height, depth, pixel_size FROM gray JOIN img USING (image_id)")
def carry_metadata(spark, sf_dir):
    return rounded(frames.carry_metadata(fx.gray_raster(spark, sf_dir), fx.images(spark, sf_dir), "cellmask"), "v", places=5)


@query("i04_split_channels", cte("rgb") + " SELECT image_id, y, x, c, ((rgb >> (24 - 8 * c)::INT) & 255)::DOUBLE AS v FROM rgb, range(1, 4) r(c)")
def split_channels(spark, sf_dir):
    return frames.split_channels(fx.rgb_raster(spark, sf_dir))


@query("i05_merge_channels", cte("rgb") + " SELECT image_id, y, x, least(255, (rgb >> 16) * 2) * 65536 + least(255, ((rgb >> 8) & 255) * 2) * 256 + least(255, (rgb & 255) * 2) AS rgb FROM rgb")
def merge_channels(spark, sf_dir):
    """Channels made twice as bright and put together again."""
    return frames.merge_channels(frames.split_channels(fx.rgb_raster(spark, sf_dir)).withColumn("v", F.col("v") * 2))


@query("i06_apply_per_plane", cte("gray") + " SELECT image_id, c, z, t, y, 63 - x AS x, round(v * 2, 5) + 0.0 AS v FROM gray")
def apply_per_plane(spark, sf_dir):
    """Planes mirrored and doubled by a function on arrays."""
    planes = frames.pack_planes(fx.gray_raster(spark, sf_dir))
    return rounded(frames.unpack_planes(frames.apply_per_plane(planes, lambda a: a[:, ::-1] * 2)), "v", places=5)


@query("u01_run_on_frames", cte("gray") + " SELECT image_id, t, count(*) AS n_bright, round(max(v), 5) AS brightest FROM gray WHERE v > 0.1 GROUP BY ALL")
def run_on_frames(spark, sf_dir):
    """A model that counts bright pixels of a frame, loaded once for each worker."""

    def load():
        def model(frame: pd.DataFrame) -> pd.DataFrame:
            bright = [v for data in frame["data"] for v in data[data > 0.1]]
            return pd.DataFrame({"image_id": frame["image_id"][:1], "t": frame["t"][:1], "n_bright": [len(bright)], "brightest": [float(max(bright, default=0))]})

        return model

    planes = frames.pack_planes(fx.gray_raster(spark, sf_dir))
    return rounded(frames.run_on_frames(planes, load, "image_id long, t int, n_bright long, brightest double").filter("n_bright > 0"), "brightest", places=5)


@query(
    "u01_run_on_deep_frames",
    cte("gray") + " SELECT image_id, t, (SELECT count(DISTINCT y // 10) FROM gray h WHERE h.image_id = d.image_id) AS n_planes, round(max(d), 5) AS depth FROM (SELECT image_id, t, y % 10 AS y, x, max(v) - min(v) AS d FROM gray GROUP BY ALL) d GROUP BY image_id, t",
)
def run_on_deep_frames(spark, sf_dir):
    """Every ten rows of an image are a slice of its frame: the model projects over all slices at once, so a part of a frame would give another result.

    An image's last slice may have fewer rows than the others, and rows may be
    missing; a second channel says which pixels are there.
    """

    def load():
        def model(frame: pd.DataFrame) -> pd.DataFrame:
            shape = (frame["height"].max(), frame["width"].max())

            def stack(c: int) -> np.ndarray:
                planes = frame[frame["c"] == c]
                out = np.zeros((len(planes), *shape))
                for i, (data, h, w) in enumerate(zip(planes["data"], planes["height"], planes["width"], strict=True)):
                    out[i, :h, :w] = data.reshape(h, w)
                return out

            values, there = stack(1), stack(2) > 0
            depth = np.where(there, values, -np.inf).max(0) - np.where(there, values, np.inf).min(0)
            seen = depth[there.any(0)]
            return pd.DataFrame({"image_id": frame["image_id"][:1], "t": frame["t"][:1], "n_planes": [len(values)], "depth": [seen.max() if len(seen) else None]})

        return model

    deep = fx.gray_raster(spark, sf_dir).withColumns({"z": F.floor(F.col("y") / 10).cast("int"), "y": F.col("y") % 10})
    there = deep.withColumns({"c": F.lit(2), "v": F.col("v").isNotNull().cast("double")})
    rows = frames.run_on_frames(frames.pack_planes(deep.unionByName(there)), load, "image_id long, t int, n_planes long, depth double")
    return rounded(rows, "depth", places=5)


@query(
    "g01_percentile_normalize",
    cte("gray")
    + """, p AS (SELECT image_id, quantile_cont(v, 0.03) AS a, quantile_cont(v, 0.998) AS b FROM gray GROUP BY image_id)
SELECT image_id, c, z, t, y, x, round(coalesce((v - a) / nullif(b - a, 0), 0), 6) + 0.0 AS v FROM gray JOIN p USING (image_id)""",
)
def percentile_normalize(spark, sf_dir):
    return rounded(frames.percentile_normalize(fx.gray_raster(spark, sf_dir)), "v")


@query("g03_tile_pixels", cte("gray") + " SELECT image_id, y, x, 0 AS tile_z, y * 3 // 50 AS tile_y, x * 4 // 64 AS tile_x FROM gray")
def tile_pixels(spark, sf_dir):
    return frames.tile_pixels(fx.gray_raster(spark, sf_dir), fx.images(spark, sf_dir), 3, 4).select("image_id", "y", "x", "tile_z", "tile_y", "tile_x")
