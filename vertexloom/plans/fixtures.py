"""Geometry, rasters, spots, chains and files derived from the given tables, in Spark and in SQL.

``SQL`` has each fixture as the body of a common table expression; ``cte``
puts those that a query needs before it.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vertexloom.functions.settle import dealt

#: Rows of a table that a task of a later shuffle holds, about.
ROWS_TOGETHER = 200_000
PARTITIONS = "spark.sql.shuffle.partitions"
LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def with_tasks_for(rows: DataFrame, each: int = 1) -> DataFrame:
    """The rows, of which ``each`` are made in later steps, and at least so many shuffle partitions in their session that tasks don't grow with a table; it stays set, as Spark reads it when a lazy result is planned."""
    spark, wanted = rows.sparkSession, math.ceil(rows.count() * each / ROWS_TOGETHER)
    if wanted > int(spark.conf.get(PARTITIONS)):
        spark.conf.set(PARTITIONS, wanted)
    return rows


def lines_of_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items, all of an order in one task."""
    return dealt(with_tasks_for(table(spark, sf_dir, "lineitem")), "l_orderkey")


def order_polygons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One polygon for each order: its line items are the vertices."""
    order = Window.partitionBy("l_orderkey").orderBy(*LINE_ORDER)
    lines = lines_of_orders(spark, sf_dir)
    return lines.select(F.col("l_orderkey").alias("set_id"), F.lit(0).alias("roi_ix"), F.lit(0).alias("poly_ix"), (F.row_number().over(order) - 1).alias("vertex_ix"), F.col("l_quantity").alias("x"), (F.col("l_extendedprice") / 1000).alias("y"))


def customer_rois(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A set for each customer, a region for each order, a polygon for each return flag."""
    lines = lines_of_orders(spark, sf_dir).join(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey").hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"))
    flag = F.dense_rank().over(Window.partitionBy("l_orderkey").orderBy("l_returnflag")) - 1
    order = Window.partitionBy("l_orderkey", "l_returnflag").orderBy(*LINE_ORDER)
    return lines.select(F.col("o_custkey").alias("set_id"), F.col("l_orderkey").alias("roi_ix"), flag.alias("poly_ix"), (F.row_number().over(order) - 1).alias("vertex_ix"), F.col("l_quantity").alias("x"), (F.col("l_extendedprice") / 1000).alias("y"))


def embedding_polygons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A polygon of 32 vertices for each vector, by pairs of its elements; sets of 50."""
    each = with_tasks_for(table(spark, sf_dir, "embeddings"), 1000).select("vec_id", F.posexplode("embedding").alias("i", "v"))
    wide = each.groupBy("vec_id", F.floor(F.col("i") / 2).cast("int").alias("vertex_ix")).agg(F.max(F.when(F.col("i") % 2 == 0, F.col("v"))).cast("double").alias("a"), F.max(F.when(F.col("i") % 2 == 1, F.col("v"))).cast("double").alias("b"))
    return wide.select(F.floor(F.col("vec_id") / 50).alias("set_id"), F.col("vec_id").alias("roi_ix"), F.lit(0).alias("poly_ix"), "vertex_ix", (100 * F.col("a")).alias("x"), (100 * F.col("b")).alias("y"))


def gray_raster(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Images of 64 by 50 pixels: a row for each vector, a pixel for each element."""
    each = table(spark, sf_dir, "embeddings").select("vec_id", F.posexplode("embedding").alias("x", "v"))
    return each.select(F.floor(F.col("vec_id") / 50).alias("image_id"), F.lit(1).alias("c"), F.lit(0).alias("z"), F.lit(1).alias("t"), (F.col("vec_id") % 50).cast("int").alias("y"), "x", F.col("v").cast("double").alias("v"))


def label_raster(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gray_raster(spark, sf_dir).select("image_id", "y", "x", F.floor((F.col("v") + 0.6) * 5).cast("double").alias("label"))


def rgb_raster(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Colours from an element and its two neighbours to the right, as bytes."""
    row = Window.partitionBy("image_id", "y").orderBy("x")
    byte = F.floor(F.abs("v") * 1000).cast("int") % 256
    b = gray_raster(spark, sf_dir).withColumn("r", byte).withColumns({"g": F.coalesce(F.lead("r", 1).over(row), F.lit(0)), "b": F.coalesce(F.lead("r", 2).over(row), F.lit(0))})
    return b.select("image_id", "y", "x", (F.col("r") * 65536 + F.col("g") * 256 + F.col("b")).alias("rgb"))


def images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Title, size and calibration of the images."""
    ids = table(spark, sf_dir, "embeddings").select(F.floor(F.col("vec_id") / 50).alias("image_id")).distinct()
    return ids.select("image_id", F.concat(F.lit("img"), F.col("image_id").cast("string"), F.lit(".raw.tif")).alias("title"), F.lit(64).alias("width"), F.lit(50).alias("height"), F.lit(1).alias("depth"), (F.col("image_id") * 0.5).alias("pixel_size"))


def spots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A spot for each event, a file for each of 50 groups of users and day of the month."""
    events = table(spark, sf_dir, "events")
    file = F.concat(F.lit("u"), (F.col("user_id") % 50).cast("string"), F.lit("-t"), F.dayofmonth("ts").cast("string"), F.lit(".csv"))
    k = F.get_json_object("props", "$.k").cast("int")
    rows = events.select(file.alias("file"), F.dayofmonth("ts").alias("t"), "event_id", (F.col("event_id") % 512).cast("double").alias("x"), F.floor(F.col("event_id") / 512).cast("double").alias("y"), (k % 5).cast("double").alias("z"), F.col("value").alias("intensity"), (k / 100).alias("probability"))
    return rows.withColumn("spot_ix", F.row_number().over(Window.partitionBy("file").orderBy("event_id")) - 1).drop("event_id")


def roi_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of regions: brands of the parts of a supplier group's lines."""
    lines = with_tasks_for(table(spark, sf_dir, "lineitem")).join(table(spark, sf_dir, "part").select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey"))
    order = Window.partitionBy("set_id").orderBy("l_orderkey", *LINE_ORDER)
    return lines.withColumn("set_id", F.col("l_suppkey")).select("set_id", (F.row_number().over(order) - 1).alias("roi_ix"), F.col("p_brand").alias("name"))


def chains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A chain for each customer's orders, kinds in turn; chains of every seventh customer lack step 2."""
    order = Window.partitionBy("o_custkey").orderBy("o_orderkey")
    steps = table(spark, sf_dir, "orders").withColumn("step", F.row_number().over(order) - 1).filter("not (o_custkey % 7 = 0 and step = 2)")
    n = (F.col("o_orderkey") % 11).cast("double")
    params = F.when(F.col("step") % 3 == 0, F.array(n, 0 - n)).when(F.col("step") % 3 == 1, F.array(n / 7, n, F.lit(1.0), F.lit(16.0), F.lit(16.0))).otherwise(F.array(1 + n / 97, n / 193, (0 - n) / 193, 1 - n / 97, F.lit(0.5), 0 - n, F.lit(8.0), F.lit(8.0)))
    kind = F.when(F.col("step") % 3 == 0, "translation").when(F.col("step") % 3 == 1, "euler").otherwise("affine")
    return steps.select(F.col("o_custkey").alias("chain_id"), "step", kind.alias("kind"), params.alias("params"))


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An input frame for each of 50 groups of users and day, and its mask unless the day's last event has a number divisible by five."""
    days = table(spark, sf_dir, "events").groupBy(F.concat(F.lit("u"), (F.col("user_id") % 50).cast("string")).alias("title"), F.dayofyear("ts").alias("t")).agg((F.max("event_id") % 5 == 0).alias("failed"))
    files = days.select("title", "t", F.explode(F.when(F.col("failed"), F.array(F.lit(".tif"))).otherwise(F.array(F.lit(".tif"), F.lit("_cp_masks.tif")))).alias("end"))
    return files.select(F.concat("title", F.lit("-t"), F.col("t").cast("string"), "end").alias("file"))


def sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A section image for each user's day with an event."""
    days = table(spark, sf_dir, "events").select(F.col("user_id").alias("series"), F.dayofyear("ts").alias("day")).distinct()
    return days.select("series", F.concat(F.lit("sec_s"), F.lpad(F.col("day").cast("string"), 3, "0"), F.lit(".png")).alias("path"))


def path_commands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A path for each order: a new sub-path where the return flag changes; a curve where an open line follows."""
    order = Window.partitionBy("l_orderkey").orderBy(*LINE_ORDER)
    rows = lines_of_orders(spark, sf_dir).withColumns({"cmd_ix": F.row_number().over(order) - 1, "last_flag": F.lag("l_returnflag").over(order), "later": F.lead("l_linenumber").over(order)})
    starts = F.col("last_flag").isNull() | (F.col("last_flag") != F.col("l_returnflag"))
    curve = F.col("later").isNull() & (F.col("l_linestatus") == "O")
    return rows.select(F.col("l_orderkey").alias("path_id"), "cmd_ix", F.when(starts, "M").when(curve, "Q").otherwise("L").alias("cmd"), F.col("l_quantity").alias("x"), (F.col("l_extendedprice") / 1000).alias("y"))


ORDER = ", ".join(LINE_ORDER)
SQL = {
    "op": f"SELECT l_orderkey AS set_id, 0 AS roi_ix, 0 AS poly_ix, row_number() OVER (PARTITION BY l_orderkey ORDER BY {ORDER}) - 1 AS vertex_ix, l_quantity AS x, l_extendedprice / 1000 AS y FROM lineitem",
    "cr": f"SELECT o_custkey AS set_id, l_orderkey AS roi_ix, dense_rank() OVER (PARTITION BY l_orderkey ORDER BY l_returnflag) - 1 AS poly_ix, row_number() OVER (PARTITION BY l_orderkey, l_returnflag ORDER BY {ORDER}) - 1 AS vertex_ix, l_quantity AS x, l_extendedprice / 1000 AS y FROM lineitem JOIN orders ON l_orderkey = o_orderkey",
    "ep": "SELECT vec_id // 50 AS set_id, vec_id AS roi_ix, 0 AS poly_ix, i AS vertex_ix, 100 * embedding[2 * i + 1]::DOUBLE AS x, 100 * embedding[2 * i + 2]::DOUBLE AS y FROM embeddings, range(32) r(i)",
    "gray": "SELECT vec_id // 50 AS image_id, 1 AS c, 0 AS z, 1 AS t, vec_id % 50 AS y, i AS x, embedding[i + 1]::DOUBLE AS v FROM embeddings, range(64) r(i)",
    "lab": "SELECT vec_id // 50 AS image_id, vec_id % 50 AS y, i AS x, floor((embedding[i + 1]::DOUBLE + 0.6) * 5) AS label FROM embeddings, range(64) r(i)",
    "rgb": "SELECT image_id, y, x, r * 65536 + coalesce(lead(r, 1) OVER w, 0) * 256 + coalesce(lead(r, 2) OVER w, 0) AS rgb FROM (SELECT vec_id // 50 AS image_id, vec_id % 50 AS y, i AS x, floor(abs(embedding[i + 1]::DOUBLE) * 1000)::INT % 256 AS r FROM embeddings, range(64) q(i)) WINDOW w AS (PARTITION BY image_id, y ORDER BY x)",
    "img": "SELECT DISTINCT vec_id // 50 AS image_id, 'img' || (vec_id // 50) || '.raw.tif' AS title, 64 AS width, 50 AS height, 1 AS depth, (vec_id // 50) * 0.5::DOUBLE AS pixel_size FROM embeddings",
    "sp": "SELECT 'u' || (user_id % 50) || '-t' || day(ts) || '.csv' AS file, day(ts) AS t, (event_id % 512)::DOUBLE AS x, (event_id // 512)::DOUBLE AS y, ((props::JSON ->> 'k')::INT % 5)::DOUBLE AS z, value AS intensity, (props::JSON ->> 'k')::INT / 100 AS probability, row_number() OVER (PARTITION BY user_id % 50, day(ts) ORDER BY event_id) - 1 AS spot_ix FROM events",
    "rn": f"SELECT l_suppkey AS set_id, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, {ORDER}) - 1 AS roi_ix, p_brand AS name FROM lineitem JOIN part ON l_partkey = p_partkey",
    "ch0": "SELECT o_custkey AS chain_id, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS step, (o_orderkey % 11)::DOUBLE AS n FROM orders",
    "ch": "SELECT chain_id, step, CASE step % 3 WHEN 0 THEN 'translation' WHEN 1 THEN 'euler' ELSE 'affine' END AS kind, CASE step % 3 WHEN 0 THEN [n, 0 - n] WHEN 1 THEN [n / 7, n, 1.0::DOUBLE, 16.0::DOUBLE, 16.0::DOUBLE] ELSE [1 + n / 97, n / 193, (0 - n) / 193, 1 - n / 97, 0.5::DOUBLE, 0 - n, 8.0::DOUBLE, 8.0::DOUBLE] END AS params FROM ch0 WHERE NOT (chain_id % 7 = 0 AND step = 2)",
    "fr": "SELECT title || '-t' || t || e AS file FROM (SELECT 'u' || (user_id % 50) AS title, dayofyear(ts) AS t, max(event_id) % 5 = 0 AS failed FROM events GROUP BY 1, 2), (VALUES ('.tif'), ('_cp_masks.tif')) v(e) WHERE e = '.tif' OR NOT failed",
    "sec": "SELECT DISTINCT user_id AS series, 'sec_s' || lpad(dayofyear(ts)::VARCHAR, 3, '0') || '.png' AS path FROM events",
    "pc": f"SELECT l_orderkey AS path_id, row_number() OVER w - 1 AS cmd_ix, CASE WHEN lag(l_returnflag) OVER w IS DISTINCT FROM l_returnflag THEN 'M' WHEN lead(l_linenumber) OVER w IS NULL AND l_linestatus = 'O' THEN 'Q' ELSE 'L' END AS cmd, l_quantity AS x, l_extendedprice / 1000 AS y FROM lineitem WINDOW w AS (PARTITION BY l_orderkey ORDER BY {ORDER})",
}


def cte(*names: str) -> str:
    """``WITH`` of the named fixtures."""
    return "WITH " + ",\n".join(f"{n} AS ({SQL[n]})" for n in names)


def recursive(sql: str) -> str:
    return sql.replace("WITH ", "WITH RECURSIVE ", 1)
