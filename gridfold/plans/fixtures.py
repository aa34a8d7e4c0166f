"""The library's tables read off the star-schema test tables, which hold no imagery: the same projections in Spark and DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Width of the pixel grid that embeddings stand for, and of the elevation grid that parts stand for.
PIXELS_WIDE, DEM_WIDE = 25, 50


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points spread over the globe: id, lon, lat, ts, layer, intensity, user_id, props."""
    return points_of(table(spark, sf_dir, "events"))


def points_of(events: DataFrame) -> DataFrame:
    return events.selectExpr(
        "event_id id", "cast((event_id * 7919) % 36000 as double) / 100e0 - 180e0 lon", "cast((event_id * 104729) % 18000 as double) / 100e0 - 90e0 lat",
        "unix_timestamp(ts) ts", "event_type layer", "value intensity", "user_id", "props",
    )


def clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points in 150 places, many of them in one tile."""
    return table(spark, sf_dir, "events").selectExpr(
        "event_id id", "(user_id % 150) * 2.25e0 - 160e0 + (event_id % 7) * 0.01e0 lon", "(user_id * 37) % 150 * 1e0 - 75e0 + (event_id % 11) * 0.01e0 lat",
        "unix_timestamp(ts) ts", "event_type layer", "value intensity", "user_id", "props",
    )


def pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One scene of 64 bands: id, y, x, spectrum, label."""
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), F.floor(F.col("vec_id") / PIXELS_WIDE).cast("int").alias("y"), (F.col("vec_id") % PIXELS_WIDE).cast("int").alias("x"), F.col("embedding").cast("array<double>").alias("spectrum"), "label"
    )


def elevation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(F.lit("g").alias("granule"), F.floor(F.col("p_partkey") / DEM_WIDE).cast("int").alias("y"), (F.col("p_partkey") % DEM_WIDE).cast("int").alias("x"), F.col("p_size").cast("double").alias("h"))


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(F.format_string("B%02d", F.col("l_linenumber")).alias("band"), F.col("l_discount").alias("value"))


def scenes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Footprints of about one degree, some across the antimeridian: scene_id, corners, ts, acquisition_start, radiance, priority."""
    base = table(spark, sf_dir, "orders").selectExpr("o_orderkey scene_id", "cast((o_orderkey * 7919) % 36000 as double) / 100e0 - 180e0 lon", "cast((o_orderkey * 104729) % 17600 as double) / 100e0 - 88e0 lat", "unix_timestamp(o_orderdate) ts", "o_totalprice radiance")
    turn = lambda v: F.when(v > 180.0, v - 360.0).otherwise(v)
    corner = lambda dx, dy: F.struct(turn(F.col("lon") + dx).alias("lon"), (F.col("lat") + dy).alias("lat"))
    return base.select("scene_id", F.array(corner(0.0, 1.0), corner(0.75, 0.75), corner(1.0, 0.0), corner(0.25, 0.25)).alias("corners"), "ts", F.col("ts").alias("acquisition_start"), "radiance")


# The same in DuckDB, as common table expressions.
POINTS = """points AS (SELECT event_id id, ((event_id * 7919) % 36000)::DOUBLE / 100e0 - 180e0 lon, ((event_id * 104729) % 18000)::DOUBLE / 100e0 - 90e0 lat,
  floor(epoch(ts))::BIGINT ts, event_type layer, value intensity, user_id, props FROM events),
placed AS (SELECT *, floor((CASE WHEN lon = -180 THEN 360e0 ELSE lon + 180 END) / 360e0 * 2048)::BIGINT long_index, least(floor((lat + 90) / 180e0 * 2048), 2047)::BIGINT lat_index FROM points)"""
CLUSTERED = """clustered AS (SELECT event_id id, (user_id % 150) * 2.25e0 - 160e0 + (event_id % 7) * 0.01e0 lon, (user_id * 37) % 150 * 1e0 - 75e0 + (event_id % 11) * 0.01e0 lat,
  floor(epoch(ts))::BIGINT ts, event_type layer, value intensity, user_id, props FROM events),
placed AS (SELECT *, floor((lon + 180) / 360e0 * 2048)::BIGINT long_index, least(floor((lat + 90) / 180e0 * 2048), 2047)::BIGINT lat_index FROM clustered)"""
PIXELS = "pixels AS (SELECT vec_id id, (vec_id // 25)::INT y, (vec_id % 25)::INT x, embedding::DOUBLE[] s, label FROM embeddings)"
ELEVATION = "dem AS (SELECT 'g' granule, (p_partkey // 50)::INT y, (p_partkey % 50)::INT x, p_size::DOUBLE h FROM part)"
SAMPLES = "samples AS (SELECT printf('B%02d', l_linenumber) band, l_discount value FROM lineitem)"
SCENES = """base AS (SELECT o_orderkey scene_id, ((o_orderkey * 7919) % 36000)::DOUBLE / 100e0 - 180e0 lon, ((o_orderkey * 104729) % 17600)::DOUBLE / 100e0 - 88e0 lat,
  floor(epoch(o_orderdate))::BIGINT ts, o_totalprice radiance FROM orders),
corner AS (SELECT scene_id, ts, radiance, unnest([0, 1, 2, 3]) k, [lon, lon + 0.75e0, lon + 1e0, lon + 0.25e0] xs, [lat + 1e0, lat + 0.75e0, lat, lat + 0.25e0] ys FROM base),
corners AS (SELECT scene_id, ts, radiance, k, CASE WHEN xs[k + 1] > 180 THEN xs[k + 1] - 360e0 ELSE xs[k + 1] END lon, ys[k + 1] lat FROM corner)"""
