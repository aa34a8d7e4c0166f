"""Scene footprints, their overlaps, and the search in a catalogue of scenes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridfold.functions import tiling


def unwrapped(corners: Column) -> Column:
    """Corners with longitudes shifted by 360 where they're more than 180 degrees from the first one's."""
    first = F.get(corners, F.lit(0))["lon"]
    shift = lambda p: F.when(p["lon"] - first > 180.0, -360.0).when(p["lon"] - first < -180.0, 360.0).otherwise(0.0)
    return F.transform(corners, lambda p: F.struct((p["lon"] + shift(p)).alias("lon"), p["lat"].alias("lat")))


def centre(corners: Column) -> Column:
    """struct(lon, lat): mean of the corners, back in -180..180 if that's across the antimeridian."""
    n = F.size(corners).cast("double")
    total = lambda field: F.aggregate(unwrapped(corners), F.lit(0.0), lambda s, p: s + p[field]) / n
    lon = total("lon")
    return F.struct(F.when(lon > 180.0, lon - 360.0).when(lon < -180.0, lon + 360.0).otherwise(lon).alias("lon"), total("lat").alias("lat"))


def ring(corners: Column) -> Column:
    """Closed polygon: the corners and the first again."""
    return F.concat(corners, F.slice(corners, 1, 1))


def geo_center(lat: Column, lon: Column, zoom: int) -> Column:
    return F.format_string(f"lat=%.3f&lng=%.3f&z={zoom}", lat, lon)


def polygons(scenes: DataFrame, depth: int = tiling.DEEPEST) -> DataFrame:
    """scenes(scene_id, corners, ts) with centre, tile, identifier, row key and closed polygon."""
    out = scenes.withColumn("c_", centre(F.col("corners"))).withColumns({"lon": F.col("c_.lon"), "lat": F.col("c_.lat"), "polygon": ring(F.col("corners"))}).drop("c_")
    out = tiling.with_tile(out, depth)
    identifier = tiling.hex16(F.xxhash64(F.transform("polygon", lambda p: F.round(p["lon"] * 1000).cast("long")), F.transform("polygon", lambda p: F.round(p["lat"] * 1000).cast("long"))))
    name = tiling.tile_name(depth, "long_index", "lat_index")
    out = out.withColumns({"tile": name, "identifier": identifier, "geo_center": geo_center(F.col("lat"), F.col("lon"), 10)})
    return out.withColumn("row_key", tiling.point_key("tile", "ts", "identifier"))


def boxes(scenes: DataFrame) -> DataFrame:
    """Bounding box of unwrapped corners: west, east, south, north."""
    u = unwrapped(F.col("corners"))
    lon, lat = F.transform(u, lambda p: p["lon"]), F.transform(u, lambda p: p["lat"])
    return scenes.withColumns({"west": F.array_min(lon), "east": F.array_max(lon), "south": F.array_min(lat), "north": F.array_max(lat)})


def _place(v: Column, low: float, span: float, n: int) -> Column:
    return F.floor((v - low) / span * n)


def tiles_of(scenes: DataFrame, depth: int) -> DataFrame:
    """Each scene with every tile that its bounding box meets."""
    n = 2 << depth
    b = boxes(scenes)
    x = F.sequence(_place(F.col("west"), -180.0, 360.0, n), _place(F.col("east"), -180.0, 360.0, n))
    y = F.sequence(F.greatest(_place(F.col("south"), -90.0, 180.0, n), F.lit(0)), F.least(_place(F.col("north"), -90.0, 180.0, n), F.lit(n - 1)))
    return b.withColumn("long_index", F.explode(x)).withColumn("lat_index", F.explode(y)).withColumn("long_index", F.pmod("long_index", F.lit(n)))


def overlapping(scenes: DataFrame, depth: int = 6) -> DataFrame:
    """Pairs (first, second) where a corner of the second's box lies in the first's, half-open: boxes meet by tile, so that
    only scenes that share a tile are compared. Boxes that contain or cross each other without such a corner aren't pairs.

    A pair comes from one tile alone, that of the south-west corner of what the boxes share, so pairs need no distinct and
    aren't shuffled; repeated scenes go first. scene_id names a box. Tiles go on past the antimeridian as unwrapped boxes do.
    """
    n = 2 << depth
    x = lambda v: _place(v, -180.0, 360.0, n)
    y = lambda v: _place(v, -90.0, 180.0, n)
    names = ["scene_id", "west", "east", "south", "north"]
    once = boxes(scenes).select(*names).dropDuplicates(["scene_id"])
    t = once.withColumn("x", F.explode(F.sequence(x(F.col("west")), x(F.col("east"))))).withColumn("y", F.explode(F.sequence(y(F.col("south")), y(F.col("north")))))
    a = t.select(*[F.col(c).alias(f"a_{c}") for c in names], "x", "y")
    b = t.select(*[F.col(c).alias(f"b_{c}") for c in names], "x", "y")
    lon_in = lambda v: (F.col(v) >= F.col("a_west")) & (F.col(v) < F.col("a_east"))
    lat_in = lambda v: (F.col(v) >= F.col("a_south")) & (F.col(v) < F.col("a_north"))
    inside = (lon_in("b_west") | lon_in("b_east")) & (lat_in("b_south") | lat_in("b_north"))
    here = (F.col("x") == x(F.greatest("a_west", "b_west"))) & (F.col("y") == y(F.greatest("a_south", "b_south")))
    met = a.join(b, ["x", "y"]).where((F.col("a_scene_id") != F.col("b_scene_id")) & inside & here)
    return met.select(F.col("a_scene_id").alias("first"), F.col("b_scene_id").alias("second"))


def total_radiance(columns: list[str]) -> Column:
    """Sum of the radiance columns; absent ones count 0."""
    return sum((F.coalesce(F.col(c), F.lit(0.0)) for c in columns[1:]), F.coalesce(F.col(columns[0]), F.lit(0.0)))


def search(catalog: DataFrame, radiance: tuple[float, float], times: tuple[int, int], lat: float, lon: float, radius: float) -> DataFrame:
    """Scenes by radiance, acquisition time and, unless the radius is 0, distance in degrees of the mean corner."""
    n = F.size("corners").cast("double")
    mean = lambda f: F.aggregate("corners", F.lit(0.0), lambda s, p: s + p[f]) / n
    rows = catalog.where(F.col("radiance").between(*radiance) & F.col("acquisition_start").between(*times)).withColumns({"center_lon": mean("lon"), "center_lat": mean("lat")})
    away = F.sqrt(F.pow(F.col("center_lat") - lat, F.lit(2.0)) + F.pow(F.col("center_lon") - lon, F.lit(2.0)))
    return rows if radius == 0 else rows.where(away < radius)


def slider_bounds(catalog: DataFrame) -> DataFrame:
    """Least (0 at most) and greatest radiance, first and last time."""
    return catalog.agg(F.least(F.min("radiance"), F.lit(0.0)).alias("radiance_min"), F.max("radiance").alias("radiance_max"), F.min("acquisition_start").alias("time_min"), F.max("acquisition_start").alias("time_max"))


def picture_corners(pixels: DataFrame) -> DataFrame:
    """Of valid pixels(scene_id, y, x): first and last row and column, with the mean place of the valid pixels in each."""
    ends = pixels.groupBy("scene_id").agg(F.min("y").alias("top"), F.max("y").alias("bottom"), F.min("x").alias("left"), F.max("x").alias("right"))
    met = pixels.join(ends, "scene_id")
    mean = lambda edge, c, v: F.avg(F.when(F.col(c) == F.col(edge), F.col(v))).alias(f"{edge}_{v}")
    return met.groupBy("scene_id", "top", "bottom", "left", "right").agg(mean("top", "y", "x"), mean("bottom", "y", "x"), mean("left", "x", "y"), mean("right", "x", "y"))
